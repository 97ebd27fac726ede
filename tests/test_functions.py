import pytest
from pyspark.sql import functions as F

from massloom.functions import mass as mz, modseq, protocol, spectra as sp, text as tx


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("text,scan", [("a scan=12 b=3", 12), ("spec_12.99", 99), ("none", None), ("", None)])
def test_scan_number(spark, text, scan):
    assert one(spark, tx.scan_number(F.lit(text))) == scan


@pytest.mark.parametrize(
    "dialect,text,bare",
    [
        ("brackets", "AC[+57.02]D", "ACD"),
        ("denovo", "[Acetyl]-ACM[Oxidation]D ", "ACMD"),
        ("letters", "(UniMod:1)AC(UniMod:4)D[+1.0]", "ACD"),
    ],
)
def test_strip_mods(spark, dialect, text, bare):
    assert one(spark, tx.strip_mods(F.lit(text), dialect)) == bare


@pytest.mark.parametrize(
    "text,events",
    [
        ("[+42.010565]PEPTIDE", [(-1, None, "N-term", 42.010565, None)]),
        ("(UniMod:1)ACDE", [(-1, None, "N-term", None, 1)]),
        ("AC(UniMod:4)DEM[ -15.9]K", [(1, "C", None, None, 4), (4, "M", None, -15.9, None)]),
        ("PEPM[+15.99]", [(3, "M", None, 15.99, None)]),
        ("PEM[Oxidation]K", []),
        ("", []),
    ],
)
def test_mod_events(spark, text, events):
    assert [tuple(e) for e in one(spark, modseq.mod_events(F.lit(text)))] == events


def test_mod_events_compat_repeats_the_last_residue(spark):
    got = [tuple(e) for e in one(spark, modseq.mod_events(F.lit("PEPM[+15.99]"), compat=True))]
    assert got == [(3, "M", None, 15.99, None), (4, None, "C-term", 15.99, None)]


def test_unimod_to_mass_keeps_unknown_ids(spark):
    masses = F.create_map(F.lit(35), F.lit(15.994915), F.lit(28), F.lit(-17.026549))
    got = one(spark, modseq.unimod_to_mass(F.lit("Q(UniMod:28)M(UniMod:35)C(UniMod:4)"), masses))
    assert got == "Q[-17.026549]M[+15.994915]C(UniMod:4)"


@pytest.mark.parametrize(
    "text,expected",
    [
        ("FTMS + p NSI Full ms [350.00-1600.00]", ("HR", 1, "MS1", "??", None)),
        ("FTMS + c d Full ms2 1@hcd30.00 [1]", ("HR", 2, "HR_HCD", "HR HCD", None)),
        ("ITMS + c d Full ms2 1@cid35.00 [1]", ("LR", 2, "LR_IT_CID", "LR IT CID", None)),
        ("ITMS + c d Full ms2 1@etd35.00 [1]", ("LR", 2, "LR_IT_ETD", "LR IT ETD", None)),
        ("FTMS + c d Full ms2 1@etd5@hcd3 [1]", ("HR", 2, "HR_EThcD", "HR EThcD", None)),
        ("FTMS + c d Full ms2 1@cid5@hcd3 [1]", ("HR", 2, None, None, "UnrecognizedFragmentation")),
        ("XTMS + c d Full ms2 1@hcd3 [1]", (None, 2, None, None, "UnrecognizedDetector")),
        ("FTMS + c d Full ms2 [1]", ("HR", 2, None, None, "CantParseFilterStr")),
        ("FTMS + c d Full msx 1@hcd3 [1]", ("HR", None, None, None, "UnrecognizedMSLevel")),
    ],
)
def test_filter_string(spark, text, expected):
    r = one(spark, sp.parse_filter_string(F.lit(text)))
    assert (r.accuracy, r.ms_level, r.frag_type, r.frag_tag, r.error_code) == expected


def test_bin_peaks_keeps_the_largest_of_a_bin(spark):
    mz_ = F.array(*[F.lit(v) for v in (100.0, 100.06, 100.07, 250.02, 400.0)])
    inten = F.array(*[F.lit(v) for v in (9.0, 1.0, 5.0, 2.0, 7.0)])
    got = one(spark, sp.bin_peaks(mz_, inten, F.lit(100.0), F.lit(400.0), F.lit(0.05)))
    assert [(p.bin, p.intensity) for p in got] == [(1, 5.0), (3000, 2.0)]


def test_clean_peaks_drops_poor_spectra(spark):
    mz_ = F.transform(F.sequence(F.lit(1), F.lit(25)), lambda i: F.lit(100.0) + i)
    inten = F.transform(F.sequence(F.lit(1), F.lit(25)), lambda i: i.cast("double"))
    kept = one(spark, sp.clean_peaks(mz_, inten, F.lit(110.0), F.lit(2)))
    assert len(kept) == 20 and abs(sum(p.intensity**2 for p in kept) - 1) < 1e-12
    assert one(spark, sp.clean_peaks(mz_, inten, F.lit(110.0), F.lit(2), min_peaks=21)) is None
    assert one(spark, sp.clean_peaks(mz_, inten, F.lit(110.0), F.lit(11))) is None


@pytest.mark.parametrize(
    "text,size",
    [('{"a": "1"}', "1"), ('x ```json\n{"a": "2"}\n``` y', "2"), ('x ```\n{"a": "3"}\n```', "3"), ("words", None), ("{broken", None)],
)
def test_llm_json(spark, text, size):
    r = one(spark, tx.llm_json(F.lit(text), "a STRING"))
    assert (r.a if r else None) == size


def test_protocol_edges(spark):
    assert one(spark, protocol.scan_range(F.lit("m/z range of 3501600 was"))) == "350m/z-1600m/z"
    assert one(spark, protocol.scan_range(F.lit("350–1600 m/z"))) == "350m/z-1600m/z"
    assert one(spark, protocol.collision_energy(F.lit("(NCE) of 28%"))) == "28 NCE"
    assert one(spark, protocol.cleavage_agent(F.lit("chymotrypsin and trypsin"))).startswith("NT=Chymotrypsin")
    assert one(spark, protocol.cleavage_agent(F.lit("none"))) == "not available"
    assert one(spark, protocol.mass_tolerance(F.lit("Precursor mass tolerance 4.5 ppm"), "precursor")) == "4.5 ppm"


def test_scores_and_lists(spark):
    assert one(spark, tx.aa_score_avg(F.lit("0.5,1.0,"))) == 0.75
    assert one(spark, tx.aa_score_avg(F.lit("0.5,x"))) is None
    assert one(spark, tx.aa_score_avg(F.lit(""))) is None
    scores = F.array(F.lit(0.5), F.lit(1.5), F.lit(0.4))
    assert abs(one(spark, mz.peptide_score(scores)) - 0.2) < 1e-12
    assert abs(one(spark, mz.peptide_score(scores, F.lit(False))) + 0.8) < 1e-12
    assert one(spark, tx.n_proteins(F.lit(""))) == 0 and one(spark, tx.n_proteins(F.lit("a;b"))) == 2


def test_durations(spark):
    def d(a, b):
        return one(spark, tx.duration_text(F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp")))

    assert d("2024-01-01 00:00:00", "2024-01-01 01:02:03") == "1h 2m 3s"
    assert d("2024-01-01 00:00:00", "2024-01-01 00:02:03") == "2m 3s"
    assert d("2024-01-01 00:00:00", "2024-01-01 00:00:03") == "3s"


def test_names_are_found_whole_and_across_separators(spark):
    from massloom.functions.vocabulary import first_named, names_in, words_of

    def agent(text):
        return one(spark, protocol.cleavage_agent(F.lit(text)))

    assert all(agent(t).startswith("NT=Lys-C") for t in ("LysC", "with lys-c, overnight", "Lys C", "rLys-C"))
    assert agent("Trypsin/P") == agent("were trypsinized") == "NT=Trypsin;AC=MS:1001251"
    assert agent("antitrypsins") == agent("") == "not available" and agent("Glu-C and trypsin").startswith("NT=Glu-C")

    def analyzer(text):
        return one(spark, tx.cv_map(F.lit(text), "analyzer"))

    assert [analyzer(t) for t in ("QExactive Plus", "Orbitrap Fusion Lumos", "LTQ Velos", "timsTOF Pro 2", "TSQ-Vantage", "abacus")] == [
        "orbitrap", "orbitrap", "ion trap", "TOF", "quadrupole", None]
    found = names_in(words_of(F.lit("10 mM tris (2-carboxyethyl) phosphine or 2-ME")), "reduction")
    assert one(spark, first_named(found, "reduction")) == "tris(2-carboxyethyl)phosphine"


def test_modifications_of_a_protocol(spark):
    def mods(sample, data):
        return [m.unimod_id for m in one(spark, protocol.named_facts(F.lit(sample), F.lit(data)))["protocol_mods"]]

    assert mods("TMT labelled", "Carbamidomethylation fixed, oxidation (M), acetyl (protein N-term)") == [4, 730, 35, 1]
    assert mods("acetyl\nat the N-terminus", "") == [] and mods("", "Phosphopeptides; deamidated; dimethylation") == [21, 7, 34]
    assert one(spark, protocol.named_facts(F.lit("DTT and IAA"), F.lit("TCEP")))["reduction_reagent"] == "dithiothreitol"


def test_amounts_near_their_keywords(spark):
    tol = lambda t, w="precursor": one(spark, protocol.mass_tolerance(F.lit(t), w))
    assert tol("precursors and precursor ions: 20 ppm") == "20 ppm" and tol("precursor. 20 ppm") is None
    assert tol("precursor " + "x " * 20 + "5 ppm") is None and tol("Fragment ions 0.5 Da; precursor 3 Da", "fragment") == "0.5 Da"
    assert one(spark, protocol.scan_range(F.lit("from 400 to 1600 m/z and m/z 200-300"))) == "400m/z-1600m/z"
    assert one(spark, protocol.scan_range(F.lit("m/z 12.350-1600 x"))) is None
    energy = lambda t: one(spark, protocol.collision_energy(F.lit(t)))
    assert energy("normalized collision energy (stepped) 25 %") is None and energy("normalized collision energy of 25 %") == "25 NCE"
    assert energy("a collision energy of 30 eV") == "30 eV" and energy("once 5") is None


def test_leave_one_out_matches_enumeration(spark):
    import itertools

    from massloom.functions.counting import leave_one_out

    p, like = [0.2, 0.7, 0.9], [0.1, 0.5, 0.8, 0.9]
    got = one(spark, leave_one_out(F.array(*map(F.lit, p)), F.array(*map(F.lit, like))))
    for i, r in enumerate(got):
        totals = [0.0, 0.0]
        for x in (0, 1):
            for rest in itertools.product([0, 1], repeat=2):
                w, others = 1.0, [q for j, q in enumerate(p) if j != i]
                for bit, q in zip(rest, others):
                    w *= q if bit else 1 - q
                totals[x] += w * like[sum(rest) + x]
        assert abs(r.present - totals[1] / sum(totals)) < 1e-12


def messages_by_deletion(p, like):
    """Each variable's messages from the counts of all others, added one after another."""
    import numpy as np

    out = []
    for i in range(len(p)):
        counts = np.ones(1)
        for j, x in enumerate(p):
            if j != i:
                counts = np.append(counts * (1 - x), 0) + np.append(0, counts * x)
        absent, there = counts @ like[:-1], counts @ like[1:]
        out.append(there / (absent + there))
    return np.array(out)


def test_leave_one_out_tree_equals_deletion():
    import numpy as np

    from massloom.functions import counting

    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 5, 64, 300):
        p, like = rng.uniform(0, 1, (2, n)), rng.uniform(0, 1, (2, n + 1))
        absent, there = counting.tree_messages(p, like)
        for row in range(2):
            assert np.abs(there[row] - messages_by_deletion(p[row], like[row])).max() < 1e-12
        assert np.abs(absent + there - 1).max() < 1e-12


def test_leave_one_out_by_fourier_transforms(monkeypatch):
    import numpy as np

    from massloom.functions import counting

    rng = np.random.default_rng(2)
    p, like = rng.uniform(0.1, 0.9, (1, 400)), np.exp(-np.arange(401) / 400)[None] + 0.1
    direct = counting.tree_messages(p, like)[1]
    monkeypatch.setattr(counting, "LONG", 16)
    assert np.abs(counting.tree_messages(p, like)[1] - direct).max() < 1e-9
    assert np.abs(direct[0] - messages_by_deletion(p[0], like[0])).max() < 1e-12


def test_leave_one_out_forms_agree_on_columns(spark):
    import numpy as np

    from massloom.functions.counting import leave_one_out

    rng = np.random.default_rng(3)
    rows = [(i, rng.uniform(0, 1, n).tolist(), rng.uniform(0, 1, n + 1).tolist()) for i, n in enumerate((1, 2, 8, 32, 33, 1000))] + [(9, None, None)]
    df = spark.createDataFrame(rows, "id int, p array<double>, l array<double>").repartition(3)
    want = {i: messages_by_deletion(p, np.array(like)) for i, p, like in rows if p is not None}
    for short in (0, 8, 32, 64):
        some = df if short < 64 else df.where("id < 5 or id = 9")
        got = {r.id: r.m for r in some.select("id", leave_one_out(F.col("p"), F.col("l"), short).alias("m")).collect()}
        for i in got.keys() & want.keys():
            assert max(abs(m.present - w) + abs(m.absent + w - 1) for m, w in zip(got[i], want[i], strict=True)) < 1e-11
        assert got[9] is None


def least_squares(points, start):
    """Plain damped steps with numpy."""
    import numpy as np

    x, y = np.array(points).T
    g, damp = np.array(start, float), 1e-3
    f = lambda g: g[0] * np.exp(-((x - g[1]) / g[2]) ** 2 / 2)
    for _ in range(300):
        v, z = f(g), (x - g[1]) / g[2]
        j = np.stack([v / g[0], v * z / g[2], v * z * z / g[2]], axis=1)
        a = j.T @ j
        new = g + np.linalg.solve(a + damp * np.diag(np.diag(a)), j.T @ (y - v))
        if ((y - f(new)) ** 2).sum() <= ((y - v) ** 2).sum():
            g, damp = new, damp / 10
        else:
            damp *= 10
    return g


def test_linear_peak_fit_equals_least_squares(spark):
    import numpy as np

    from massloom.operators import runs

    rng = np.random.default_rng(7)
    comp, peaks, points = [], [], {}
    for k, (height, mid, sigma, noise) in enumerate([(1000, 0.3, 2.0, 1), (40, -0.6, 1.4, 6), (15, 0.2, 2.5, 4), (500, 0.0, 0.8, 0)]):
        xs = np.arange(-16, 16)
        ys = np.maximum(np.round(height * np.exp(-((xs - mid) / sigma) ** 2 / 2) + rng.normal(0, noise, len(xs)), 3), 0)
        mode = 100_000 + 1000 * k
        comp += [("run", "HR_HCD", mode + int(x), 5, float(y)) for x, y in zip(xs, ys) if y > 0]
        peaks.append(("run", "HR_HCD", f"r{k}", "TMT", mode, 8, 100, 1.0, True))
        points[f"r{k}"] = list(zip(xs, ys))
    comp = spark.createDataFrame(comp, "filename string, frag_type string, bin long, n_peaks long, intensity double")
    schema = "filename string, frag_type string, region string, label string, mode_bin long, extent int, n_spectra long, intensity double, is_found boolean"
    peaks = spark.createDataFrame([*peaks, ("run", "HR_HCD", "void", "TMT", 5, 8, 100, 1.0, True)], schema)
    start = {r.region: r for r in runs.fit_peak(comp, peaks).collect()}
    got = {r.region: r for r in runs.fit_peak_linear(comp, peaks).collect()}
    assert not got["void"].converged and got["void"].height is None if "void" in got else True
    low, _, width = 100.0, None, 0.0002
    for k, region in enumerate(sorted(points)):
        s, g = start[region], got[region]
        mode = 100_000 + 1000 * k
        want = least_squares(points[region], (s.height, (s.fit_mz - low) / width - mode, s.sigma / width))
        assert g.converged and abs(g.height - want[0]) < 1e-4 * want[0]
        assert abs((g.fit_mz - low) / width - mode - want[1]) < 1e-3 and abs(g.sigma / width - want[2]) < 1e-3 * want[2]
    assert abs(start["r2"].height - got["r2"].height) > 0.1  # the noisy flanks did decide before

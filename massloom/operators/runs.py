"""Runs: spectra counters, composite spectra, label calls, instruments, study consensus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.functions import rules, spectra as sp, text as tx
from massloom.functions.text import let
from massloom.schemas import known


def instrument(cv: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """Instrument per run from header accessions (``accession``, ``ord``).

    A known model wins, the last one if several; else the special case of lowest rank.
    """
    spark = cv.sparkSession
    models = [(a, n, c, 1) for a, n, c in rules.INSTRUMENTS] + list(rules.INSTRUMENT_SPECIAL)
    table = spark.createDataFrame(models, "accession STRING, name STRING, category STRING, rank INT")
    hits = cv.join(F.broadcast(table), "accession", "left")
    order = F.struct("rank", F.when(F.col("rank") == 1, -F.col("ord")).otherwise(F.col("ord")))
    best = F.min_by(F.struct("accession", "name", "category", "rank"), F.when(F.col("rank").isNotNull(), order))
    return hits.groupBy(*by).agg(best.alias("b")).select(
        *by,
        F.col("b.accession").alias("accession"),
        F.coalesce("b.name", F.lit("unknown")).alias("name"),
        F.coalesce("b.category", F.lit("unknown")).alias("category"),
    )


def with_filter_facts(spectra: DataFrame) -> DataFrame:
    return spectra.withColumn("f", sp.parse_filter_string(F.col("filter_string")))


def acquisition_type(spectra: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """DDA, DIA, ambiguous or unknown from the largest MS2 isolation width of a run."""
    ms2 = F.col("ms_level") == 2
    width = F.max(F.when(ms2, F.col("iso_lower") + F.col("iso_upper")))
    call = (
        F.when(width.isNull(), "unknown")
        .when(width <= 3.0, "DDA")
        .when(width >= 15.0, "DIA")
        .otherwise("ambiguous")
    )
    return spectra.groupBy(*by).agg(width.alias("largest_width"), call.alias("acquisition_type"))


FRAGMENT_CLASSES = [
    f"{acc}_{kind}" for kind in ("HCD", "IT_CID", "IT_ETD", "EThcD", "ETciD") for acc in ("HR", "LR")
]


def spectrum_stats(spectra: DataFrame, levels: Sequence[str] = ("pxd", "filename")) -> DataFrame:
    """Counters per run and rolled up to the study (``filename`` NULL) in one pass."""
    df = with_filter_facts(spectra)
    has_text = F.col("filter_string").isNotNull() & (F.col("filter_string") != "")
    kind = F.when(has_text, F.col("f.frag_type"))
    level = F.when(has_text, F.coalesce("f.ms_level", F.col("ms_level"))).otherwise(F.col("ms_level"))
    ok = ~has_text | F.col("f.error_code").isNull()
    category = F.col("category") if "category" in df.columns else F.lit(None).cast("string")
    qtof = ~has_text & (category == "QTOF") & (F.col("ms_level") > 1)
    peaks = F.size("mz") if "mz" in df.columns else F.col("n_peaks")
    ms2 = F.col("ms_level") == 2
    ms1_hr = has_text & ok & (level == 1) & (F.col("f.accuracy") == "HR")
    ms1_lr = has_text & ok & (level == 1) & (F.col("f.accuracy") == "LR")
    hr, lr = F.coalesce(F.bool_or(ms1_hr), F.lit(False)), F.coalesce(F.bool_or(ms1_lr), F.lit(False))
    first, last = F.min(F.when(ms2, kind)), F.max(F.when(ms2, kind))
    return df.rollup(*levels).agg(
        F.count("*").alias("n_spectra"),
        F.count_if(ok & (level == 1)).alias("n_ms1_spectra"),
        F.count_if(ok & (level == 2)).alias("n_ms2_spectra"),
        F.count_if(ok & (level > 2)).alias("n_ms3plus_spectra"),
        F.count_if(ms2 & (peaks == 0)).alias("n_length_zero_spectra"),
        F.count_if(ms2 & (peaks < 10)).alias("n_length_lt10_spectra"),
        *[F.count_if(kind == c).alias(f"n_{c.lower()}_spectra") for c in FRAGMENT_CLASSES],
        F.count_if(qtof).alias("n_hr_qtof_spectra"),
        F.count_if((F.col("filter_string") == "") & (F.col("ms_level") > 1)).alias(
            "n_unknown_fragmentation_type_spectra"
        ),
        F.when(hr & lr, "multiple").when(hr, "true").when(lr, "false").otherwise("unknown").alias(
            "high_accuracy_precursors"
        ),
        F.when(first.isNull(), "unknown").when(first == last, first).otherwise("multiple").alias(
            "fragmentation_type"
        ),
    )


def charge_hist(spectra: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    key = F.coalesce(F.col("charge").cast("string"), F.lit("unknown")).alias("charge")
    return spectra.where("ms_level = 2").groupBy(*by, key).agg(F.count("*").alias("n_precursors"))


def isolation_hist(spectra: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    width = (F.col("iso_lower") + F.col("iso_upper")).alias("full_width")
    rows = spectra.where("ms_level = 2 and iso_lower is not null and iso_upper is not null")
    return rows.groupBy(*by, width).agg(F.count("*").alias("n_spectra"))


def histogram_map(hist: DataFrame, by: Sequence[str], key: str, value: str) -> DataFrame:
    """A histogram as one map per group, for the study document; keys are few (charges, widths)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string"), F.col(value))))
    return hist.groupBy(*by).agg(F.map_from_entries(pairs).alias("histogram"))


def _range_columns(kind: Column) -> tuple[Column, Column, Column]:
    def pick(i: int) -> Column:
        out = F.lit(None).cast("double")
        for name, bounds in rules.COMPOSITE_RANGES.items():
            out = F.when(kind == name, F.lit(bounds[i])).otherwise(out)
        return out

    return pick(0), pick(1), pick(2)


def composite(spectra: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """Sparse composite spectrum per run and fragmentation type.

    ``n_peaks`` counts spectra with a peak in the bin, ``intensity`` adds each one's largest.
    Peaks are cut and reduced inside each row before anything is exploded or shuffled.
    """
    df = with_filter_facts(spectra).where("ms_level = 2").withColumn("frag_type", F.col("f.frag_type"))
    low, high, width = _range_columns(F.col("frag_type"))
    df = df.where(low.isNotNull())
    bins = df.select(
        *by, "frag_type", F.explode(sp.bin_peaks(F.col("mz"), F.col("intensity"), low, high, width)).alias("p")
    )
    return bins.groupBy(*by, "frag_type", F.col("p.bin").alias("bin")).agg(
        F.count("*").alias("n_peaks"), F.sum("p.intensity").alias("intensity")
    )


#: Peaks that a task sorts and groups, about.
PEAKS_OF_TASK = 1 << 19


def composite_from_peaks(spectra: DataFrame, peaks: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """The same from a long peak table keyed by ``spectrum_id``.

    Peaks are counted first and dealt over so many tasks that each keeps a bounded number of them.
    """
    tasks = -(-peaks.count() // PEAKS_OF_TASK) or 1
    facts = with_filter_facts(spectra).where("ms_level = 2").select(
        *by, "spectrum_id", F.col("f.frag_type").alias("frag_type")
    )
    low, high, width = _range_columns(F.col("frag_type"))
    inside = peaks.repartition(tasks, "spectrum_id").join(facts.repartition(tasks, "spectrum_id"), "spectrum_id").where((F.col("mz") > low) & (F.col("mz") < high))
    per_spectrum = inside.groupBy(
        *by, "frag_type", "spectrum_id", F.floor((F.col("mz") - low) / width).alias("bin")
    ).agg(F.max("intensity").alias("intensity"))
    return per_spectrum.groupBy(*by, "frag_type", "bin").agg(
        F.count("*").alias("n_peaks"), F.sum("intensity").alias("intensity")
    )


def reporter_regions() -> list[tuple[str, str, str, int, int]]:
    """Regions with their first and one-past-last bin."""
    out = []
    for kind, region, label, centre, window in rules.REPORTER_REGIONS:
        low, _, width = rules.COMPOSITE_RANGES[kind]
        first, last = (int((centre + side * window / 2.0 - low) / width) for side in (-1, 1))
        out.append((kind, region, label, first, last))
    return out


def reporter_peaks(
    comp: DataFrame, by: Sequence[str] = ("filename",), min_spectra: int = rules.PEAK_MIN_SPECTRA
) -> DataFrame:
    """Tallest bin per run and region, grown on both sides until the gain in spectra is small.

    Regions are a fixed list of bins, so finding and growing are equi joins on the bin.
    """
    spark = comp.sparkSession
    regions = spark.createDataFrame(
        reporter_regions(), "frag_type STRING, region STRING, label STRING, first BIGINT, last BIGINT"
    ).where("last > first")
    regions = regions.withColumn("bin", F.explode(F.sequence("first", F.col("last") - 1))).drop("first", "last")
    keys = [*by, "frag_type", "region", "label"]
    # both columns are read here as below, so that the composite is built once and reused
    modes = (
        comp.where("intensity > 0 and n_peaks > 0")
        .join(F.broadcast(regions), ["frag_type", "bin"])
        .groupBy(*keys)
        .agg(F.max_by("bin", F.struct("intensity", -F.col("bin"))).alias("mode_bin"))
    )
    offsets = F.sequence(F.lit(-rules.PEAK_MAX_EXTENT), F.lit(rules.PEAK_MAX_EXTENT))
    around = modes.select(*keys, "mode_bin", F.explode(offsets).alias("offset")).withColumn(
        "bin", F.col("mode_bin") + F.col("offset")
    )
    rings = (
        around.join(comp, [*by, "frag_type", "bin"], "left")
        .groupBy(*keys, "mode_bin", F.abs("offset").alias("d"))
        .agg(
            F.coalesce(F.sum("n_peaks"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("intensity"), F.lit(0.0)).alias("i"),
        )
    )
    # 17 rings per run and region
    order = Window.partitionBy(*keys, "mode_bin").orderBy("d")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    grown = rings.withColumn("cum_n", F.sum("n").over(running)).withColumn("cum_i", F.sum("i").over(running))
    grown = grown.withColumn("prev_n", F.lag("cum_n").over(order))
    stop = (F.col("d") > 0) & (
        (F.col("cum_n") < rules.PEAK_GAIN * F.col("prev_n")) | (F.col("d") == rules.PEAK_MAX_EXTENT)
    )
    return (
        grown.where(stop)
        .groupBy(*keys, "mode_bin")
        .agg(
            F.min("d").alias("extent"),
            F.min_by("cum_n", "d").alias("n_spectra"),
            F.min_by("cum_i", "d").alias("intensity"),
        )
        .withColumn("is_found", F.col("n_spectra") > min_spectra)
    )


def label_calls(peaks: DataFrame, n_ms2: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """Score per label type (sum of found fractions of MS2) and the call.

    ``n_ms2`` holds ``n_ms2_spectra`` per run.
    """
    types = ["TMT", "TMTpro", "iTRAQ", "iTRAQ4", "iTRAQ8"]
    keys = [*by, "frag_type"]
    fraction = F.when(F.col("is_found"), F.col("n_spectra") / F.col("n_ms2_spectra")).otherwise(0.0)
    scores = (
        peaks.join(n_ms2, list(by))
        .groupBy(*keys)
        .agg(*[F.sum(F.when(F.col("label") == t, fraction).otherwise(0.0)).alias(t.lower()) for t in types])
    )
    tmt, itraq = F.col("tmt"), F.col("itraq")
    call = (
        F.when((tmt > itraq) & (tmt > 2), F.when(F.col("tmtpro") > 0.7, "TMTpro").otherwise("TMT"))
        .when(tmt > itraq, F.when(tmt < 1, "none").otherwise("ambiguous"))
        .when(itraq > 1, F.when(F.col("itraq4") > F.col("itraq8"), "iTRAQ4").otherwise("iTRAQ8"))
        .when(itraq < 0.5, "none")
        .otherwise("ambiguous")
    )
    return scores.withColumn("call", call)


def fit_peak(comp: DataFrame, peaks: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """Gaussian per found region: a least-squares parabola through the log intensities.

    The window is twice the extent on each side. Only sums are needed, so it is one grouped
    aggregate; ``sigma`` is NULL where the parabola does not open downwards.
    """
    keys = [*by, "frag_type", "region", "mode_bin"]
    reach = F.col("extent") * 2
    around = peaks.where("is_found").select(
        *keys, F.explode(F.sequence(-reach, reach - 1)).alias("x")
    ).withColumn("bin", F.col("mode_bin") + F.col("x"))
    pts = around.join(comp.where("intensity > 0"), [*by, "frag_type", "bin"])
    x, w, y = F.col("x").cast("double"), F.col("intensity"), F.ln("intensity")
    moments = pts.groupBy(*keys).agg(
        *[F.sum(w * F.pow(x, F.lit(k))).alias(f"s{k}") for k in range(5)],
        *[F.sum(w * F.pow(x, F.lit(k)) * y).alias(f"t{k}") for k in range(3)],
    )
    s = [F.col(f"s{k}") for k in range(5)]
    t = [F.col(f"t{k}") for k in range(3)]

    def det(a, b, c):
        return (
            a[0] * (b[1] * c[2] - c[1] * b[2]) - b[0] * (a[1] * c[2] - c[1] * a[2])
            + c[0] * (a[1] * b[2] - b[1] * a[2])
        )

    cols = [s[0:3], s[1:4], s[2:5]]
    whole = F.nullif(det(*cols), F.lit(0.0))
    solved = moments.select(
        *keys,
        (det(t, cols[1], cols[2]) / whole).alias("a"),
        (det(cols[0], t, cols[2]) / whole).alias("b"),
        (det(cols[0], cols[1], t) / whole).alias("c"),
    )
    low, _, width = _range_columns(F.col("frag_type"))
    ok = F.col("c") < 0
    shift = -F.col("b") / (2 * F.col("c"))
    return solved.select(
        *keys,
        F.when(ok, low + (F.col("mode_bin") + shift) * width).alias("fit_mz"),
        F.when(ok, F.sqrt(-1 / (2 * F.col("c"))) * width).alias("sigma"),
        F.when(ok, F.exp(F.col("a") - F.col("b") * F.col("b") / (4 * F.col("c")))).alias("height"),
    )


def _solved(m: Column) -> list[Column]:
    """Solution of three normal equations with the matrix m.a.. (upper half by rows) and right side m.u.. ."""
    a, b, c, d, e, f = (m[x] for x in "abcdef")
    u, v, w = (m[x] for x in "uvw")
    whole = F.nullif(a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c), F.lit(0.0))
    return [
        (u * (d * f - e * e) - b * (v * f - e * w) + c * (v * e - d * w)) / whole,
        (a * (v * f - e * w) - u * (b * f - e * c) + c * (b * w - v * c)) / whole,
        (a * (d * w - v * e) - b * (b * w - v * c) + u * (b * e - d * c)) / whole,
    ]


def _least_squares(points: Column, start: Column, rounds: int) -> Column:
    """Gaussian through ``points`` (x, y) of least squared error, from ``start`` (h, m, s), by damped
    Gauss-Newton steps: a step that raises the error is not taken and the next is shorter."""

    def value(p: Column, g: Column) -> Column:
        return g["h"] * F.exp(-F.pow((p["x"] - g["m"]) / g["s"], F.lit(2)) / 2)

    def error(g: Column) -> Column:
        return F.aggregate(points, F.lit(0.0), lambda acc, p: acc + F.pow(p["y"] - value(p, g), F.lit(2)))

    def moments(g: Column) -> Column:
        def add(acc: Column, p: Column) -> Column:
            def terms(f: Column) -> Column:
                z = (p["x"] - g["m"]) / g["s"]
                j = [f / g["h"], f * z / g["s"], f * z * z / g["s"]]
                rest = p["y"] - f
                products = {"a": j[0] * j[0], "b": j[0] * j[1], "c": j[0] * j[2], "d": j[1] * j[1], "e": j[1] * j[2], "f": j[2] * j[2]}
                products |= {k: jk * rest for k, jk in zip("uvw", j, strict=True)}
                return F.struct(*[(acc[k] + v).alias(k) for k, v in products.items()])

            return let(value(p, g), terms)

        return F.aggregate(points, F.struct(*[F.lit(0.0).alias(k) for k in "abcdefuvw"]), add)

    def step(g: Column, _: Column) -> Column:
        def move(m: Column) -> Column:
            damped = F.struct(*[(m[k] * (1 + g["damp"]) if k in "adf" else m[k]).alias(k) for k in "abcdefuvw"])
            return let(damped, lambda d: F.struct(*[x.alias(k) for x, k in zip(_solved(d), "hms", strict=True)]))

        def judge(by: Column) -> Column:
            new = F.struct(*[(g[k] + by[k]).alias(k) for k in "hms"])

            def take(n: Column) -> Column:
                def chosen(e: Column) -> Column:
                    better = F.coalesce((e <= g["sse"]) & (n["s"] > 0) & (n["h"] > 0), F.lit(False))
                    moved = F.greatest(F.abs(by["h"] / g["h"]), F.abs(by["m"] / g["s"]), F.abs(by["s"] / g["s"]))
                    keep = {k: F.when(better, n[k]).otherwise(g[k]) for k in "hms"}
                    keep |= {"sse": F.when(better, e).otherwise(g["sse"]), "damp": F.when(better, g["damp"] / 10).otherwise(g["damp"] * 10 + 1e-6)}
                    # a step too short to matter ends the search, taken or not
                    keep["done"] = g["done"] | F.coalesce(moved < 1e-7, F.lit(False))
                    return F.struct(*[v.alias(k) for k, v in keep.items()])

                return let(error(n), chosen)

            return let(new, take)

        return F.when(g["done"], g).otherwise(let(let(moments(g), move), judge))

    first = F.struct(
        *[start[k].alias(k) for k in "hms"], error(start).alias("sse"), F.lit(1e-3).alias("damp"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, step)


def fit_peak_linear(comp: DataFrame, peaks: DataFrame, by: Sequence[str] = ("filename",), rounds: int = 40) -> DataFrame:
    """Gaussian per found region by least squares on the intensities themselves, bins without a peak
    counting as 0; the parabola of :func:`fit_peak` is the start, so faint flanks no longer decide.

    A region has at most some 70 bins, gathered in one row. ``converged`` tells whether the last
    step was below 1e-7 of the parameters; without a start all columns are NULL and it is false.
    """
    keys = [*by, "frag_type", "region", "mode_bin"]
    reach = F.col("extent") * 2
    around = peaks.where("is_found").select(*keys, F.explode(F.sequence(-reach, reach - 1)).alias("x")).withColumn("bin", F.col("mode_bin") + F.col("x"))
    point = F.struct(F.col("x").cast("double").alias("x"), F.coalesce("intensity", F.lit(0.0)).cast("double").alias("y"))
    rows = around.join(comp.select(*by, "frag_type", "bin", "intensity"), [*by, "frag_type", "bin"], "left")
    points = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points"))
    low, _, width = _range_columns(F.col("frag_type"))
    starts = fit_peak(comp, peaks, by).where("sigma is not null").select(
        *keys, F.struct(
            F.col("height").alias("h"), ((F.col("fit_mz") - low) / width - F.col("mode_bin")).alias("m"), (F.col("sigma") / width).alias("s")).alias("start"))
    fits = points.join(starts, keys, "left").withColumn("g", F.when(F.col("start").isNotNull(), _least_squares(F.col("points"), F.col("start"), rounds)))
    return fits.select(
        *keys, (low + (F.col("mode_bin") + F.col("g.m")) * width).alias("fit_mz"), (F.col("g.s") * width).alias("sigma"), F.col("g.h").alias("height"),
        F.coalesce("g.done", F.lit(False)).alias("converged"))


def fitted_peaks(comp: DataFrame, peaks: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """``peaks`` of which only those count as found that a Gaussian could be fitted to."""
    keys = [*by, "frag_type", "region", "mode_bin"]
    fits = fit_peak(comp, peaks, by).where("sigma is not null").select(*keys, F.lit(True).alias("_fits"))
    found = F.col("is_found") & F.coalesce("_fits", F.lit(False))
    return peaks.join(fits, keys, "left").withColumn("is_found", found).select(*peaks.columns)


def study_consensus(runs: DataFrame, by: Sequence[str] = ("pxd",)) -> DataFrame:
    """One value per field over the runs of a study: the value, ``multiple`` or ``unknown``.

    Unknown values count only if nothing is known; ambiguous labels are ignored. ``problems``
    lists the codes. The smallest and largest value decide, so the order of runs does not matter.
    """
    fields = {
        "instrument": "MultipleInstruments",
        "fragmentation_type": "MultipleFragTypes",
        "high_accuracy_precursors": "MultipleFragTypes",
        "labeling": "MultipleLabelingTypes",
        "acquisition_type": "MultipleAcquisitionTypes",
    }
    aggs, problems = [], []
    for name, code in fields.items():
        # "none" is a real label call, so only unknown and blank are missing here
        value = F.trim(name)
        value = F.when(~F.lower(value).isin("", "unknown"), value)
        if name == "labeling":
            value = F.when(value != "ambiguous", value)
        low, high = F.min(value), F.max(value)
        aggs.append(
            F.when(low.isNull(), "unknown").when(low == high, low).otherwise("multiple").alias(name)
        )
        problems.append(F.when(F.col(name) == "multiple", F.lit(code)))
    missing = [
        F.count_if(known(F.col("instrument")).isNull()).alias("_no_instrument"),
        F.count_if(known(F.col("fragmentation_type")).isNull()).alias("_no_fragmentation"),
    ]
    codes = F.array_distinct(
        F.array_compact(
            F.array(
                *problems,
                F.when(F.col("_no_instrument") > 0, F.lit("MissingInstrument")),
                F.when(F.col("_no_fragmentation") > 0, F.lit("MissingFragType")),
            )
        )
    )
    out = runs.groupBy(*by).agg(F.count("*").alias("n_runs"), *aggs, *missing)
    return out.withColumn("problems", F.array_join(codes, ";")).drop("_no_instrument", "_no_fragmentation")


def clean_spectra(spectra: DataFrame, **limits) -> DataFrame:
    """Spectra with cleaned, unit-norm peaks in ``peaks``; poor spectra are dropped."""
    peaks = sp.clean_peaks(
        F.col("mz"), F.col("intensity"), F.col("precursor_mz"), F.col("charge"), **limits
    )
    return spectra.withColumn("peaks", peaks).where("peaks is not null").drop("mz", "intensity")


def fragmentation_types(spectra: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """Scan and fragmentation tag: one ``*`` row for a run with a single type, else one per scan."""
    ms2 = with_filter_facts(spectra).where("ms_level = 2").select(
        *by, tx.scan_number(F.col("spectrum_id").cast("string")).cast("string").alias("scan"),
        F.col("f.frag_tag").alias("frag_tag"),
    )
    types = ms2.groupBy(*by).agg(F.min("frag_tag").alias("lo"), F.max("frag_tag").alias("hi"))
    single = types.where("lo = hi").select(*by, F.lit("*").alias("scan"), F.col("lo").alias("frag_tag"))
    mixed = ms2.join(types.where("lo <> hi").select(*by), list(by), "left_semi")
    return single.unionByName(mixed)


def detected_params(runs: DataFrame, criteria: DataFrame, force: str | None = None) -> DataFrame:
    """Parameters per study: the first run's value, else the study's, else a constant.

    ``force`` sets the acquisition flag only, as a forced workflow does.
    """
    names = ["acquisition_type", "fragmentation_type", "high_accuracy_precursors", "labeling"]
    defaults = dict(zip(names, ["DDA", "HR_HCD", "true", "LFQ"]))
    first = runs.groupBy("pxd").agg(
        F.min_by(F.struct(*names, "max_label_score", "n_label_scores"), "ord").alias("r")
    )
    study = criteria.select("pxd", F.struct(*names).alias("c"))
    both = study.join(first, "pxd", "full")
    value = [F.coalesce(f"r.{n}", f"c.{n}", F.lit(defaults[n])).alias(n) for n in names]
    out = both.select("pxd", *value, "r.max_label_score", "r.n_label_scores").withColumnRenamed(
        "labeling", "raw_labeling"
    )
    label = F.when(F.lower("raw_labeling") == "none", "LFQ").otherwise(F.col("raw_labeling"))
    dia = F.lit(force == "DIA") if force in ("DIA", "DDA") else F.col("acquisition_type") == "DIA"
    return out.withColumn("labeling", label).select(
        "pxd", "acquisition_type", "fragmentation_type", "high_accuracy_precursors", "labeling", "raw_labeling",
        dia.alias("dia"),
        label_confidence(F.col("labeling"), F.col("max_label_score"), F.col("n_label_scores")).alias("confidence"),
    )


def label_confidence(label: Column, max_score: Column, n_scores: Column) -> Column:
    """Largest score for a labelled call, one less it for a label-free call, 0 without scores."""
    return (
        F.when(F.coalesce(n_scores, F.lit(0)) == 0, 0.0)
        .when(label == "LFQ", 1 - max_score)
        .otherwise(max_score)
    )


def label_class(label: Column) -> Column:
    """The rule set a label uses."""
    low = F.lower(F.coalesce(label, F.lit("lfq")))
    return (
        F.when(low.contains("tmtpro"), "TMTpro")
        .when(low.contains("tmt"), "TMT")
        .when(low.contains("itraq8"), "iTRAQ8")
        .when(low.contains("itraq"), "iTRAQ")
        .when(low == "silac", "SILAC")
        .otherwise("LFQ")
    )


def label_mods(df: DataFrame, label: str = "labeling") -> DataFrame:
    """Modification settings per distinct label: rows (source, name, unimod_id, mass, site, fixed)."""
    spark = df.sparkSession
    table = spark.createDataFrame(
        rules.LABEL_MODS,
        "label_class STRING, source STRING, mod STRING, unimod_id INT, mass DOUBLE, site STRING, fixed BOOLEAN",
    )
    labels = df.select(F.col(label).alias("label")).distinct().withColumn("own", label_class(F.col("label")))
    asked = labels.select("label", F.explode(F.array("own", F.lit("*"))).alias("label_class"))
    return asked.join(F.broadcast(table), "label_class").drop("label_class")


def quantification(label: Column) -> Column:
    """Struct of quantification kind, reporter flag and engine settings of a label."""
    kind = label_class(label)
    own = F.lower(F.coalesce(label, F.lit("lfq")))

    def setting(i: int) -> Column:
        pairs = [F.lit(x) for k, v in rules.QUANT_SETTINGS.items() for x in (k, v[i] or "")]
        return tx.blank_to_null(F.try_element_at(F.create_map(*pairs), own))

    return F.struct(
        F.when(kind.isin("TMT", "TMTpro"), "TMT").when(kind.isin("iTRAQ", "iTRAQ8"), "iTRAQ").otherwise(kind).alias("mode"),
        kind.isin("TMT", "TMTpro", "iTRAQ", "iTRAQ8").alias("reporter_ions"),
        setting(0).alias("kind"),
        setting(1).alias("type"),
        setting(2).alias("option"),
    )

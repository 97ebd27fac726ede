import itertools
import math

from pyspark.sql import functions as F

from massloom.operators import denovo, graph, taxa
from massloom.plans import organisms as plan

EDGES = [
    ("A1", 1), ("A2", 1), ("B1", 2), ("C1", 3), ("C2", 3), ("S12", 1), ("S12", 2), ("S234", 3), ("S234", 4),
    ("S234", 2), ("T234", 3), ("T234", 4), ("T234", 2), ("D1", 4),
]
SCORE = {"A1": 0.9, "A2": 0.8, "B1": 0.85, "C1": 0.95, "C2": 0.99, "S12": 0.9, "S234": 0.92, "T234": 0.8, "D1": 0.81}


def edge_table(spark):
    return spark.createDataFrame([(s, t, SCORE[s]) for s, t in EDGES], "sequence string, taxon_id bigint, score double")


def exact(alpha, beta, prior, regularized):
    names = sorted({t for _, t in EDGES})
    total, marginal = 0.0, dict.fromkeys(names, 0.0)
    for bits in itertools.product([0, 1], repeat=len(names)):
        x, w = dict(zip(names, bits)), 1.0
        for t in names:
            w *= prior if x[t] else 1 - prior
        for s, score in SCORE.items():
            k = sum(x[t] for q, t in EDGES if q == s)
            plain = (1 - alpha) ** k * (1 - beta)
            absent = plain**k * (1 - beta) / max(k, 1) if regularized else plain
            w *= (1 - score) * absent + score * (1 - absent)
        total += w
        for t in names:
            marginal[t] += w * x[t]
    return {t: m / total for t, m in marginal.items()}


def check(spark, regularized, alphas, priors):
    grid = [(a, 0.6, p) for a in alphas for p in priors]
    out = graph.taxon_posteriors(
        edge_table(spark), alphas, [0.6], priors, regularized=regularized, tol=1e-4, damping=(0.1,), max_iter=20).collect()
    want = [exact(*g, regularized) for g in grid]
    assert len(out) == 4 * len(grid) and all(r.converged for r in out)
    for r in out:
        assert abs(r.score - want[r.param_id][r.taxon_id]) < 1e-4


def test_posteriors_are_exact_on_a_tree(spark):
    check(spark, True, [0.7, 0.9], [0.1, 0.5])


def test_plain_table_is_exact_on_a_tree(spark):
    check(spark, False, [0.95], [0.3])


def test_infer_taxa_names_the_best_set(spark):
    edges = edge_table(spark)
    weights = edges.groupBy("taxon_id").agg(F.count("*").cast("double").alias("weight"))
    names = edges.select("taxon_id").distinct().withColumn("taxon_name", F.concat(F.lit("t"), "taxon_id"))
    out = plan.infer_taxa(edges, weights, names, [0.7], [0.6, 0.9], [0.1]).collect()
    assert {r.taxon_name for r in out} == {"t1", "t2", "t3", "t4"} and len({r.param_id for r in out}) == 1


def test_components_split_and_drop_small_ones(spark):
    rows = [("p%d" % i, i) for i in range(1, 30)] + [("p%d" % i, i + 1) for i in range(1, 29)] + [("q", 100), ("r", 200), ("r", 201)]
    got = graph.components(spark.createDataFrame(rows, "sequence string, taxon_id bigint")).collect()
    assert {r.component for r in got} == {1, 200}
    assert {(r.component, r.n_nodes) for r in got} == {(1, 58), (200, 3)}


def sets(spark):
    rows = []
    for t in range(1, 25):
        for i in range(40):
            if (i * t) % 7 < 3 + t % 4 or t % 5 == 0:
                rows.append((f"p{i}", t))
        rows.append(("hot", t))
    return sorted(set(rows)), spark.createDataFrame(sorted(set(rows)), "sequence string, taxon_id bigint")


def brute(rows):
    members = {}
    for s, t in rows:
        members.setdefault(t, set()).add(s)
    return members


def test_class_overlap_equals_brute_force(spark):
    rows, df = sets(spark)
    m = brute(rows)
    heads = {}
    for t in sorted(m):
        heads.setdefault(frozenset(m[t]), t)
    names = sorted(heads.values())
    for threshold in (0.5, 0.75, 0.9):
        got = {(r.member, r.head): r.overlap for r in taxa.class_overlap(df, threshold).collect()}
        want = {(a, b): len(m[a] & m[b]) / len(m[a]) for a in names for b in names if a != b and len(m[a] & m[b]) / len(m[a]) > threshold}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_clusters_equal_the_greedy_choice(spark):
    rows, df = sets(spark)
    m = brute(rows)
    weight = {t: float((t * 37) % 11) for t in m}
    order = sorted(m, key=lambda t: (-weight[t], t))
    want, left = set(), list(order)
    while left:
        head = left[0]
        for t in order:
            if len(m[t] & m[head]) / len(m[t]) > 0.75:
                want.add((head, t))
                if t in left:
                    left.remove(t)
    weights = spark.createDataFrame(list(weight.items()), "taxon_id bigint, weight double")
    got = {(r.head, r.member) for r in taxa.cluster_taxa(df, weights, 0.75).collect()}
    assert got == want


def test_weighted_sample_is_stable_and_prefers_weight(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("sequence"), F.when(F.col("id") < 200, 10.0).otherwise(0.1).alias("weight"))
    a = {r.sequence for r in taxa.weighted_sample(df, 150).collect()}
    b = {r.sequence for r in taxa.weighted_sample(df.repartition(9), 150).collect()}
    assert a == b and len(a) == 150 and sum(int(s) < 200 for s in a) > 110
    zero = df.withColumn("weight", F.col("sequence").cast("double") * 0)
    try:
        taxa.weighted_sample(zero, 5).collect()
    except Exception as error:  # noqa: BLE001
        assert "all weights are zero" in str(error)
    else:
        raise AssertionError("no error for zero weights")


def test_goodness_by_hand(spark):
    scores = spark.createDataFrame([(0, 1, 0.5), (0, 2, 0.3), (0, 3, 0.2)], "param_id int, taxon_id bigint, score double")
    weights = spark.createDataFrame([(1, 9.0), (3, 8.0), (2, 7.0)], "taxon_id bigint, weight double")
    r = taxa.goodness(scores, weights).first()
    entropy = -sum(p * math.log(p) for p in (0.5, 0.3, 0.2))
    assert abs(r.overlap - (1 + 0.5 + 1) / 3) < 1e-12 and abs(r.goodness - r.overlap / entropy**2) < 1e-12


def test_digest_by_hand(spark):
    df = spark.createDataFrame([("a", "AAKPCCRDDWKPEEMRPFF")], "accession string, sequence string")
    got = {r.peptide for r in denovo.digest(df, missed=1, min_len=1).collect()}
    assert got == {"AAKPCCR", "DDWK", "PEEMR", "PFF", "AAKPCCRDDWK", "DDWKPEEMR", "PEEMRPFF"}


def test_aa_masks(spark):
    def mask(a, b, mode):
        df = spark.createDataFrame([(a, b)], "truth string, pred string")
        return df.select(denovo.aa_mask(F.col("truth"), F.col("pred"), mode).alias("m")).first().m

    assert mask("PEPTIDE", "PEPTLDE", "best") == [True] * 7  # I and L weigh the same
    assert mask("AGPEK", "GAPEK", "forward") == [False, False, True, True, True]
    assert mask("PEPTIDEK", "PEATIDEK", "forward")[:2] == [True, True]
    assert mask("PEPTIDEK", "PEATIDEK", "best")[-5:] == [True] * 5
    assert mask("PEPTIDEK", "AEPTIDEK", "backward")[-7:] == [True] * 7


def test_aa_match_metrics(spark):
    df = spark.createDataFrame([("PEPTIDE", "PEPTIDE"), ("PEPTIDE", None), ("AGPEK", "GAPEK")], "truth string, pred string")
    r = denovo.aa_match_metrics(df).first()
    assert abs(r.aa_precision - 10 / 12) < 1e-6 and abs(r.aa_recall - 10 / 19) < 1e-6 and abs(r.pep_precision - 1 / 3) < 1e-6


def test_candidates_equal_the_plain_condition(spark):
    from massloom.functions import mass as mz

    spectra = spark.range(300).select(F.col("id").alias("spectrum_id"), (400 + F.col("id") * 0.37).alias("precursor_mz"), (2 + F.col("id") % 3).cast("int").alias("charge"))
    peptides = spark.range(3000).select(F.concat(F.lit("P"), "id").alias("sequence"), (780 + F.col("id") * 0.41).alias("mass"))
    got = denovo.candidates(spectra, peptides).select("spectrum_id", "sequence")
    fits = mz.fits_precursor(mz.mz(F.col("mass"), F.col("charge")), F.col("precursor_mz"), F.col("charge"))
    want = spectra.join(peptides, fits).select("spectrum_id", "sequence")
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0

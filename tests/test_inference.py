"""Posteriors by component, in groups, against enumeration, table rounds and runs of one group alone."""

import itertools
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from massloom.functions import rules
from massloom.operators import graph, inference, taxa
from massloom.plans import organisms as plan

GRID = [(a, b, p) for a in (0.7, 0.95) for b in (0.6, 0.9) for p in (0.1, 0.5)]
SOME = {"alphas": [0.7, 0.95], "betas": [0.6, 0.9], "priors": [0.1, 0.5]}
SCHEMA = "pxd string, run int, sequence string, taxon_id bigint, score double"


def random_edges(rng, taxa_n, peptides, most, tag=""):
    """Each peptide is held by some taxa; each taxon holds at least two."""
    rows = {(f"{tag}p{i}", t) for i in range(peptides) for t in rng.sample(range(taxa_n), rng.randint(1, most))}
    rows |= {(f"{tag}q{t}{x}", t) for t in range(taxa_n) for x in "ab"[: rng.randint(1, 2)]} | {(f"{tag}p0", t) for t in range(2)}
    many = {t for _, t in rows if sum(u == t for _, u in rows) > 1}
    return sorted((s, t, round(0.3 + rng.random() * 0.65, 3)) for s, t in rows if t in many)


def scored(rows):
    """One score a peptide, the largest of its edges."""
    best = {}
    for s, _, x in rows:
        best[s] = max(best.get(s, 0), x)
    return [(s, t, best[s]) for s, t, _ in rows], best


def component(rows, grid=GRID, regularized=True):
    rows, score = scored(rows)
    sets = {}
    for s, t, _ in rows:
        sets.setdefault(s, set()).add(t)
    heads = {}
    for s in sorted(sets):
        heads.setdefault(frozenset(sets[s]), s)
    links = [(heads[frozenset(sets[s])], t, None, None) for s, t, _ in rows if heads[frozenset(sets[s])] == s]
    tallies = [(heads[frozenset(sets[s])], None, score[s], 1) for s in sets]
    pdf = pd.DataFrame(links + tallies, columns=["factor_id", "taxon_id", "score", "n"]).sample(frac=1, random_state=1)
    return inference.Component(pdf, np.array(grid), regularized, False)


def enumerated(rows, grid=GRID, regularized=True):
    rows, score = scored(rows)
    names = sorted({t for _, t, _ in rows})
    out = []
    for alpha, beta, prior in grid:
        total, held = 0.0, np.zeros(len(names))
        for bits in itertools.product([0, 1], repeat=len(names)):
            x, w = dict(zip(names, bits, strict=True)), 1.0
            for b in bits:
                w *= prior if b else 1 - prior
            for s, c in score.items():
                k = sum(x[t] for q, t, _ in rows if q == s)
                plain = (1 - alpha) ** k * (1 - beta)
                absent = plain**k * (1 - beta) / max(k, 1) if regularized else plain
                w *= (1 - c) * absent + c * (1 - absent)
            total += w
            held += w * np.array(bits)
        out.append(held / total)
    return np.array(out)


def test_elimination_equals_enumeration():
    rng = random.Random(1)
    for n, peptides, most in ((2, 1, 2), (4, 5, 3), (7, 9, 3), (9, 12, 4), (10, 6, 6)):
        rows = random_edges(rng, n, peptides, most)
        for regularized in (True, False):
            c = component(rows, regularized=regularized)
            cliques = inference.elimination(len(c.taxa), c.parents)
            assert np.abs(inference.eliminate(c, cliques) - enumerated(rows, regularized=regularized)).max() < 1e-10


def test_elimination_of_a_long_chain_stays_narrow():
    n = 3000
    parents = [np.array([i, i + 1]) for i in range(n - 1)]
    assert max(map(len, inference.elimination(n, parents))) == 2
    assert inference.elimination(40, [np.array(p) for p in itertools.combinations(range(40), 2)]) is None
    assert inference.elimination(13, [np.arange(13)]) is None


def test_colours_never_meet_in_a_factor():
    rng = random.Random(2)
    parents = [np.array(rng.sample(range(60), rng.randint(1, 9))) for _ in range(150)]
    colour = inference.colours(60, parents)
    assert all(len(set(colour[p])) == len(p) for p in parents)


def test_settled_messages_are_exact_on_trees_and_a_fixed_point_on_loops():
    rng = random.Random(3)
    tree = sorted({(f"p{i}", t, 0.5 + (i * 7 % 10) / 25) for i in range(1, 9) for t in (i, i // 2)} | {(f"q{i}", i, 0.9) for i in range(9)})
    sets = np.arange(len(GRID))
    score, rounds, residual = inference.settle(component(tree), 1e-10, 50, sets)
    assert np.abs(score - enumerated(tree)).max() < 1e-8 and (residual <= 1e-10).all() and rounds.max() < 50
    loops = random_edges(rng, 9, 14, 3)
    score, rounds, residual = inference.settle(component(loops), 1e-6, 400, sets)
    assert (residual <= 1e-6).all() and np.abs(score - enumerated(loops)).max() < 0.2  # near, as loops go
    one = [inference.settle(component(loops), 1e-6, 400, np.array([i]))[0][0] for i in sets]
    assert np.abs(score - np.array(one)).max() < 1e-12  # sets do not touch each other


def table(spark, groups):
    rows = [(pxd, run, s, t, x) for (pxd, run), some in groups.items() for s, t, x in scored(some)[0]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def groups(seed):
    rng = random.Random(seed)
    one = random_edges(rng, 8, 8, 3) + [(s, t + 100, x) for s, t, x in random_edges(rng, 5, 4, 2, "z")]
    return {("A", 1): one, ("A", 2): random_edges(rng, 7, 9, 3), ("B", 1): random_edges(rng, 9, 7, 4)}


def test_groups_equal_runs_of_their_own(spark):
    given = groups(4)
    by = ["pxd", "run"]
    got = inference.component_posteriors(table(spark, given), **SOME, by=by).collect()
    assert all(r.converged and r.residual == 0 for r in got)
    for key, rows in given.items():
        mine = {(r.param_id, r.taxon_id): r.score for r in got if (r.pxd, r.run) == key}
        want = {}
        for part in ({t for _, t, _ in rows if t < 100}, {t for _, t, _ in rows if t >= 100}):
            some = [r for r in rows if r[1] in part]
            if some:
                names = sorted(part)
                want |= {(i, t): v for i, row in enumerate(enumerated(some)) for t, v in zip(names, row, strict=True)}
        assert mine.keys() == want.keys() and max(abs(mine[k] - want[k]) for k in want) < 1e-9
    assert {r.component for r in got if r.run == 1 and r.pxd == "A"} >= {100} - {r.component for r in got if r.component > 100}


def test_blocks_and_table_rounds_settle_alike(spark, monkeypatch):
    rng = random.Random(6)
    rows = random_edges(rng, 20, 26, 4)
    edges = spark.createDataFrame(scored(rows)[0], "sequence string, taxon_id bigint, score double")
    few = {"alphas": [0.9], "betas": [0.7], "priors": [0.1, 0.3]}
    rounds = inference.component_posteriors(edges, **few, tol=1e-4, most_edges=0).collect()
    c = component(rows, [(0.9, 0.7, 0.1), (0.9, 0.7, 0.3)])
    score = inference.settle(c, 1e-6, 400, np.arange(2))[0]
    assert len(rounds) == 2 * len(c.taxa) and all(r.converged for r in rounds)
    place = {t: i for i, t in enumerate(c.taxa.tolist())}
    assert max(abs(r.score - score[r.param_id, place[r.taxon_id]]) for r in rounds) < 2e-3


def test_infer_taxa_by_run_equals_each_run_alone(spark):
    given = groups(8)
    edges, by = table(spark, given), ["pxd", "run"]
    weights = edges.groupBy(*by, "taxon_id").agg(F.sum("score").alias("weight"))
    names = edges.select("taxon_id").distinct().withColumn("taxon_name", F.concat(F.lit("t"), "taxon_id"))
    together = plan.infer_taxa(edges, weights, names, [0.7, 0.95], [0.6, 0.9], [0.1, 0.5], by=by).collect()
    for pxd, run in given:
        own = (F.col("pxd") == pxd) & (F.col("run") == run)
        alone = plan.infer_taxa(edges.where(own).drop(*by), weights.where(own).drop(*by), names, [0.7, 0.95], [0.6, 0.9], [0.1, 0.5]).collect()
        a = sorted((r.taxon_id, r.param_id, round(r.score, 10), r.taxon_name) for r in together if (r.pxd, r.run) == (pxd, run))
        assert a and a == sorted((r.taxon_id, r.param_id, round(r.score, 10), r.taxon_name) for r in alone)


def test_components_by_group(spark):
    rows = [("A", 1, "x", 1, 0.5), ("A", 1, "x", 2, 0.5), ("A", 2, "x", 2, 0.5), ("A", 2, "x", 3, 0.5), ("A", 2, "y", 3, 0.5), ("A", 2, "y", 4, 0.5), ("B", 1, "y", 9, 0.5)]
    got = graph.components(spark.createDataFrame(rows, SCHEMA), ["pxd", "run"]).collect()
    assert {(r.pxd, r.run, r.component, r.n_nodes) for r in got} == {("A", 1, 1, 3), ("A", 2, 2, 5)}


def overlaps(members, threshold):
    heads = {}
    for t in sorted(members):
        heads.setdefault(frozenset(members[t]), t)
    names = sorted(heads.values())
    return {(a, b): len(members[a] & members[b]) / len(members[a]) for a in names for b in names
            if a != b and len(members[a] & members[b]) > threshold * len(members[a])}


def test_overlap_by_group_and_in_parts(spark, monkeypatch):
    rng = random.Random(9)
    sets = {g: {t: {f"p{x}" for x in rng.sample(range(60), rng.randint(3, 50))} | {"hot"} for t in range(25)} for g in ("A", "B", None)}
    for g in sets:
        sets[g][30] = set(sets[g][3])
        sets[g][31] = {f"p{x}" for x in range(60)}
        sets[g][32] = {f"p{x}" for x in range(58)}
    sets.pop(None)
    rows = [(g, s, t) for g, of in sets.items() for t, ss in of.items() for s in ss]
    df = spark.createDataFrame(rows, "pxd string, sequence string, taxon_id bigint").repartition(4)
    for most in (1 << 16, 16):
        monkeypatch.setattr(taxa, "PART_PEPTIDES", most)
        for threshold in (0.5, 0.9):
            got = {}
            for r in taxa.class_overlap(df, threshold, by=["pxd"]).collect():
                got.setdefault(r.pxd, {})[r.member, r.head] = r.overlap
            for g in sets:
                want = overlaps(sets[g], threshold)
                assert got.get(g, {}).keys() == want.keys() and all(abs(got[g][k] - want[k]) < 1e-12 for k in want)


def test_a_family_of_near_copies_equals_brute_force(spark):
    rng = np.random.default_rng(10)
    n, width = 1200, 150
    held = rng.random((n, width)) > 0.03
    held[600:, :20] = False
    other = rng.random((300, 400)) < 0.05  # taxa that share little
    rows = [(f"p{j}", int(i)) for i, j in np.argwhere(held)] + [(f"r{j}", 5000 + int(i)) for i, j in np.argwhere(other)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["sequence", "taxon_id"])).repartition(4)
    both = np.zeros((n + 300, width + 400))
    both[:n, :width], both[n:, width:] = held, other
    both = both[np.lexsort(both.T)]
    both = both[np.append(True, (np.diff(both, axis=0) != 0).any(axis=1)) & (both.sum(axis=1) > 0)]  # classes of equal sets
    shared = both @ both.T
    keep = (shared > 0.9 * both.sum(axis=1)[:, None]) & ~np.eye(len(both), dtype=bool)
    got = taxa.class_overlap(df, 0.9).agg(F.count("*").alias("pairs"), F.sum("shared").alias("shared"), F.sum("overlap").alias("overlap")).first()
    assert got.pairs == keep.sum() > 100_000 and got.shared == shared[keep].sum()
    assert abs(got.overlap - (shared / both.sum(axis=1)[:, None])[keep].sum()) < 1e-6 * got.pairs


def test_lookup_never_shuffles_the_bucketed_table(spark):
    edges = spark.range(5000).select(F.concat(F.lit("P"), F.col("id") % 900).alias("sequence"), F.col("id").alias("taxon_id"))
    asked = spark.range(200).select(F.concat(F.lit("P"), F.col("id") * 3).alias("sequence"))
    table = taxa.write_peptide_taxa(edges, "dimension", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = taxa.lookup_taxa(asked, table)
        plan_text = found._jdf.queryExecution().executedPlan().toString()
        assert found.exceptAll(edges.join(asked, "sequence", "left_semi")).isEmpty() and found.count() > 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above_scan = plan_text[: plan_text.index("FileScan parquet")].splitlines()
    large = [line for line in above_scan if "Exchange" in line]
    assert "Bucketed: true" in plan_text and not large, plan_text


def test_rules_grid_is_the_default(spark):
    rows = [("a", 1, 0.9), ("b", 1, 0.8), ("b", 2, 0.8), ("c", 2, 0.7)]
    out = inference.component_posteriors(spark.createDataFrame(rows, "sequence string, taxon_id bigint, score double"))
    assert out.count() == 2 * len(rules.GRID_ALPHA) * len(rules.GRID_BETA) * len(rules.GRID_PRIOR)


def test_parents_of_all_factors_share_one_array(spark):
    rows = random_edges(random.Random(3), 40, 60, 4)
    c = component(rows)
    assert len(c.parents) > 20 and len({id(p.base) for p in c.parents}) == 1  # else a copy of all edges for each factor


def test_lists_of_a_factor_become_its_rows():
    lists = pd.DataFrame({"factor_id": ["a", "b"], "taxa": [[3, 2**60 + 1], [3]], "scores": [[0.5, None], [0.25]], "counts": [[1, 2], [4]]})
    got = inference._long(lists)
    links, tallies = got[got["taxon_id"].notna()], got[got["taxon_id"].isna()]
    assert list(zip(links["factor_id"], links["taxon_id"])) == [("a", 3), ("a", 2**60 + 1), ("b", 3)]
    assert tallies["factor_id"].tolist() == ["a", "a", "b"] and tallies["n"].tolist() == [1, 2, 4]
    assert np.isnan(tallies["score"].iloc[1]) and tallies["score"].iloc[2] == 0.25


def test_a_dense_component_is_coloured_once(monkeypatch):
    c, seen, real = component(random_edges(random.Random(5), 30, 60, 20)), [], inference.colours
    together = inference.solve_component(c, 1e-6, 400)
    monkeypatch.setattr(inference, "colours", lambda *a: seen.append(1) or real(*a))
    monkeypatch.setattr(inference, "SETTLE_CELLS", 1)  # one parameter set at a time
    alone = inference.solve_component(c, 1e-6, 400)
    assert len(seen) == 1 and (together[1] > 0).all()
    assert all(np.array_equal(a, b) for a, b in zip(together, alone, strict=True))


def test_a_graph_of_some_million_edges_is_dealt_by_parameter_sets(spark, monkeypatch):
    assert inference.MOST_EDGES >= 3_600_000  # all of a table's rows as one component, not table rounds of every edge and set
    monkeypatch.setattr(inference, "BATCH_EDGES", 64)
    edges = spark.createDataFrame(random_edges(random.Random(5), 30, 60, 20), "sequence string, taxon_id bigint, score double")
    out = inference.component_posteriors(edges, **SOME)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan  # few groups, but each has much to do
    assert out.count() == 30 * len(GRID)


def test_classes_that_share_their_smallest_peptide_only_are_not_compared(spark, monkeypatch):
    rng, seen, real = random.Random(11), [], taxa.checkpoint
    monkeypatch.setattr(taxa, "checkpoint", lambda df: seen.append(real(df)) or seen[-1])
    sets = {t: {f"p{i}" for i in rng.sample(range(400), 60)} for t in range(80)}
    sets |= {100 + t: set(sorted(sets[t])[1:]) for t in range(20)}
    edges = spark.createDataFrame([(t, p) for t, s in sets.items() for p in s], "taxon_id long, sequence string")
    got = {(r.member, r.head): r.shared for r in taxa.class_overlap(edges, 0.9).collect()}
    assert got == {p: 59 for t in range(20) for p in ((t, 100 + t), (100 + t, t))}
    met = next(df for df in seen if {"mb", "hb"} <= set(df.columns))
    held = next(df for df in seen if "limit" in df.columns).groupBy("block").agg(F.count("*").alias("n"))
    both = met.join(held.select(F.col("block").alias("mb"), F.col("n").alias("a")), "mb").join(held.select(F.col("block").alias("hb"), F.col("n").alias("b")), "hb")
    assert both.agg(F.sum(F.col("a") * F.col("b"))).first()[0] < 1000  # of 10,000 pairs of classes

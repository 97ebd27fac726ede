import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from massloom.catalog import registry
from massloom.functions import counting
from massloom.operators import psm, taxa


def plan(df):
    return df._jdf.queryExecution().toString()


def test_numbering_a_dia_report_does_not_make_its_rows_again(spark):
    rows = [("r1", f"PEP(UniMod:{i % 2 * 34 + 1})K{'A' * (i % 3)}", "P1", float(i), str(i)) for i in range(9)]
    report = spark.createDataFrame(rows, "Run string, `Modified.Sequence` string, `Protein.Ids` string, RT double, `Precursor.Id` string")
    report = report.withColumn("Precursor.Id", F.md5("`Precursor.Id`"))
    unimod = spark.createDataFrame([(1, 42.010565), (35, 15.994915)], "unimod_id int, mono_mass double")
    out = psm.dia_to_psm(report, unimod, order=["diann_precursor_id"])
    assert "md5" not in plan(out) and "regexp" not in plan(out).lower()
    got = out.orderBy("psm_id").collect()
    assert [r.psm_id for r in got] == list(range(1, 10))
    assert [r.diann_precursor_id for r in got] == sorted(r.diann_precursor_id for r in got)
    assert {r.peptide for r in got} == {f"PEP[+{m}]K{'A' * n}" for i in range(9) for m, n in [(("42.010565", "15.994915")[i % 2], i % 3)]}


def test_weights_of_selected_taxa_are_made_once(spark):
    weights = spark.range(60).select(F.col("id").alias("taxon_id"), (F.crc32(F.md5(F.col("id").cast("string"))) % 100).cast("double").alias("weight"), (F.col("id") % 20 == 0).alias("unique_taxon"))
    out = taxa.selected_taxa(weights, 5, few=50)
    assert "md5" not in plan(out)
    rows = sorted((-r.weight, r.taxon_id) for r in weights.collect())
    assert {r.taxon_id for r in out.collect()} == {t for _, t in rows[:5]} | {0, 20, 40}


def test_selected_edges_read_the_matches_for_edges_and_scores_only(spark):
    out = registry.queries()["w04_j06_selected_edges"](spark, "/root/testdata/sf0.001")
    assert "lineitem" not in plan(out)


def test_rows_of_one_length_go_through_the_tree_together(monkeypatch):
    rng, calls, tree = np.random.default_rng(1), [], counting.tree_messages
    sizes = [12, 40, 12, 40, 40, 9]
    present = pd.Series([*[rng.random(n) for n in sizes], None], dtype=object)
    likelihood = pd.Series([*[rng.random(n + 1) for n in sizes], None], dtype=object)
    monkeypatch.setattr(counting, "tree_messages", lambda p, g: calls.append(p.shape) or tree(p, g))
    got = next(counting._tree.func(iter([(present, likelihood)])))
    assert sorted(calls) == [(1, 9), (2, 12), (3, 40)] and got["absent"].isna().tolist() == [False] * 6 + [True]
    for i in range(len(sizes)):
        absent, there = tree(present[i][None], likelihood[i][None])
        assert np.abs(got["absent"][i] - absent[0]).max() < 1e-12 and np.abs(got["present"][i] - there[0]).max() < 1e-12

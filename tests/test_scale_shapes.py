"""Shapes of plans and of written folders that keep a job within its limits on larger tables."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from massloom.catalog import formats, projects
from massloom.catalog.inputs import Inputs
from massloom.operators import denovo, documents, mods, psm, ranking, runs, taxa
from massloom.sources import sinks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def reference(spark):
    return spark.range(200).select(
        F.col("id").cast("int").alias("unimod_id"), F.concat(F.lit("m"), "id").alias("mod_name"), (F.col("id") * 0.5).alias("mono_mass"),
        F.lit("Anywhere").alias("position"), F.lit("K").alias("site"), F.lit(False).alias("hidden"))


def test_no_join_broadcasts_the_modification_reference(spark):
    masses = spark.createDataFrame([(0.5, "K", None), (3.004, None, "N-term")], "mass double, residue string, term string")
    found = mods.match_mods(masses, reference(spark))
    assert "Broadcast" not in plan_of(found)
    assert {(r.mass, r.unimod_id) for r in found.collect()} == {(0.5, 1), (3.004, 6)}


def fitting(spark):
    """Two isotopes of a heavy pair fit, one charge is null, rows are repeated, two peptides tie."""
    spectra = spark.createDataFrame(
        [(1, 12000.0, 2), (1, 12000.0, 2), (2, 500.0, 2), (2, 500.0, None), (None, 500.0, 2)], "spectrum_id long, precursor_mz double, charge int")
    heavy, light = 12000.0 * 2 - 2 * 1.007276466879, 500.0 * 2 - 2 * 1.007276466879
    peptides = spark.createDataFrame(
        [("H", heavy - 0.4), ("H", heavy - 0.4), ("I", heavy - 0.7), ("A", light + 0.01), ("B", light + 0.01), ("C", light - 0.02), ("D", None)], "sequence string, mass double")
    return spectra, peptides


def test_candidate_pairs_are_not_shuffled(spark):
    spectra, peptides = fitting(spark)
    found = denovo.candidates(spectra, peptides)
    plan = plan_of(found)
    assert not re.search(r"Aggregate.*isotope", plan.split("Join", 1)[0])
    rows = sorted((str(r.spectrum_id), r.sequence, r.isotope) for r in found.collect())
    assert rows == [("1", "H", 0), ("1", "I", 1), ("2", "A", 0), ("2", "B", 0), ("2", "C", 0), ("None", "A", 0), ("None", "B", 0), ("None", "C", 0)]


def test_candidate_summary_takes_the_closest(spark):
    got = {r.spectrum_id: (r.n_candidates, r.sequence, round(r.ppm, 3)) for r in denovo.candidate_summary(*fitting(spark)).collect()}
    assert got == {1: (2, "I", got[1][2]), 2: (3, "A", 10.0), None: (3, "A", 10.0)}


@pytest.mark.parametrize("name", ["s17_read_annotations", "s09_read_publication", "s12_read_hints", "s16_read_llm_files"])
def test_folders_are_written_by_several_tasks(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(formats, "scratch_dir", lambda _, part: str(tmp_path / part))
    rows = spark.range(40).selectExpr("id as s_suppkey", "concat('Supplier#', id) as s_name", "cast(id % 25 as int) as s_nationkey", "0.5D as s_acctbal")
    rows.coalesce(1).write.parquet(str(tmp_path / "tables" / "supplier.parquet"))
    out = getattr(formats, name)(Inputs(spark, str(tmp_path / "tables")))
    assert out.select("pxd").distinct().count() == 40
    files = [f for f in glob.glob(f"{tmp_path}/**/part-*", recursive=True) if "supplier.parquet" not in f]
    assert len(files) == 40 and len({os.path.basename(f)[:10] for f in files}) > 4


def test_folders_of_a_mounted_system_are_written_without_hadoop(spark, tmp_path):
    """Hadoop's local file system starts processes for each file; the folders are those of Spark's writer."""
    rows = [("a=b/c", "x y", "1"), ("a=b/c", "x y", None), (None, "", "2\n3"), ("p%é^", "0.0", ""), ("q}{", "t", "ü"), ("a=b/c", "z", "4")]
    df = spark.createDataFrame(rows, "pxd string, temp string, value string")
    formats._write_folders(df, f"file://{tmp_path}/own", "pxd", "temp")
    df.write.partitionBy("pxd", "temp").text(f"{tmp_path}/spark")

    def held(path):
        found = {}
        for f in glob.glob(f"{tmp_path}/{path}/*/*/part-*"):
            found.setdefault(os.path.relpath(os.path.dirname(f), f"{tmp_path}/{path}"), []).extend(open(f, encoding="utf-8").read().split("\n"))
        return {k: sorted(v for v in lines if v) for k, lines in found.items()}, {k: len(lines) for k, lines in found.items() if k.startswith("pxd=a")}

    assert held("own")[0] == held("spark")[0] and len(held("own")[0]) == 5
    assert sorted(map(tuple, spark.read.text(f"{tmp_path}/own").collect())) == sorted(map(tuple, spark.read.text(f"{tmp_path}/spark").collect()))
    assert not glob.glob(f"{tmp_path}/own/**/.*.crc", recursive=True)


def test_alignment_neither_joins_nor_shuffles(spark):
    pairs = spark.createDataFrame([("AGPEK", "GAPEK"), ("AGPEK", "AGPEK"), ("AGPEK", None), (None, None)], "truth string, pred string")
    for mode in ("best", "forward", "backward"):
        found = denovo.aa_matches(pairs, mode)
        assert not re.search("Exchange|Join|Aggregate", plan_of(found))
        rows = {(r.truth, r.pred): r.aa_match for r in found.collect()}
        assert rows["AGPEK", "AGPEK"] == [True] * 5 and rows["AGPEK", None] == [False] * 5 and rows[None, None] == []


def test_the_first_of_several_meetings_counts(spark):
    df = spark.createDataFrame([("AXG", "AXG+0.05"), ("A+5.9.1G", "AG"), ("", "G")], "truth string, pred string")
    got = [r.m for r in df.select(denovo.aa_mask(F.col("truth"), F.col("pred"), "forward").alias("m")).collect()]
    assert got == [[True, False, True], [True, True], [False]]  # X weighs nothing, so A meets both A and X


def test_proteins_are_dealt_by_their_residues(spark, monkeypatch):
    monkeypatch.setattr(denovo, "DIGESTED", 100)
    proteins = spark.range(50).select(F.concat(F.lit("P"), "id").alias("accession"), F.repeat(F.lit("AEPTIDEK"), 3).alias("sequence")).coalesce(1)
    found = denovo.digest(proteins)
    assert "12), REPARTITION_BY_NUM" in plan_of(found)
    assert found.count() == 150 and found.select("peptide").distinct().count() == 3


def test_peaks_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(runs, "PEAKS_OF_TASK", 100)
    spectra = spark.range(40).select(
        F.col("id").alias("spectrum_id"), F.lit("run").alias("filename"), F.lit(2).alias("ms_level"),
        F.lit("FTMS + p NSI d Full ms2 501.10@hcd30.00 [100.00-1500.00]").alias("filter_string"))
    peaks = spark.range(1000).select((F.col("id") % 40).alias("spectrum_id"), F.lit(126.1277).alias("mz"), F.lit(1.0).alias("intensity"))
    found = runs.composite_from_peaks(spectra, peaks)
    assert plan_of(found).count("10), REPARTITION_BY_NUM") == 2
    assert [(r.n_peaks, r.intensity) for r in found.collect()] == [(40, 40.0)]


def test_sorted_files_follow_the_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_OF_FILE", 100)
    rows = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("key"))
    sinks.write_tsv(rows, str(tmp_path / "out"), ["key"])
    files = sorted(glob.glob(f"{tmp_path}/out/part-*"))
    held = [[int(x) for x in open(f).read().split()[1:]] for f in files]
    assert 15 <= len(files) <= 20 and max(map(len, held)) < 400
    assert [k for f in held for k in f] == list(range(2000))


def test_a_run_is_cut_into_files_with_headers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(formats, "scratch_dir", lambda _, part: str(tmp_path / part))
    monkeypatch.setattr(formats, "ROWS_OF_FILE", 50)
    rows = spark.range(500).selectExpr(
        "0L as l_suppkey", "id as l_partkey", "0.05D as l_discount", "0.02D as l_tax", "cast(id % 7 as int) as l_linenumber", "id * 1.0D as l_extendedprice")
    rows.write.parquet(str(tmp_path / "tables" / "lineitem.parquet"))
    got = formats.s04_p04_read_mztab(Inputs(spark, str(tmp_path / "tables"))).collect()
    assert [(r.run, r.n, round(r.score, 6)) for r in got] == [("run_0", 500, 250.0)]
    files = glob.glob(f"{tmp_path}/mztab/run=run_0/part-*")
    assert len(files) > 4 and all(open(f).readline().startswith("MTD") for f in files)


def test_best_match_sorts_rows_after_the_shuffle_only(spark, monkeypatch):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 9 > 0, "a").alias("filename"), (F.col("id") % 400).cast("string").alias("scannr"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 7 % 13).cast("double")).alias("hyperscore"), F.col("id").alias("more"))

    def sorts_below(df):
        text = plan_of(df)
        return "Sort [" in text[text.index("Exchange"):]

    best = psm.best_psm(rows)
    assert not sorts_below(best)
    assert ranking.sparse(rows, ["filename"], most=1000) and not ranking.sparse(rows, ["filename"], most=500)
    monkeypatch.setattr(psm, "sparse", lambda *_: False)  # as if one spectrum had very many rows
    cut = psm.best_psm(rows)
    assert sorts_below(cut) and sorted(map(repr, cut.collect())) == sorted(map(repr, best.collect()))


def test_protocols_of_a_project_are_read_once(spark, monkeypatch):
    read, facts = spark.sparkContext.accumulator(0), documents.protocol_facts

    def counted(text):
        read.add(1)
        return text

    seen = F.udf(counted, "string").asNondeterministic()
    monkeypatch.setattr(documents, "protocol_facts", lambda projects: facts(projects).withColumn("protocol_mods", F.when(seen("pxd") != "", F.col("protocol_mods"))))
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    out = projects.a29_w07_sdrf(inputs)
    assert out.count() == inputs.table("orders").count()
    assert read.value == inputs.table("customer").count()


def test_small_tiles_of_the_overlap_share_a_group(spark, monkeypatch):
    rows = [(f"{run}{p}", t * 100 + run) for run in range(3) for t in range(1, 9) for p in range(30) if (p * t) % 11 > 0 or t % 4 == 0]
    edges = spark.createDataFrame(rows, "sequence string, taxon_id bigint")
    shared = taxa.class_overlap(edges, 0.8)
    text = plan_of(shared)
    assert "_slot" in text[text.index("FlatMapCoGroupsInPandas"):].splitlines()[0]
    got = sorted(map(repr, shared.collect()))
    monkeypatch.setattr(taxa, "BATCH_PEPTIDES", 1)  # each tile by itself
    assert got and got == sorted(map(repr, taxa.class_overlap(edges, 0.8).collect()))

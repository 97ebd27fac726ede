"""Columns whose names operators might use inside, ids of other types, folders of other file systems."""

import random

from odd import FOLDER, docs, prose
from pyspark.sql import functions as F

from corpus_pipeline import drop_near_duplicates
from massloom.llm import warc
from massloom.llm.decontaminate import find_leaks
from massloom.llm.quality import classify
from massloom.llm.secret_scan import mask_secrets, secret_spans


def test_masking_keeps_columns_of_any_name(spark):
    names = ["_key", "_text", "_masked", "key", "row", "masked", "of", "parts", "a.b", "uid", "repo", "owner"]
    rows = [(1, "password = hunter2hunter2 ok", *names), (2, None, *names), (None, "x AKIA" + "Z9" * 10, *names), (1, "password = hunter2hunter2 ok", *names), (3, "", *names)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    table = spark.createDataFrame(rows, schema)
    out = mask_secrets(table, repo=F.col("`a.b`"), owner=F.lit("me"))  # there is no column source
    assert out.columns == table.columns
    got = sorted(out.collect(), key=repr)
    assert all(list(r[2:]) == names for r in got)
    texts = {(r.doc_id, r.text) for r in got}
    assert len(got) == 5 and {(2, None), (3, "")} <= texts and not any("hunter2" in (t or "") or "AKIA" in (t or "") for _, t in texts)


def test_no_secret_is_written_in_clear(spark):
    given = docs(spark, [(i, f"token: s3cr3tvalue{i % 3}xyz") for i in range(9)])
    _, spans = secret_spans(given, repo=F.col("source"), owner=F.col("source"))
    assert "value" not in spans.columns and "value" not in str(spans.schema)


def test_near_duplicates_keep_a_row_column(spark):
    rng = random.Random(1)
    text = prose(rng, 60)
    rows = [(1, text, "r0", 5, "k"), (2, text, "r1", 6, "l"), (3, prose(rng, 60), "r2", 7, "m")]
    table = spark.createDataFrame(rows, "doc_id long, text string, row_0 string, _row int, row_1 string")
    got = drop_near_duplicates(spark, table, FOLDER)
    assert got.columns == table.columns
    assert sorted(map(tuple, got.collect())) == [rows[0], rows[2]]


def test_items_with_text_ids(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank at dawn"
    bench = spark.createDataFrame([("q/1", item), ("007", "another item that no document holds at all")], "item_id string, text string")
    got = find_leaks(docs(spark, [(5, f"see: {item}!"), (6, "nothing")]), bench).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in got] == [(5, "q/1", 0)]


def test_quality_takes_tables_with_its_inner_names(spark):
    rows = [(i, "word " * (i % 9 + 1), "a", "b", "c") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _id string, _label string, _text string")
    labels = spark.createDataFrame([(i, i % 2, "z") for i in range(40)], "doc_id long, quality int, _id string")
    assert classify(table, labels).count() == 40


def test_folders_as_spark_names_them():
    assert warc.pyarrow_uri("s3a://bucket/a/b") == warc.pyarrow_uri("s3n://bucket/a/b") == "s3://bucket/a/b"
    assert warc.pyarrow_uri("hdfs://host/a") == "hdfs://host/a" and warc.filesystem("/tmp/x")[1] == warc.filesystem("file:///tmp/x")[1] == "/tmp/x"

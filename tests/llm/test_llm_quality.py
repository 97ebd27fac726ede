import random
import zlib

import numpy as np
import pandas as pd
from odd import docs, no_docs, odd_docs, prose

from massloom.llm.quality import classify, fit, score_texts, text_features

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, score double"


def test_held_out_accuracy(spark):
    table, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    got = classify(table, labels).toPandas()
    assert len(got) == table.count() and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()
    known = got.merge(pd.read_parquet(f"{FOLDER}/labels.parquet"), on="doc_id")
    fresh = known[known["held_out"]]
    assert (fresh["predicted"] == fresh["quality"]).mean() >= 0.95
    assert fresh.loc[fresh["quality"] == 1, "predicted"].mean() >= 0.97


def test_held_out_labels_are_not_used(spark):
    table, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    given = pd.read_parquet(f"{FOLDER}/labels.parquet")
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in given["doc_id"]]
    given.loc[held, "quality"] = 1 - given.loc[held, "quality"]
    a = classify(table, labels).toPandas().set_index("doc_id")["score"]
    b = classify(table, spark.createDataFrame(given)).toPandas().set_index("doc_id")["score"]
    assert np.allclose(a, b.loc[a.index])


def test_weights_are_the_minimum_of_the_pair_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ [2.0, -1.0, 0.0] + rng.logistic(size=400) > 0).astype(int)
    model = fit(x, y)
    good, bad = x[y == 1], x[y == 0]
    raw = (x - model["mid"]) @ model["w"]
    order = (good @ model["w"])[:, None] > (bad @ model["w"])[None, :]
    assert order.mean() > 0.85 and model["w"][0] > 0 > model["w"][1]
    assert np.isclose((raw < model["cut"]).mean(), (y == 0).mean(), atol=0.01)


def test_features_take_any_text():
    got = text_features(["", " ", "x" * 50_000, "é", "a b"] * 3)
    assert got.shape[0] == 15 and np.isfinite(got).all() and (got[:5] == got[5:10]).all()
    assert score_texts(None, ["a", ""]).tolist() == [0.7, 0.7]


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 80) if i % 2 else "JUNK!! " * 30) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2, 0, 0.0) for i in range(100)] + [(None, 1, 0, 0.0), (1, None, None, 0.0), (2, 7, 0, 0.0)], LABELS)
    given = docs(spark, rows).union(odd_docs(spark))
    got = classify(given, labels).collect()
    assert len(got) == 113 and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert classify(no_docs(spark), labels).count() == 0
    none = classify(given, spark.createDataFrame([], LABELS)).collect()
    assert {r.score for r in none} == {0.7} and {r.predicted for r in none} == {1}

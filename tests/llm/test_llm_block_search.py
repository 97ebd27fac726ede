import numpy as np
import pandas as pd
import pytest
from odd import FOLDER
from pyspark.sql import functions as F

from massloom.llm.block_search import _coded, _products, nearest

SCHEMA = "vec_id long, embedding array<float>, score int, dims int"


def brute(ids, x, asks, k=5):
    n = np.sqrt((x * x).sum(1))
    out = set()
    for q in np.flatnonzero(asks):
        s = (x * x[q]).sum(1) / (n * n[q])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
        out |= {(int(ids[q]), r + 1, int(ids[j]), round(float(s[j]), 12)) for r, j in enumerate(order)}
    return out


def rows(df):
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in df.collect()}


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 17)])
def test_equals_brute_force(spark, blocks):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    given = pd.read_parquet(f"{FOLDER}/embeddings.parquet")
    x, ids = np.array([np.asarray(v, float) for v in given.embedding]), given.vec_id.to_numpy()
    got = nearest(table, F.col("vec_id") % 10 == 0, query_block=blocks[0], row_block=blocks[1])
    assert rows(got) == brute(ids, x, ids % 10 == 0)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 1500)) * rng.uniform(1e-3, 1e3, (40, 1))
    c, s, e = _coded(x)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert (_products(c, c) == c.astype(int) @ c.astype(int).T).all()
    assert (np.abs(unit @ unit.T - _products(c, c) * s[:, None] * s) <= e[:, None] * (1 + e) + e + 1e-9).all()


def test_odd_vectors_and_ties(spark):
    given = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (2, [3.0, 0.0]), (3, [float("nan"), 1.0]),
             (4, [None, 1.0]), (5, [float("inf"), 1.0]), (6, [0.0, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (8, []), (150, [1.0, 0.0, 1.0])]
    got = nearest(spark.createDataFrame([(*g, 1, 1) for g in given], SCHEMA), F.col("vec_id") % 50 == 0)
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect())
    assert found == [(0, 1, 1), (0, 2, 2), (0, 3, 6), (150, 1, 7)]
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_copies_in_a_third_of_all_rows(spark):
    given = [(i, [1.0, 1.0] if i % 3 == 0 else [float(i), 1.0], 1, 1) for i in range(150)]
    got = nearest(spark.createDataFrame(given, SCHEMA), F.col("vec_id") % 50 == 0, query_block=2, row_block=16)
    x, ids = np.array([g[1] for g in given]), np.arange(150)
    assert rows(got) == brute(ids, x, ids % 50 == 0)

import math

import numpy as np
import pytest
from odd import FOLDER
from pyspark.sql import functions as F

from massloom.llm.slice_search import _bitmap, _rows, added, at_least, codes_of, search_block, signed_digits, sliced, top_products, top_rows

SCHEMA = "vec_id long, embedding array<double>, score string, dims int, code int, rb int, ids string, width int"
EXTRA = ("s", 1, 2, 3, "i", 4)


def brute(rows, k=10, every=100, scale=1024):
    good = {(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in {i for i, _ in good if i % every == 0}:
        best = {}
        for own, a in good:
            for i, b in good if own == q else ():
                if i != q and len(a) == len(b):
                    s = max(min(sum(x * y for x, y in zip(a, b, strict=True)), 2**63 - 1), -(2**63))
                    best[i] = max(best.get(i, s), s)
        out |= {(q, r, i, s) for r, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:k], 1)}
    return {(q, r, i, -s) for q, r, i, s in out}


def found(spark, rows, every=100, **options):
    table = spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], SCHEMA)
    return {tuple(r) for r in top_products(table, F.col("vec_id") % every == 0, **options).collect()}


@pytest.mark.parametrize("most", [0, 3, 8, 64])
@pytest.mark.parametrize("blocks", [(16384, 4096), (37, 3)])
def test_equals_brute_force(spark, blocks, most):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert found(spark, given, 50, row_block=blocks[0], query_block=blocks[1], most=most) == brute(given, every=50)


def test_index_returns_its_codes():
    rng = np.random.default_rng(1)
    for codes in (rng.integers(-500, 500, (130, 7)), np.full((3, 2), -9), np.array([[2**63 - 1, -(2**63)], [-(2**63), 5]]), np.zeros((1, 0), np.int64)):
        low, slices = sliced(codes.astype(np.int64))
        assert (codes_of(low, slices, len(codes)) == codes).all()


def test_digits_and_sums():
    rng = np.random.default_rng(2)
    q = np.append(rng.integers(-400, 400, 9), [0, 2**63 - 1, -(2**63)])
    d, p, neg = signed_digits(q)
    assert [sum((-1 if s else 1) << int(i) for c, i, s in zip(d, p, neg, strict=True) if c == at) for at in range(len(q))] == q.tolist()
    codes = rng.integers(0, 1000, (70, 9))
    low, slices = sliced(codes)
    digits = signed_digits(q[:9])
    for skip in (0, 4):
        sums = added(np.stack([slices, ~slices]), digits, skip)
        over, whole = codes - low, (1 << slices.shape[1]) - 1
        want = sum((1 << int(i)) * (((whole - over[:, c]) if s else over[:, c]) >> skip) for c, i, s in zip(*digits, strict=True))
        got = sum(np.unpackbits(s.view(np.uint8), count=70, bitorder="little").astype(object) << j for j, s in enumerate(sums))
        assert got.tolist() == want.tolist()


def test_selection_by_slices():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 40, 200)
    slices = [_bitmap((values >> j & 1).astype(bool)) for j in range(6)]
    rows = _bitmap(np.arange(200) % 3 > 0)
    on = np.arange(200) % 3 > 0
    for k in (1, 5, 30):
        value, top = top_rows(slices, rows, k)
        assert value == np.sort(values[on])[-k] and _rows(top).tolist() == np.flatnonzero(on & (values >= value)).tolist()
    for least in (-1, 0, 7, 39, 40):
        assert _rows(at_least(slices, rows, least)).tolist() == np.flatnonzero(on & (values >= least)).tolist()


def test_odd_vectors_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (100, [0.0, 0.0]), (200, None), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [-3.0, 1.0]), (3, [nan, 1.0]), (4, [None, 1.0]),
            (5, [inf, 1.0]), (None, [9.0, 9.0]), (6, [1.0, 1.0, 1.0]), (300, [1.0, 0.0, 1.0]), (7, []), (400, []), (8, [-1e-9, 0.4]), (500, [1e300, -1e300]), (9, [1e300, 1e18]), (0, [0.5, 0.5])]
    assert found(spark, rows[:16]) == brute(rows[:16])
    got = {(q, r): (i, s) for q, r, i, s in found(spark, rows)}
    assert got[500, 1] == (9, 2**63 - 1) or got[500, 1][1] == 2**63 - 1
    assert found(spark, []) == set()


def test_one_id_and_one_vector_hold_a_third_of_all_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(7 if i % 3 == 0 else i, [1.0, float(i % 5), 1.0] if i % 3 == 1 else rng.normal(size=3).tolist()) for i in range(301)]
    assert found(spark, rows, 50, row_block=64, query_block=2, k=4) == brute(rows, 4, 50)


def test_a_block_without_own_rows():
    low, slices = sliced(np.array([[1, 2], [3, 4]]))
    got = search_block(np.array([5, 6]), low, slices, np.array([9]), np.array([[1, 1]]), 3)
    assert got.values.tolist() == [[9, 6, 7], [9, 5, 3]]

import hashlib
import math

import numpy as np
import pytest
from odd import FOLDER

from massloom.llm.plane_clusters import clusters, codes_of, dots, nearest, norms, planes_of

SCHEMA = "vec_id long, embedding array<double>, cluster string, hash int, planes string, distance int, code string"
EXTRA = ("c", 1, "p", 2, "x")
TOP = 2**63 - 1


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: sha(f"2:{'' if i is None else i}")
    at = [v for _, v in sorted(kept, key=lambda r: name(r[0]))[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in at] for _, v in kept]
        return [(f.index(min(f)), min(f)) for f in far]

    for _ in range(rounds):
        where = [c for c, _ in assign()]
        for c in set(where):
            members = [v for (_, v), w in zip(kept, where, strict=True) if w == c]
            at[c] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    last = assign()
    total = {c: sum(d for w, d in last if w == c) for c, _ in last}
    return sorted(((i, c, d, total[c], sum(total.values()), sha(",".join(map(str, at[c])))) for (i, _), (c, d) in zip(kept, last, strict=True)), key=repr)


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in clusters(table, **options).collect()), key=repr)


def test_equals_brute_force(spark):
    given = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").limit(150).collect()]
    assert found(spark, given, k=12) == brute(given, 12)


@pytest.mark.parametrize("size", [3, 300, 1 << 20, 1 << 40])
def test_dots_are_exact(size):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size + 1, (20, 64)), rng.integers(-(size // 2) - 1, size // 3 + 1, (5, 64))
    p, q = planes_of(a), planes_of(b)
    assert (codes_of(p) == a).all()
    big = a.astype(object), b.astype(object)
    assert (dots(p, q).astype(object) == big[0] @ big[1].T).all() and (norms(p).astype(object) == (big[0] ** 2).sum(1)).all()
    far = ((big[0][:, None] - big[1][None]) ** 2).sum(2)
    cluster, distance = nearest(p, q)
    assert cluster.tolist() == [f.index(min(f)) for f in far.tolist()] and distance.tolist() == far.min(1).tolist()


def test_odd_vectors_ties_and_repeats(spark):
    one, zero = [1.0] * 64, [0.0] * 64
    rows = [(0, one), (1, zero), (1, zero), (2, None), (3, [1.0] * 63), (4, [None] + [1.0] * 63), (5, [float("nan")] * 64), (6, [float("-inf")] * 64),
            (None, [0.5] * 64), (7, [-0.001] * 64), (8, [1e5] * 64), (9, []), (10, [2.0] * 32 + [-2.0] * 32)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, k=2) == brute(rows, 2)
    assert found(spark, [(1, None)]) == [] == found(spark, [])
    far = found(spark, [(1, [1e300] * 64), (2, zero), (3, zero)], k=2, rounds=1)
    assert [r[0] for r in far] == [1, 2, 3] and all(0 <= r[2] <= TOP and r[4] <= TOP for r in far)


def test_copies_hold_a_third_of_all_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [0.25] * 64 if i % 3 == 0 else rng.normal(size=64).tolist()) for i in range(120)]
    assert found(spark, rows, k=8) == brute(rows, 8)

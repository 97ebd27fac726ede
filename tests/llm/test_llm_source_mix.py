import hashlib
import re
from collections import defaultdict

import pytest
from odd import FOLDER, docs, no_docs, odd_docs

from massloom.llm.source_mix import CIRCLE, STEP, mix_digest, mixture, schedule

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in fixed]
        per = (total - sum(fixed.values())) / sum(w[s] for s in left) if left else 0
        above = [s for s in left if per * w[s] > most * sizes[s]]
        if not above:
            return {**fixed, **{s: per * w[s] for s in left}}
        fixed |= {s: most * sizes[s] for s in above}


def check(spark, given):
    rows = [(r.doc_id, r.text, r.source) for r in given.select("doc_id", "text", "source").collect()]
    sizes, total = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    got = mix_digest(given).collect()
    source = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), len(WORD.findall(t or ""))) for i, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    for r in got:
        if r.doc_id is not None:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], abs=1e-6)
            total[s] += r.taken
    return want, total


def test_whole_table(spark):
    want, total = check(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"))
    for s, t in want.items():
        assert t - 1 <= total[s] <= t + 1e-6


def test_caps_are_reshared(spark):
    text = lambda n: " ".join(["w"] * n)
    given = docs(spark, [(1, text(10), "a"), (2, text(500), "b"), (3, text(300), "b"), (4, text(90), None), (5, None, "empty"), (6, text(700), "ä")])
    want, total = check(spark, given)
    assert want["a"] == 20 and want["empty"] == 0
    for s, t in want.items():
        assert t - 1 <= total[s] <= t + 1e-6


def test_slots_follow_the_golden_ratio(spark):
    _, targets, pieces = mixture(docs(spark, [(i, "w " * 400, "abc"[i % 3]) for i in range(30)]))
    arcs = {r.source: (r.low, r.high) for r in targets.collect()}
    assert min(a[0] for a in arcs.values()) == 0 and max(a[1] for a in arcs.values()) == CIRCLE
    slots = [r for r in schedule(targets, 64).collect() if r.slot is not None]
    seen = defaultdict(int)
    for r in sorted(slots, key=lambda r: r.slot):
        point = r.slot * STEP % CIRCLE
        assert arcs[r.source][0] <= point < arcs[r.source][1] and r["rank"] == seen[r.source]
        seen[r.source] += 1
    # any stretch of the schedule holds the sources in proportion
    share = {s: (hi - lo) / CIRCLE for s, (lo, hi) in arcs.items()}
    first = [r for r in slots if r.slot < 100]
    for s, p in share.items():
        assert abs(sum(r.source == s for r in first) - 100 * p) <= 4
    for r in pieces.groupBy("slot", "source", "rank").sum("words").collect():
        assert r["sum(words)"] <= 64


def test_reruns_agree_and_a_hot_source_is_whole(spark):
    given = docs(spark, [(i, f"w{i} " * (i % 40 + 1), "hot" if i % 3 else f"s{i % 5}") for i in range(600)])
    a = sorted(map(tuple, mix_digest(given).collect()))
    assert a == sorted(map(tuple, mix_digest(given.repartition(7)).collect()))
    check(spark, given)


def test_odd_rows(spark):
    check(spark, odd_docs(spark))
    assert mix_digest(no_docs(spark)).count() == 0
    assert [r.taken for r in mix_digest(docs(spark, [(1, ""), (2, None)])).collect()] == [0, 0]


def test_order_is_a_known_hash(spark):
    rows, *_ = mixture(docs(spark, [(7, "a b", "s")]))
    assert rows.first()["order"] == hashlib.md5(b"7/s").hexdigest()

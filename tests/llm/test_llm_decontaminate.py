import random

import numpy as np
from odd import FOLDER, docs, no_docs, odd_docs, prose
from pyspark.sql import functions as F

from massloom.llm.decontaminate import EDITS, edit_distance, find_leaks, holds_leak, normal

ITEM = "item_id long, text string, doc_id string, n int"


def form(text):
    return normal([text])[0].tobytes().strip()


def slow_distance(item, text):
    """Least edits between the item and any stretch of the text, by the plain table."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        for j, d in enumerate(text):
            new[j + 1] = min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1)
        row = new
    return int(row.min())


def damaged(rng, text, n):
    t = list(text)
    for _ in range(n):
        i = rng.randrange(len(t))
        t[i : i + 1] = rng.choice([[], [rng.choice("abcxyz")], [t[i], rng.choice("abcxyz")]])
    return "".join(t)


def test_distance_equals_the_plain_table():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randint(1, n))).encode() for n in (9, 25))
        want = slow_distance(a, b)
        assert edit_distance(a, b, want)[0] == want and (want == 0 or edit_distance(a, b, want - 1) is None)


def test_normal_form():
    assert form("  Ab--C,\n\nd é.") == "ab c d é".encode()
    text, at = normal(["a", "", "B!"])
    assert [text[i:j].tobytes().strip() for i, j in zip(at, at[1:], strict=False)] == [b"a", b"", b"b"]


def test_finds_what_brute_force_finds(spark):
    table, bench = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "benchmark"))
    items = [(r.item_id, form(r.text)) for r in bench.collect()]
    want = set()
    for r in table.collect():
        body = form(r.text or "")
        for i, item in items:
            if item in body:
                want.add((r.doc_id, i))
    got = {(r.doc_id, r.item_id): r for r in find_leaks(table, bench).collect()}
    assert want <= set(got) and want
    bodies = {r.doc_id: form(r.text or "") for r in table.collect()}
    for (d, i), r in got.items():  # every report is a true one
        assert r.distance <= EDITS * r.item_length
        if (d, i) not in want:
            assert slow_distance(dict(items)[i], bodies[d]) <= EDITS * r.item_length


def test_recall_of_damaged_passages(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, 45)) for i in range(40)]
    rows, clean = [], []
    for i, text in items:
        for share in (0.0, 0.02, 0.04):
            rows.append((len(rows), f"{prose(rng, 80)}. {damaged(rng, text, int(share * len(text))).upper()}, {prose(rng, 80)}"))
    clean = [(1000 + i, prose(rng, 300)) for i in range(100)]
    bench = spark.createDataFrame([(*x, "d", 1) for x in items], ITEM)
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs(spark, rows + clean), bench).collect()}
    assert all(d < 1000 for d, _ in got)
    hits = [(r[0], r[0] // 3) in got for r in rows]
    assert all(hits[0::3]) and np.mean(hits[1::3]) >= 0.95 and np.mean(hits[2::3]) >= 0.9


def test_odd_rows_and_items(spark):
    items = [(1, None), (None, "one two three four five six"), (2, ""), (3, "two words"), (4, "One, two three FOUR five six seven"),
             (4, "One, two three FOUR five six seven"), (5, "long " * 4000)]
    bench = spark.createDataFrame([(*x, "d", 1) for x in items], ITEM)
    given = odd_docs(spark)
    got = sorted((r.doc_id, r.item_id, r.distance) for r in find_leaks(given, bench).collect())
    assert [g[:2] for g in got] == [(4, 4), (4, 4), (5, 4), (7, 5), (8, 4)]
    assert all(g[2] == 0 for g in got if g[1] == 4)
    assert given.where(holds_leak(given, bench, F.col("text"))).count() == 5
    none = spark.createDataFrame([], ITEM)
    assert find_leaks(given, none).count() == 0 and find_leaks(no_docs(spark), bench).count() == 0
    assert given.where(~holds_leak(given, none, F.col("text"))).count() == 13


def test_more_items_than_a_block(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, 20)) for i in range(9)]
    given = docs(spark, [(i, f"x {t} y") for i, t in items])
    got = find_leaks(given, spark.createDataFrame([(*x, "d", 1) for x in items], ITEM), most_items=4)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i in range(9)]

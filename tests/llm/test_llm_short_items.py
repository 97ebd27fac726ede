import random

import pytest
from odd import docs, prose
from pyspark.sql import functions as F

from massloom.llm.decontaminate import find_leaks, holds_leak

ITEM = "item_id long, text string, doc_id string, n int"
SHORT = [
    "what is the capital of france", "what is the boiling point of water", "who wrote the play macbeth", "how many legs has an ant", "a b c d e",
    "when did the war end", "name the largest planet in space", "why is the sky so blue", "how far is it to the moon", "who was the first man on it",
]
UNSPACED = ["日本の首都はどこですか", "水的沸点是多少度", "เมืองหลวงของประเทศไทยคืออะไร", "中国首都"]


@pytest.mark.parametrize("around", [("{} ", " {}"), ("{} “", "” {}"), ("", "{}")])
def test_exact_copies_of_short_and_unspaced_items(spark, around):
    rng = random.Random(8)
    items = list(enumerate(SHORT + UNSPACED))
    before, after = around
    rows = [(i, before.format(prose(rng, 30)) + t.capitalize() + after.format(prose(rng, 30))) for i, t in items]
    rows += [(100 + i, "吾輩は猫である" + t + "名前はまだ無い") for i, t in items if i >= len(SHORT)]
    clean = [(1000 + i, prose(rng, 200) + "吾輩は猫である。名前はまだ無い。") for i in range(30)]
    bench = spark.createDataFrame([(*x, "d", 1) for x in items], ITEM)
    got = sorted((r.doc_id, r.item_id, r.distance) for r in find_leaks(docs(spark, rows + clean), bench).collect())
    assert got == sorted([(i, i, 0) for i, _ in items] + [(100 + i, i, 0) for i in range(len(SHORT), len(items))])


def test_items_of_few_words_are_found_whole(spark):
    items = [("é-1", "define entropy precisely now"), ("b", "Ohm's law?"), ("c", "zyzzyva"), ("d", "中国"), ("e", "?!"), (None, "lost id"), ("f", None), ("g", "zyzzyva")]
    bench = spark.createDataFrame([(*x, "d", 1) for x in items], "item_id string, text string, doc_id string, n int")
    rows = [
        (1, "please DEFINE entropy, precisely: now"), (2, "redefine entropy precisely now"), (3, "define entropy precisely nowadays"), (4, "ohm s law"),
        (5, "a zyzzyva"), (6, "zyzzyvas"), (7, "在中国的"), (8, "define entropy now"), (9, ""), (10, None), (11, "?! lost id")]
    got = sorted((r.doc_id, r.item_id, r.distance, r.item_length) for r in find_leaks(docs(spark, rows), bench).collect())
    assert got == [(1, "é-1", 0, 28), (4, "b", 0, 9), (5, "c", 0, 7), (5, "g", 0, 7), (7, "d", 0, 6)]
    flagged = {r.doc_id for r in docs(spark, rows).where(holds_leak(docs(spark, rows), bench, F.col("text"))).collect()}
    assert flagged == {1, 4, 5, 7}

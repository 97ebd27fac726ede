import hashlib
import random
import re

import numpy as np
import pytest
from odd import docs, no_docs, odd_docs
from pyspark.sql import functions as F

from massloom.llm.fill_middle import Forest, cuts, fill_in_middle, middle_digest, restored

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
TEXTS = ["", "a", "ab cd", " ", "é漢字🙂 abc,de", "x" * 5000, "1 2\n3\t4", "a" * 64 + "é" * 64 + "b" * 3, "word " * 700, "🙂" * 300, "AZaz[`{@"]


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(units), form, len(pre), len(mid), sha(out), sha(text)


@pytest.mark.parametrize("block", [1, 3, 64, 1024])
def test_every_cut_of_every_text(block):
    for text in TEXTS:
        units = UNIT.findall(text)
        forest = Forest([text, "", text], block)
        assert forest.count(forest.units).tolist() == [len(units), 0, len(units)]
        for k in sorted({0, 1, 2, len(units) // 2, len(units) - 1, len(units)} & set(range(len(units) + 1))):
            byte, points = forest.cut(np.array([k, 0, len(units) - k]))
            heads = ["".join(units[:k]), "", "".join(units[: len(units) - k])]
            assert points.tolist() == [len(h) for h in heads] and byte.tolist() == [len(h.encode()) for h in heads]


def test_trees_hold_sums_of_their_ranges():
    rng = random.Random(2)
    text = "".join(rng.choice("ab é,🙂") for _ in range(999))
    forest = Forest([text], 16)
    units = [int(forest.unit[i : i + 16].sum()) for i in range(0, len(text.encode()), 16)]
    assert forest.units.tolist() == [sum(units[p - (p & -p) : p]) for p in range(1, len(units) + 1)]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(["ab", "C", " ", "é", "🙂", "\n", "<P", "<", "S>", "12"]) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(400 + i, t) for i, t in enumerate([*TEXTS, None, "<P>", "a<S>b", "<M>", "<P<S", "a<", "\x00 b"])] + [(None, "no id at all"), (7, "twice"), (7, "twice")]
    got = sorted(map(repr, map(tuple, middle_digest(docs(spark, rows).repartition(5)).collect())))
    assert got == sorted(repr(brute(*r)) for r in rows)
    assert {eval(g)[2] for g in got} == {"plain", "psm", "spm"}


def test_odd_rows_and_round_trip(spark):
    given = odd_docs(spark)
    out = fill_in_middle(given)
    back = out.select("text", restored(F.col("output"), F.col("form")).alias("back"), "form", "prefix_chars")
    assert back.count() == given.count()
    assert back.where("not (text <=> back)").isEmpty() and back.where("(form = 'plain') <> (prefix_chars is null)").isEmpty()
    assert middle_digest(no_docs(spark)).count() == 0


def test_marks_and_shares_are_options(spark):
    rows = docs(spark, [(i, f"a text of [pre] number {i} (x)") for i in range(60)])
    out = fill_in_middle(rows, marks=("{{1}}", "{{2}}", "{{3}}"), whole=100, suffix_first=100)
    assert {r.form for r in out.collect()} == {"spm"}
    assert out.where(restored(F.col("output"), F.col("form"), ("{{1}}", "{{2}}", "{{3}}")) != F.col("text")).isEmpty()
    assert {r.form for r in fill_in_middle(rows, marks=("[pre]", "[s]", "[m]")).collect()} == {"plain"}


def test_cuts_of_no_texts():
    assert cuts([], np.zeros(0, np.int64), np.zeros(0, np.int64)).empty

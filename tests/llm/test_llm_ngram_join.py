import random
import re
from collections import Counter

import numpy as np
import pytest
from odd import FOLDER, docs, no_docs, odd_docs, prose

from massloom.llm.ngram_join import near_duplicates, set_signatures
from massloom.llm.words import Tokens, chunks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    sets = [shingles(r[1], k) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    for (a, b), n in pairs.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            up[root(a)] = root(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        i = rng.randrange(len(w) or 1)
        w[i : i + 1] = rng.choice([[], ["new" + str(rng.random())], [*w[i : i + 1], "more"]])
    return " ".join(w) or "gone"


@pytest.mark.parametrize(("k", "num"), [(4, 85), (5, 80)])
def test_equals_brute_force(spark, k, num):
    rng = random.Random(k)
    line = prose(rng, 12)
    rows = []
    for size in (1, 3, 4, 5, 6, 8, 12, 20, 40, 90, 200, 400):
        for _ in range(3):
            text = prose(rng, size)
            for e in (0, 0, 1, 1, 2, 3, max(1, size // 60), max(1, size // 40), max(1, size // 25)):
                rows.append((len(rows), edited(rng, text, e)))
                rows.append((len(rows), line + "\n" + edited(rng, text, e)))
    rng.shuffle(rows)
    got = near_duplicates(docs(spark, rows).repartition(5), words=k, num=num, den=100)
    assert found(got) == brute(rows, k, num, 100)


def test_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert found(near_duplicates(table, words=4, num=85, den=100)) == brute(rows, 4, 85, 100)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for num in (80, 85, 95):
        for size in (1, 2, 3, 5, 7, 10, 13, 20, 33, 60, 150, 500):
            for _ in range(30):
                a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
                most = (100 - num) * 2 * size // (100 + num) + 2
                b = np.concatenate([a[rng.integers(0, most + 1) :], rng.integers(0, 1 << 63, rng.integers(0, most + 1), dtype=np.uint64)])
                if not len(b):
                    continue
                both = len(np.intersect1d(a, b))
                owner, sig = set_signatures([np.unique(a), np.unique(b)], num, 100)
                if 100 * both >= num * (len(np.unique(a)) + len(np.unique(b)) - both):
                    assert set(sig[owner == 0]) & set(sig[owner == 1]), (num, size)


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    assert found(near_duplicates(odd_docs(spark))) == brute(rows, 5, 80, 100)
    assert near_duplicates(no_docs(spark)).count() == 0
    assert near_duplicates(docs(spark, [(1, None), (2, "")])).count() == 2


def test_many_copies_and_near_copies(spark):
    rng = random.Random(8)
    text = prose(rng, 120)
    rows = [(i, text) for i in range(200)] + [(200 + i, edited(rng, text, 2)) for i in range(300)] + [(1000 + i, prose(rng, 60)) for i in range(200)]
    assert found(near_duplicates(docs(spark, rows).repartition(8))) == brute(rows, 5, 80, 100)


def test_a_chain_of_links(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[5 * i : 5 * i + 100])) for i in range(60)]
    assert found(near_duplicates(docs(spark, rows))) == brute(rows, 5, 80, 100)


def test_tokens_equal_plain_python():
    rng = random.Random(1)
    texts = ["", " ", "A b\tc\x0bd\x0ce\r\nF", "É é", "x" * 3000, "\x1f\x00 a", *[prose(rng, n) for n in (1, 2, 50)], "a A a"]
    t = Tokens(texts)
    assert t.words_per_text.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in texts]
    for k in (1, 2, 5):
        assert [len(s) for s in t.sets(k)] == [len(shingles(x, k)) for x in texts]
    assert (t.sets(1)[-1] == Tokens(["A"]).sets(1)[0]).all()
    assert [i for at in chunks(texts, 100) for i in range(len(texts))[at]] == list(range(len(texts)))

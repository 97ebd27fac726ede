"""Share of edited items that are found, by length and share of characters edited."""

import random

import pytest

from massloom.llm.decontaminate import ItemIndex

PARTS = "ab cd ef gh ij kl mn op qr st uv wx yz the of and to in is it ra no li su".split()


def edited(rng, text, share):
    out = list(text)
    for _ in range(int(len(text) * share)):
        i, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.34:
            out[i] = rng.choice("abcdefghijklmnop")
        elif kind < 0.67:
            out.insert(i, rng.choice("abcdefghijklmnop"))
        else:
            del out[i]
    return "".join(out)


@pytest.mark.parametrize(("words", "share", "least"), [(8, 0.04, 0.9), (8, 0.1, 0.6), (15, 0.06, 0.9), (15, 0.1, 0.7), (45, 0.1, 0.95)])
def test_recall_of_edited_items(words, share, least):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choices(PARTS, k=rng.randint(1, 3))) for _ in range(n))
    items = [prose(words) for _ in range(100)]
    index = ItemIndex([str(i) for i in range(100)], items)
    texts = [f"{prose(30)} {edited(rng, t, share)} {prose(30)}" for t in items]
    found = {(r, i) for r, i, *_ in index.leaks(texts, 0.1)}
    assert sum((k, k) in found for k in range(100)) >= 100 * least
    assert not [1 for r, i in found if r != i]

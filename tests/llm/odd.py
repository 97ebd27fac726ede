"""Rows that operators must take without a crash, and texts to tell apart."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, uid string, score string, held_out int, "
    "cls int, n int, unit string, size string, path string, start int, hash string, license string"
)
EXTRA = ("x", "y", 1, 2, 3, "u", "s", "p", 4, "h", "l")
FOLDER = "/root/testdata/sf0.001"


def docs(spark, rows):
    """rows of (doc_id, text[, source[, lang]]) with columns whose names the operators use inside."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_docs(spark):
    word = "one two three four five six seven eight nine ten"
    return docs(spark, [
        (None, "a text without an id"), (1, None), (2, ""), (3, " \n\t "), (4, word), (4, word), (5, word), (6, "x" * 60_000),
        (7, "long " * 30_000), (8, word, None), (9, "é ü 漢字 🙂 ok", "b", None), (None, None, None, None), (10, "\x00 null byte \x1f"),
    ])


def no_docs(spark):
    return docs(spark, [])


def prose(rng: random.Random, n: int, words=tuple("ab cd ef gh ij kl mn op qr st uv wx yz the of and to in is it".split())):
    return " ".join("".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(n))

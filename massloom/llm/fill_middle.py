"""Fill-in-the-middle: cuts after a number of units, found through Fenwick trees over blocks of a text."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from massloom.llm.words import chunks

BLOCK = 1024  # bytes
MARKS = ("<P>", "<S>", "<M>")


class Forest:
    """For each text a Fenwick tree over its blocks of ``block`` bytes, with the units and the code
    points that begin in each block. A unit is a run of ASCII letters, or any other code point.

    Position p of a text's tree (from 1) holds the counts of the p & -p blocks that end with block p;
    the trees of all texts lie one after another.
    """

    def __init__(self, texts: Sequence[str], block: int = BLOCK):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        self.starts, self.block = np.cumsum(sizes) - sizes, block
        self.ends = self.starts + sizes
        raw = np.frombuffer(b"".join(parts), np.uint8)
        self.point = (raw & 0xC0) != 0x80
        letter = ((raw | 32) - np.uint8(97)) < 26
        after = np.append(False, letter[:-1])[: len(raw)]
        after[self.starts[sizes > 0]] = False
        self.unit = self.point & ~(letter & after)
        self.blocks = -(-sizes // block)
        self.first = np.cumsum(self.blocks) - self.blocks
        place = np.arange(self.blocks.sum()) - np.repeat(self.first, self.blocks)
        begin = np.repeat(self.starts, self.blocks) + place * block
        self.units, self.points = (self._trees(mask, begin, place + 1) for mask in (self.unit, self.point))

    @staticmethod
    def _trees(mask: np.ndarray, begin: np.ndarray, p: np.ndarray) -> np.ndarray:
        if not len(begin):
            return np.zeros(0, np.int64)
        upto = np.append(0, np.cumsum(np.add.reduceat(mask, begin, dtype=np.int64)))
        at = np.arange(1, len(p) + 1)
        return upto[at] - upto[at - (p & -p)]

    def count(self, tree: np.ndarray) -> np.ndarray:
        """Total of each text: the nodes met on the way from its last position to 0."""
        total, p = np.zeros(len(self.blocks), np.int64), self.blocks.copy()
        while p.any():
            on = p > 0
            total[on] += tree[(self.first + p - 1)[on]]
            p -= p & -p
        return total

    def cut(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, code points) before the cut after ``units`` units of each text, none above its total.

        All texts descend together: as far to the right as the blocks passed hold no more than
        the units wanted. The cut is where the next unit begins, in the block reached, or the end.
        """
        block, left, points = np.zeros(len(units), np.int64), units.astype(np.int64), np.zeros(len(units), np.int64)
        step = 1 << int(self.blocks.max(initial=0)).bit_length()
        while step := step >> 1:
            to = block + step
            at = np.where(to <= self.blocks, self.first + to - 1, 0)
            go = (to <= self.blocks) & (self.units[at] <= left) if len(self.units) else np.zeros(len(units), bool)
            block[go] = to[go]
            left[go] -= self.units[at[go]]
            points[go] += self.points[at[go]]
        byte = self.ends.copy()
        for i in np.flatnonzero(block < self.blocks):
            begin = self.starts[i] + block[i] * self.block
            end = min(begin + self.block, self.ends[i])
            byte[i] = begin + np.flatnonzero(self.unit[begin:end])[left[i]]
            points[i] += np.count_nonzero(self.point[begin : byte[i]])
        return byte - self.starts, points


def cuts(texts: Sequence[str], one: np.ndarray, two: np.ndarray, block: int = BLOCK) -> pd.DataFrame:
    """(n, prefix, middle) of each text: its units, and the code points before and between the cuts
    after one % (n + 1) and two % (n + 1) units."""
    forest = Forest(texts, block)
    n = forest.count(forest.units)
    a, b = one % (n + 1), two % (n + 1)
    first, last = forest.cut(np.minimum(a, b))[1], forest.cut(np.maximum(a, b))[1]
    return pd.DataFrame({"n": n, "prefix": first, "middle": last - first})


@F.pandas_udf(StructType().add("n", LongType()).add("prefix", LongType()).add("middle", LongType()))
def _cuts(texts: pd.Series, one: pd.Series, two: pd.Series) -> pd.DataFrame:
    given, one, two = texts.tolist(), one.to_numpy(), two.to_numpy()
    found = [cuts(given[s], one[s], two[s]) for s in chunks(given)]
    return pd.concat(found, ignore_index=True) if found else cuts([], one, two)


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1", whole: int = 90, suffix_first: int = 20,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) of every row, from its whole text.

    Draws come from the SHA-256 of ``seed`` and the id, so reruns agree and repeated ids draw alike;
    a null id counts as empty. Of 100 texts ``whole`` are transformed, and of 100 of those
    ``suffix_first`` stand suffix first (form spm, else psm). Null text is empty; an empty text, and
    one that holds a mark, stays as it is (form plain, null counts of characters). No mark may begin
    as another ends, or pieces could not be told apart.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    draws = {f"h{i}": F.conv(F.substring("digest", 8 * i - 7, 8), 16, 10).cast("long") for i in (1, 2, 3, 4)}
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), digest.alias("digest")).withColumns(draws)
    rows = rows.withColumn("cut", _cuts("text", "h1", "h2"))
    holds_mark = F.contains("text", F.lit(marks[0])) | F.contains("text", F.lit(marks[1])) | F.contains("text", F.lit(marks[2]))
    form = F.when((F.col("text") == "") | holds_mark | (F.col("h3") % 100 >= whole), "plain")
    rows = rows.withColumn("form", form.when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm"))
    counted = {f"{c}_chars": F.when(F.col("form") != "plain", F.col(f"cut.{c}")) for c in ("prefix", "middle")}
    rows = rows.select("doc_id", "text", F.col("cut.n").alias("n"), "form", *[c.alias(n) for n, c in counted.items()])
    a, b = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = F.substring("text", F.lit(1), a), F.substring("text", a + 1, b)
    suffix = F.substring("text", a + b + 1, F.char_length("text"))
    p, s, m = map(F.lit, marks)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(
        F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("text"))
    return rows.withColumn("output", output)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from which ``output`` was made: it is taken apart at its marks."""
    part = F.split(output, "|".join(rf"\Q{m}\E" if re.escape(m) != m else m for m in marks), -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def middle_digest(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row of
    :func:`fill_in_middle`."""
    rows = fill_in_middle(docs, **options)
    back = restored(F.col("output"), F.col("form"), options.get("marks", MARKS))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))

"""Benchmark decontamination: CGK walks turn edits into few differing positions, sampled positions
find candidate windows, and the edit distance of the whole item decides.

The texts are scanned once and not shuffled. Texts and items are compared in a normal form: A-Z
lower-cased, and every run of ASCII characters other than letters and digits as one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.words import ODD, chunks, mixed, powers

#: Most steps of a walk that are sampled, and hash tables that share them out.
STEPS, TABLES = 60, 4
#: Bytes at which walks may end. A window of an item takes the widest that the rest of the item fills.
WIDTHS = (1, 2, 4, 6, 8, 12, 16, 24, 32, 44, STEPS)
#: Bytes from which on a walk is long enough for samples of half its steps in a row.
LONG_WALK = 24
FLAG_BITS = 20
#: Items whose index one pass over the texts holds; more items take further passes.
ITEMS = 20_000
ITEM_BYTES = 64 << 20
EDITS = 0.1
SEED = 20_240
_U = np.uint64

_SAME = np.arange(256, dtype=np.uint8)
_SAME[65:91] += 32
_PLAIN = np.zeros(256, bool)
#: Code points of scripts without spaces, each of which begins a window and counts as a word, and of
#: spaces and punctuation beyond ASCII, which end a word.
UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF), (0x3040, 0x312F), (0x31A0, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B2FF), (0x20000, 0x3FFFF))
PARTING = ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0x2000, 0x206F), (0x3000, 0x303F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20))
_PLAIN[48:58] = _PLAIN[97:123] = _PLAIN[65:91] = _PLAIN[128:] = True


def normal(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts): the normal forms one after another, each between two spaces; the last of
    ``starts`` is the end."""
    raw = np.frombuffer(b"\n" + b"\n".join(t.encode("utf-8", "surrogatepass") for t in texts) + b"\n", np.uint8)
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes + 1)])  # the break before each text, and the last
    plain = _PLAIN[raw]
    stays = plain | np.append(True, plain[:-1])  # the first of a run of others
    stays[at] = True
    out = np.where(plain, _SAME[raw], np.uint8(32))[stays]
    return out, (np.cumsum(stays) - 1)[at]


def _coins() -> np.ndarray:
    """(step, byte) -> 0 or 1: whether a walk moves on from that byte at that step."""
    return (mixed(np.arange(STEPS * 256, dtype=_U) + _U(SEED)) & _U(1)).astype(np.int32).reshape(STEPS, 256)


def window_keys(text: np.ndarray, starts: np.ndarray, width: int = STEPS) -> np.ndarray:
    """(table, window) keys of the windows of ``width`` bytes at ``starts``.

    A CGK walk reads the byte at its place at each step, then moves on by 0 or 1 as a fixed coin of
    (step, byte) says; past the window it reads spaces. Two walks over texts that differ by an edit
    fall into step again after a few steps, so the bytes read differ in a few runs. Table t's key is
    made of the bytes read at its sample of the steps; walks whose differences miss one table's
    steps share its key.
    """
    padded = np.append(text, np.full(STEPS, 32, np.uint8))
    place, keys, end = starts.astype(np.int64), np.zeros((TABLES, len(starts)), _U), starts + width
    spread = mixed(np.arange(256, dtype=_U) + _U(SEED * 7))
    tables = samples(width)
    with np.errstate(over="ignore"):
        for step, coin in enumerate(_coins()[: 2 * width]):
            byte = padded[place]
            if step >= width:  # no walk is past its window before
                byte = np.where(place < end, byte, np.uint8(32))
            read = spread[byte]
            for t in tables[step]:
                keys[t] *= _U(0x9E3779B97F4A7C15)
                keys[t] += read
            place += coin[byte]
        for t in range(TABLES):
            keys[t] = mixed(keys[t] + _U(t))
    return keys


def samples(width: int) -> list[list[int]]:
    """For each step the tables that read it. Long walks have three overlapping halves, as edits spoil
    runs of steps, and every ``TABLES``-th step; in short walks a half would say too little, so the
    tables share the steps out in turn."""
    steps = min(STEPS, 2 * width)
    if width < LONG_WALK:
        return [[s % TABLES] for s in range(steps)]
    half = steps // 2
    return [[t for t, first in enumerate((0, half // 2, half)) if first <= s < first + half] + ([TABLES - 1] if s % TABLES == 0 else []) for s in range(steps)]


def _within(codes: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    edges = np.array(ranges)
    at = np.searchsorted(edges[:, 0], codes, side="right") - 1
    return (at >= 0) & (codes <= edges[at, 1])


def word_starts(text: np.ndarray) -> np.ndarray:
    """Places that are not spaces, after a space or a character that parts words, and every character
    of a script without spaces and what follows it."""
    space = text == 32
    begins = np.append(False, ~space[1:] & space[:-1])
    lead = np.flatnonzero((text == 0xC2) | (text >= 0xE0))  # all characters of the listed ranges
    if len(lead):
        b = np.append(text, np.zeros(4, np.uint8)).astype(np.int64)
        one, two, three, four = (b[lead + k] for k in range(4))
        size = np.where(one < 0xE0, 2, np.where(one < 0xF0, 3, 4))
        low = lambda x: x & 63
        codes = np.where(size == 2, (one & 31) << 6 | low(two), np.where(
            size == 3, (one & 15) << 12 | low(two) << 6 | low(three), (one & 7) << 18 | low(two) << 12 | low(three) << 6 | low(four)))
        alone, parts = _within(codes, UNSPACED), _within(codes, PARTING)
        begins[lead[alone]] = True
        after = (lead + size)[alone | parts]
        after = after[after < len(text)]
        begins[after[text[after] != 32]] = True
    return np.flatnonzero(begins)


def byte_sums(text: np.ndarray) -> np.ndarray:
    """Running sums of the bytes' random numbers times powers of an odd number."""
    with np.errstate(over="ignore"):
        values = mixed(np.arange(256, dtype=_U) + _U(SEED * 3))[text] * powers(ODD, len(text))
        return np.append(_U(0), np.cumsum(values, dtype=_U))


def stretch_hash(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each start, wherever it stands."""
    with np.errstate(over="ignore"):
        return mixed((sums[starts + length] - sums[starts]) * powers(pow(ODD, -1, 1 << 64), len(sums))[starts])


def edit_distance(item: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(distance, end) of the stretch of ``text`` nearest to ``item``, None beyond ``most`` edits.

    Bit-parallel dynamic programming: a column of the table is two integers as long as the item, one
    with the rises and one with the falls; the stretch may begin anywhere.
    """
    if (found := text.find(item)) >= 0:
        return 0, found + len(item)
    m = len(item)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score, best, end = ones, 0, m, m + 1, 0
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        x = ((((eq & up) + up) ^ up) | eq | down) & ones
        rise, fall = (down | ~(x | up)) & ones, up & x
        score += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & ones, (fall << 1) & ones
        up, down = (fall | ~(eq | down | rise)) & ones, rise & (eq | down)
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= most else None


class ItemIndex:
    """Keys of the windows of every item, which begin at its words, end within it and are at least
    half as long as it, up to the longest walk; and the items themselves. Items of fewer words than
    ``least_words`` have no windows: they are found by the hash of the whole, as exact copies."""

    def __init__(self, ids: list[str], texts: list[str], least_words: int = 5):
        text, at = normal(texts)
        self.ids = ids
        self.items = [text[a + 1 : b].tobytes().strip() for a, b in zip(at, at[1:], strict=False)]
        # an item is stripped of its outer spaces; places count from its first character
        starts = word_starts(text)
        owner = np.searchsorted(at, starts, side="right") - 1
        first = np.full(len(ids), 1 << 60, np.int64)
        np.minimum.at(first, owner, starts)
        size = np.array([len(i) for i in self.items], np.int64)[owner]
        rest = first[owner] + size - starts
        brief = np.bincount(owner, minlength=len(ids)) < least_words
        #: short items by length in bytes: (sorted hashes, items)
        self.brief: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sums = byte_sums(text)
        for length in np.unique(size[brief[owner]]) if len(owner) else ():
            on = np.flatnonzero(brief & (np.array([len(i) for i in self.items]) == length) & (first < 1 << 60))
            hashes = stretch_hash(sums, first[on], length)
            order = np.argsort(hashes, kind="stable")
            self.brief[int(length)] = hashes[order], on[order]
        widths = np.array(WIDTHS)
        # an item of one character that is no window's start has none
        width = widths[np.maximum(np.searchsorted(widths, rest, side="right") - 1, 0)]
        #: by width: flags, and for each table (keys, item, offset in the item)
        self.windows = {}
        for w in WIDTHS:
            on = np.flatnonzero(~brief[owner] & (width == w) & (rest >= w) & (2 * w >= np.minimum(size, 2 * STEPS)))
            if not len(on):
                continue
            tables, flags = [], np.zeros(1 << FLAG_BITS, bool)
            for key in window_keys(text, starts[on], w):
                # an item that repeats itself keeps the first and the last place of each key
                order = np.lexsort((starts[on], owner[on], key))
                new = np.append(True, (np.diff(key[order]) != 0) | (np.diff(owner[on][order]) != 0))
                order = order[new | np.append(new[1:], True)]
                tables.append((key[order], owner[on][order].astype(np.int32), (starts - first[owner])[on][order].astype(np.int32)))
                flags[key >> _U(64 - FLAG_BITS)] = True
            self.windows[w] = flags, tables

    def candidates(self, text: np.ndarray) -> np.ndarray:
        """Rows of (place, item, offset in the item) of windows that share a key with an item's."""
        starts = word_starts(text)
        out = [np.zeros((0, 3), np.int64)]
        for at in range(0, len(starts), 1 << 16):
            part = starts[at : at + (1 << 16)]
            near = text[: part[-1] + STEPS]
            for width, (flags, tables) in self.windows.items():
                for (keys, owner, offset), key in zip(tables, window_keys(near, part, width), strict=True):
                    on = np.flatnonzero(flags[key >> _U(64 - FLAG_BITS)])
                    lo, hi = np.searchsorted(keys, key[on], "left"), np.searchsorted(keys, key[on], "right")
                    n = hi - lo
                    which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    out.append(np.stack([part[np.repeat(on, n)], owner[which], offset[which]], axis=1))
        return np.unique(np.concatenate(out), axis=0)

    def copies(self, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place, item) of every exact copy of a short item that begins and ends with words."""
        if not self.brief:
            return
        starts, sums = word_starts(text), byte_sums(text)
        ends = np.zeros(len(text) + 1, bool)
        ends[starts] = ends[len(text)] = True
        ends[:-1] |= text == 32
        for length, (hashes, items) in self.brief.items():
            at = starts[starts + length <= len(text)]
            at = at[ends[at + length]]
            found = stretch_hash(sums, at, length)
            lo, hi = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            for k in np.flatnonzero(hi > lo).tolist():
                for item in items[lo[k] : hi[k]].tolist():
                    if text[at[k] : at[k] + length].tobytes() == self.items[item]:
                        yield int(at[k]), item

    def leaks(self, texts: list[str], edits: float) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, distance, end in the normal form) of every item found in every whole text.

        Hits of one item whose windows would begin within its allowed edits of each other are one
        candidate; a window has the item's size plus the allowed edits on either side.
        """
        text, at = normal(texts)
        exact = set()
        for place, item in self.copies(text):
            r = int(np.searchsorted(at, place, side="right")) - 1
            if (r, item) not in exact:
                exact.add((r, item))
                yield r, item, 0, place + len(self.items[item]) - int(at[r])
        hits = self.candidates(text)
        if not len(hits):
            return
        row = np.searchsorted(at, hits[:, 0], side="right") - 1
        begin = hits[:, 0] - hits[:, 2]
        order = np.lexsort((begin, hits[:, 1], row))
        last, found = None, set()
        for r, item, b in zip(row[order].tolist(), hits[order, 1].tolist(), begin[order].tolist(), strict=True):
            slack = int(len(self.items[item]) * edits)
            if (r, item) in found or last is not None and last[:2] == (r, item) and b - last[2] <= slack // 2:
                continue
            last = (r, item, b)
            window = text[max(b - 2 * slack - 1, at[r]) : min(b + len(self.items[item]) + 2 * slack + 1, at[r + 1])].tobytes()
            if (got := edit_distance(self.items[item], window, slack)) is not None:
                found.add((r, item))
                yield r, item, got[0], max(b - 2 * slack - 1, at[r]) + got[1] - at[r]


def _index_blocks(benchmark: DataFrame, item_id: str, text: str, least_words: int, most_items: int, most_bytes: int) -> Iterator[ItemIndex]:
    """Indexes of blocks of items, each of bounded size; the driver holds one block at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    span = lambda ranges: "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    word = F.lit(f"[{span(UNSPACED)}]|[A-Za-z0-9\\x{{80}}-\\x{{10FFFF}}&&[^{span(UNSPACED + PARTING)}]]")
    items = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).where(F.regexp_count("text", word) > 0).distinct()
    ids, texts, size = [], [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        if ids and (len(ids) >= most_items or size + len(r.text) > most_bytes):
            yield ItemIndex(ids, texts, least_words)
            ids, texts, size = [], [], 0
        ids.append(r.item_id)
        texts.append(r.text)
        size += len(r.text)
    if ids:
        yield ItemIndex(ids, texts, least_words)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    edits: float = EDITS, least_words: int = 5, most_items: int = ITEMS, most_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(doc_id, item_id, distance, item_length): each item that each row holds, with the distance of
    the first place found; ``edits`` is the share of the item's normal form that may be edited.

    Items under ``least_words`` words are found as exact copies only, from word to word; where a script
    has no spaces each character counts as a word. Null texts and ids of items and items without a
    word take no part; null document texts are empty. Repeated items are one; repeated rows are reported
    once each. Items beyond a block's bound take a further pass over the texts.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = "doc_id string, item_id string, distance int, item_length int"
    out = None
    for index in _index_blocks(benchmark, item_id, item_text, least_words, most_items, most_bytes):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def scan(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            index = held.value
            for batch in batches:
                texts, ids, found = batch["text"].tolist(), batch["doc_id"].tolist(), []
                for at in chunks(texts):
                    found += [(ids[at.start + r], index.ids[i], d, len(index.items[i])) for r, i, d, _ in index.leaks(texts[at], edits)]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "distance", "item_length"])

        part = rows.mapInPandas(scan, schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    item_kind = benchmark.schema[item_id].dataType
    return out.withColumns({"doc_id": F.col("doc_id").cast(kind), "item_id": F.col("item_id").cast(item_kind)})


def _leaky(held: Broadcast, edits: float):  # noqa: ANN202
    @F.pandas_udf("boolean")
    def leaky(texts: pd.Series) -> pd.Series:
        values = texts.tolist()
        out = np.zeros(len(values), bool)
        for at in chunks(values):
            for r, *_ in held.value.leaks(values[at], edits):
                out[at.start + r] = True
        return pd.Series(out)

    return leaky


def holds_leak(docs: DataFrame, benchmark: DataFrame, text: Column, edits: float = EDITS, least_words: int = 5) -> Column:
    """Whether a text holds an item, as a column: nothing is shuffled or joined. Null and empty texts hold
    none; nulls and short items are treated as in :func:`find_leaks`."""
    flag = F.lit(False)
    for index in _index_blocks(benchmark, "item_id", "text", least_words, ITEMS, ITEM_BYTES):
        flag = flag | _leaky(docs.sparkSession.sparkContext.broadcast(index), edits)(F.coalesce(text, F.lit("")))
    return flag

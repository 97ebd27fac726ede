"""Exact top-k inner products over a bit-sliced index of quantised vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.common import kept

ROW_BLOCK, QUERY_BLOCK = 16384, 4096
#: So many most significant slices of a component are added; the rest only settle boundary rows.
ADDED = 8
MOST, LEAST = (1 << 63) - 1, -(1 << 63)


def _bitmap(mask: np.ndarray) -> np.ndarray:
    """Boolean rows, 64 to a word (last axis)."""
    packed = np.packbits(mask, axis=-1, bitorder="little")
    out = np.zeros((*mask.shape[:-1], -(-mask.shape[-1] // 64) * 8), np.uint8)
    out[..., : packed.shape[-1]] = packed
    return out.view(np.uint64)


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def sliced(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, slices): slices[d, j] is the bitmap of the rows with bit j set in component d less low[d]."""
    low = codes.min(axis=0)
    over = codes.astype(np.uint64) - low.astype(np.uint64)  # right modulo 2**64, whatever the signs
    width = int(over.max(initial=0)).bit_length()
    out = np.zeros((codes.shape[1], width, -(-len(codes) // 64)), np.uint64)
    for j in range(width):
        out[:, j] = _bitmap(((over >> np.uint64(j)) & np.uint64(1)).astype(bool).T)
    return low, out


def codes_of(low: np.ndarray, slices: np.ndarray, n: int) -> np.ndarray:
    """The codes (rows, components) that :func:`sliced` took."""
    over = np.zeros((len(low), n), np.uint64)
    for j in range(slices.shape[1]):
        over |= np.unpackbits(slices[:, j].view(np.uint8), axis=1, count=n, bitorder="little").astype(np.uint64) << np.uint64(j)
    return (over + low.astype(np.uint64)[:, None]).astype(np.int64).T


def signed_digits(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(component, power, negative): ``q`` as sums of signed powers of two, no two of them neighbours."""
    left, power, found = q.astype(object) if np.abs(q.astype(float)).max(initial=0) > 2.0**60 else q, 0, []
    while (left != 0).any():
        digit = np.where((left & 1) != 0, 2 - (left & 3), 0)
        at = np.flatnonzero(digit != 0)
        found += [(d, power, digit[d] < 0) for d in at]
        left, power = (left - digit) >> 1, power + 1
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def added(both: np.ndarray, digits: tuple[np.ndarray, np.ndarray, np.ndarray], skip: int) -> list[np.ndarray]:
    """Slices of the sum, over the digits, of a component's slices from ``skip`` up times the digit's power.

    ``both`` holds the slices and their complements; a negative digit takes the complement, which
    adds a constant to every row. All bitmaps of one weight are added by full adders, three to a
    sum and a carry, until one is left; carries go to the next weight. Weights count from ``skip``.
    """
    d, power, negative = digits
    width, top = both.shape[2], int(power.max(initial=0))
    out, carried, weight = [], [], skip
    while weight < top + width or carried:
        j = weight - power
        use = (j >= skip) & (j < width)
        stack = np.concatenate([both[negative[use], d[use], j[use]], *carried])
        carried = []
        while len(stack) > 2:
            m = len(stack) // 3
            a, b, c = stack[:m], stack[m : 2 * m], stack[2 * m : 3 * m]
            odd = a ^ b
            carried.append((a & b) | (odd & c))
            stack = np.concatenate([odd ^ c, stack[3 * m :]])
        if len(stack) == 2:
            carried.append(stack[:1] & stack[1:])
            stack = stack[:1] ^ stack[1:]
        out.append(stack[0] if len(stack) else np.zeros(both.shape[3], np.uint64))
        weight += 1
    return out


def top_rows(slices: list[np.ndarray], rows: np.ndarray, k: int) -> tuple[int, np.ndarray]:
    """(value, bitmap): the ``k``-th largest value among ``rows``, and the rows that have it or more."""
    above, tied, n, value = np.zeros_like(rows), rows, 0, 0
    for j in range(len(slices) - 1, -1, -1):
        ones = tied & slices[j]
        more = _count(ones)
        if n + more >= k:
            tied, value = ones, value | 1 << j
        else:
            above, tied, n = above | ones, tied & ~slices[j], n + more
    return value, above | tied


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    if value <= 0:
        return rows
    above, tied = np.zeros_like(rows), rows
    for j in range(len(slices) - 1, -1, -1):
        if value >> j & 1:
            tied = tied & slices[j]
        else:
            above, tied = above | (tied & slices[j]), tied & ~slices[j]
    return above | tied


def _floor(slices: list[np.ndarray], rows: np.ndarray, ids: np.ndarray, repeats: bool, k: int) -> int:
    """A value that the best rows of ``k`` ids reach; 0 if there are fewer ids."""
    while _count(rows) > k:
        value, top = top_rows(slices, rows, k)
        found = np.unique(ids[_rows(top)]) if repeats else None
        if found is None or len(found) >= k:
            return value
        rows, k = rows & ~_bitmap(np.isin(ids, found)), k - len(found)
    return 0


def search_block(ids: np.ndarray, low: np.ndarray, slices: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int, most: int = ADDED) -> pd.DataFrame:
    """The ``k`` best ids of a block for each query, by the best of an id's rows; ties to smaller ids.

    Only the ``most`` highest slices are added. What they leave out of a row's sum is at most
    ``slack``, so rows whose sum plus slack is below the ``k``-th sum are out; the rows left
    are computed from all their bits.
    """
    width = slices.shape[1]
    skip = max(0, width - most)
    both = np.stack([slices, ~slices])
    codes, everyone = codes_of(low, slices, len(ids)), _bitmap(np.ones(len(ids), bool))
    order = np.argsort(ids, kind="stable")
    by_id, repeats = ids[order], len(np.unique(ids)) < len(ids)
    largest = max((abs(int(c)) for c in (codes.max(initial=0), codes.min(initial=0))), default=0)
    out = []
    for qid, v in zip(qids.tolist(), q, strict=True):
        digits = signed_digits(v)
        sums = added(both, digits, skip)
        own = order[np.searchsorted(by_id, qid) : np.searchsorted(by_id, qid, side="right")]
        rows = everyone
        if len(own):
            mask = np.ones(len(ids), bool)
            mask[own] = False
            rows = _bitmap(mask)
        slack = sum(1 << int(p) for p in digits[1]) if skip else 0  # in units of the lowest slice added
        near = _rows(at_least(sums, rows, _floor(sums, rows, ids, repeats, k) - slack))
        exact = largest * int(np.abs(v.astype(object)).sum() if len(v) else 0) > MOST >> 1
        score = (codes[near].astype(object) @ v.astype(object)).clip(LEAST, MOST).astype(np.int64) if exact else codes[near] @ v
        best = np.lexsort((ids[near], -score.astype(object) if exact else -score))
        if repeats:
            best = best[np.sort(np.unique(ids[near][best], return_index=True)[1])]
        out.append((np.full(min(k, len(best)), qid), ids[near][best[:k]], score[best[:k]]))
    columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else ([], [], []))]
    return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], columns, strict=True)))


def quantised(embedding: Column, scale: float) -> Column:
    """floor(scale * component) as longs; null unless every component is a finite number."""
    v = F.transform(embedding, lambda e: e.cast("double"))
    good = F.forall(v, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)) & ~F.isnan(e))
    return F.when(good, F.transform(v, lambda e: F.floor(e * scale)))


def build_index(rows: DataFrame, row_block: int) -> tuple[DataFrame, int]:
    """(table of one row per block, blocks): rows (vec_id, code) are dealt by hash into blocks of about
    ``row_block`` rows of equal length, each stored as ids, lows and slices."""
    blocks = max(1, -(-rows.count() // row_block))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        codes = np.array(pdf["code"].tolist(), np.int64).reshape(len(pdf), -1)
        low, slices = sliced(codes)
        return pd.DataFrame({
            "dims": [codes.shape[1]], "rb": pdf["rb"].iloc[:1].to_numpy(), "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
            "low": [low.tobytes()], "width": [slices.shape[1]], "slices": [slices.tobytes()]})

    block = F.pmod(F.xxhash64("vec_id", "code"), F.lit(blocks)).cast("int")
    index = rows.select("dims", block.alias("rb"), "vec_id", "code").groupBy("dims", "rb").applyInPandas(
        build, "dims int, rb int, ids binary, low binary, width int, slices binary")
    return kept(index, "slices"), blocks


def top_products(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024, vec_id: str = "vec_id", embedding: str = "embedding",
    row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK, most: int = ADDED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product of floor(scale * x) for
    each row that ``is_query``, a condition on the column ``vec_id``. Exact; ties go to smaller ids.

    Null ids and vectors that are null or hold null or non-finite components take no part. Rows
    of equal id and codes are one row; an id's own rows are never among its answers, and an id with
    several vectors asks with each and reports its best. Only vectors of equal length meet. Codes and
    scores beyond 64 bits count as the nearest long.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(embedding), scale).alias("code"))
    # copies of one row meet before the shuffle, so they are as many rows as there are tasks
    rows = rows.where("vec_id is not null and code is not null").groupBy("vec_id", "code").agg(F.lit(1).alias("one"))
    rows = kept(rows.select("vec_id", "code", F.size("code").alias("dims"), F.coalesce(is_query, F.lit(False)).alias("asks")), "codes")
    index, row_blocks = build_index(rows, row_block)
    asks = rows.where("asks")
    n = asks.count()
    # enough tiles for all cores, if the queries fill them; beyond that the sides bound what is sent twice
    cores = rows.sparkSession.sparkContext.defaultParallelism
    query_blocks = max(1, -(-n // query_block), min(-(-n // 32), -(-4 * cores // row_blocks)))
    part = F.pmod(F.xxhash64("code", "vec_id"), F.lit(query_blocks)).cast("int")
    asks = asks.select("dims", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"), part.alias("qb"), "vec_id", "code")
    held = index.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        block = b.iloc[0]
        ids, low = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["low"], np.int64)
        slices = np.frombuffer(block["slices"], np.uint64).reshape(len(low), block["width"], -(-len(ids) // 64))
        q = np.array(a["code"].tolist(), np.int64).reshape(len(a), -1)
        return search_block(ids, low, slices, a["vec_id"].to_numpy(np.int64), q, k, most)

    keys = ["dims", "rb", "qb"]
    best = asks.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(compare, "query_id long, vec_id long, score long")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

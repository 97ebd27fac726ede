"""Nearest neighbours by a block matrix join: int8 tiles decide which pairs are computed in full."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.common import kept

QUERY_BLOCK, ROW_BLOCK = 2048, 4096
#: int8 products are added as float32, which is exact up to so many dimensions at once.
EXACT_DIMS = 1024


def _coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8 codes: (codes, scale, error); error bounds the length of what rounding lost."""
    unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = unit - codes * scale[:, None]
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", lost, lost)) * (1 + 1e-9) + 1e-12


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, at : at + EXACT_DIMS].astype(np.float32) @ b[:, at : at + EXACT_DIMS].astype(np.float32).T
    return out


def tile(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best ids of a row block for each query of a query block, by the best of an id's rows.

    |q.x - scaled int8 product| <= error(q) (1 + error(x)) + error(x), so a pair whose upper bound is
    below the ``k``-th largest lower bound of its query, an id's largest being the id's, can't be
    among the best. The pairs left are computed in double precision from the given vectors; ties go to the smaller id.
    """
    qc, qs, qe = _coded(q)
    xc, xs, xe = _coded(x)
    near = _products(qc, xc) * qs[:, None] * xs[None, :]
    slack = qe[:, None] * (1 + xe[None, :]) + xe[None, :] + 1e-9
    other = qids[:, None] != ids[None, :]
    low = np.where(other, near - slack, -np.inf)
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
    if len(first) < len(ids):
        low = np.maximum.reduceat(low[:, order], first, axis=1)
    floor = np.partition(low, len(first) - k, axis=1)[:, len(first) - k] if len(first) > k else np.full(len(qids), -np.inf)
    i, j = np.nonzero(other & (near + slack >= floor[:, None]))
    q_length, x_length = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    score = np.empty(len(i))
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        score[at : at + (1 << 16)] = (q[a] * x[b]).sum(axis=1) / (q_length[a] * x_length[b])
    if len(first) < len(ids):  # an id's best pair is the id's
        order = np.lexsort((-score, ids[j], i))
        new = np.append(True, (np.diff(i[order]) != 0) | (np.diff(ids[j][order]) != 0))[: len(order)]
        i, j, score = i[order][new], j[order][new], score[order][new]
    heaps: list[list[tuple[float, int]]] = [[] for _ in qids]
    for a, s, b in zip(i.tolist(), score.tolist(), (-ids[j]).tolist(), strict=True):
        heap = heaps[a]
        if len(heap) < k:
            heapq.heappush(heap, (s, b))
        elif (s, b) > heap[0]:
            heapq.heapreplace(heap, (s, b))
    best = [(int(qids[a]), -b, s) for a, heap in enumerate(heaps) for s, b in heap]
    return pd.DataFrame(best, columns=["query_id", "vec_id", "score"])


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
    query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest cosine for each row that ``is_query``.

    ``is_query`` is a condition on the column ``vec_id``. Exact: every row is compared, in tiles of
    a query block and a row block of bounded size, whose best are merged by (query, score). Null
    ids and vectors that are null, empty, zero or hold null or non-finite components take no part.
    Repeated rows (id and vector) are one row. An id's own vectors are never its neighbours; an id
    with several vectors asks with each and reports its best. Only vectors of equal length meet.
    """
    v = F.transform(F.col(embedding), lambda e: e.cast("double"))
    good = F.forall("v", lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)) & ~F.isnan(e)) & F.exists("v", lambda e: e != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(good)
    # merged before the shuffle, so copies of one row are as many rows as there are tasks; then the
    # hash of id and vector spreads what an id holds
    rows = kept(rows.groupBy("vec_id", "v").agg(F.count("*").alias("copies")).withColumns({
        "dims": F.size("v"), "is_query": F.coalesce(is_query, F.lit(False)), "hash": F.xxhash64("vec_id", "v")}), "vectors")
    n = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    row_blocks, query_blocks = max(1, -(-n.n // row_block)), max(1, -(-n.q // query_block))
    part = lambda blocks: F.pmod(F.col("hash"), F.lit(blocks)).cast("int")
    asks = rows.where("is_query").select(
        "dims", part(query_blocks).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"), "vec_id", "v")
    held = rows.select(
        "dims", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), part(row_blocks).alias("rb"), "vec_id", "v")

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return tile(a["vec_id"].to_numpy(), np.array(a["v"].tolist()), b["vec_id"].to_numpy(), np.array(b["v"].tolist()), k)

    keys = ["dims", "qb", "rb"]
    best = asks.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(compare, "query_id long, vec_id long, score double")
    # k ids a query vector and row block; the rank filter keeps k of them per task before the shuffle
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""Centroid clustering of 64-component vectors by popcounts of bit planes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import kept
from massloom.llm.slice_search import quantised

DIMS = 64
#: Codes beyond this count as this, so that sums over any number of rows stay exact.
LIMIT = 1 << 40
ROWS = 4096  # vectors worked on at once


def planes_of(codes: np.ndarray) -> np.ndarray:
    """Bit planes (rows, width) of 64 codes a row: bit d of plane j is bit j of component d, in two's
    complement, so that the last plane weighs minus its power of two."""
    width = max(int(codes.max(initial=0)), ~int(codes.min(initial=0))).bit_length() + 1
    bits = [np.packbits(((codes >> j) & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64) for j in range(width)]
    return np.concatenate(bits, axis=1)


def weights(width: int) -> list[int]:
    return [1 << j for j in range(width - 1)] + [-(1 << (width - 1))]


def codes_of(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(planes), DIMS), np.int64)
    for j, w in enumerate(weights(planes.shape[1])):
        bits = np.unpackbits(np.ascontiguousarray(planes[:, j]).view(np.uint8).reshape(len(planes), 8), axis=1, bitorder="little")
        out += bits.astype(np.int64) * w
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products (rows of ``a``, rows of ``b``) from planes: popcounts of the AND of each two
    planes times their weights. Numbers that may pass 64 bits are Python integers."""
    wide = a.shape[1] + b.shape[1] + 6 > 61
    out = np.zeros((len(a), len(b)), object if wide else np.int64)
    for i, u in enumerate(weights(a.shape[1])):
        for j, v in enumerate(weights(b.shape[1])):
            both = np.bitwise_count(a[:, i, None] & b[None, :, j])
            out += both.astype(object) * (u * v) if wide else both * np.int64(u * v)
    return out


def norms(planes: np.ndarray) -> np.ndarray:
    """Exact squared lengths, in the same way."""
    width = planes.shape[1]
    wide = 2 * width + 6 > 61
    out, w = np.zeros(len(planes), object if wide else np.int64), weights(width)
    for i in range(width):
        for j in range(i, width):
            both = np.bitwise_count(planes[:, i] & planes[:, j])
            times = w[i] * w[j] * (1 if i == j else 2)
            out += both.astype(object) * times if wide else both * np.int64(times)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row; of equally near centroids the first."""
    part = norms(centroids)[None, :] - 2 * dots(planes, centroids)
    cluster = part.argmin(axis=1)
    return cluster, part[np.arange(len(planes)), cluster] + norms(planes)


def _stacked(rows: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, planes) of rows of equal width, at most ``ROWS`` at once."""
    sizes = rows.str.len().to_numpy()
    for width in np.unique(sizes):
        places = np.flatnonzero(sizes == width)
        for at in range(0, len(places), ROWS):
            some = places[at : at + ROWS]
            yield some, np.array(rows.iloc[some].tolist(), np.int64).view(np.uint64)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), ROWS):
            some = b.iloc[at : at + ROWS]
            codes = np.array(some["code"].tolist(), np.int64).reshape(-1, DIMS)
            yield pd.DataFrame({"vec_id": some["vec_id"], "hash": some["hash"], "planes": list(planes_of(codes).view(np.int64))})


def pack(vectors: DataFrame, scale: float, seed: str, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, hash, planes) of the vectors with exactly 64 components, all finite."""
    code = F.transform(quantised(F.col(embedding), scale), lambda e: F.least(F.greatest(e, F.lit(-LIMIT)), F.lit(LIMIT)))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), code.alias("code")).where(F.size("code") == DIMS)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if kind != "string":  # ids pass through Python as text, which keeps null and every digit
        rows = rows.withColumn("vec_id", F.col("vec_id").cast("string"))
    packed = rows.select("vec_id", mark.alias("hash"), "code").mapInPandas(_packed, "vec_id string, hash string, planes array<long>")
    return kept(packed.withColumn("vec_id", F.col("vec_id").cast(kind)), "planes")


def _moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: each task adds up its rows by cluster, so a cluster of a third of
    all rows is as many partial sums as there are tasks; k times 64 sums come to the driver."""
    planes, k = planes_of(centroids), len(centroids)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, DIMS), np.int64)
        for b in batches:
            for _, rows in _stacked(b["planes"]):
                cluster, _ = nearest(rows, planes)
                n += np.bincount(cluster, minlength=k)
                order = np.argsort(cluster, kind="stable")
                first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                sums[cluster[order][first]] += np.add.reduceat(codes_of(rows)[order], first, axis=0)
        held = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": held, "n": n[held], "sums": list(sums[held])})

    found = packed.select("planes").mapInPandas(partial, "cluster int, n long, sums array<long>")
    parts = found.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    total = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    after = centroids.copy()
    for r in total.collect():
        after[r.cluster, r["at"]] = int(r.total) // r.n
    return after


def clusters(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: float = 256, seed: str = "2", vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Components are floor(scale * x). Vectors that are null, have other than 64 components, or hold
    null or non-finite ones are left out. Centroids start as the ``k`` vectors with the smallest
    SHA-256 of seed and id (a null id counts as empty, ties by their bits); with fewer vectors
    there are fewer. Repeated rows are vectors of their own. Distances and sums beyond 64 bits
    count as the largest long. Only centroids pass through the driver.
    """
    spark = vectors.sparkSession
    packed = pack(vectors, scale, seed, vec_id, embedding)
    first = packed.orderBy("hash", "planes").limit(k).collect()
    centroids = np.concatenate([codes_of(np.array([r.planes], np.int64).view(np.uint64)) for r in first]) if first else np.zeros((0, DIMS), np.int64)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(packed, centroids)
    planes, most = planes_of(centroids), (1 << 63) - 1

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cluster, distance = np.zeros(len(b), np.int32), np.zeros(len(b), np.int64)
            for places, rows in _stacked(b["planes"]):
                c, d = nearest(rows, planes)
                cluster[places], distance[places] = c, np.minimum(d, most).astype(np.int64)
            yield pd.DataFrame({"vec_id": b["vec_id"], "cluster": cluster, "distance": distance})

    kind = packed.schema["vec_id"].dataType.simpleString()
    rows = packed.select(F.col("vec_id").cast("string"), "planes").mapInPandas(assign, "vec_id string, cluster int, distance long")
    rows = kept(rows.withColumn("vec_id", F.col("vec_id").cast(kind)), "assigned")
    sums = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    facts = [
        (c, min(sums.get(c, 0), most), min(sum(sums.values()), most), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
        for c, v in enumerate(centroids.tolist())]
    per = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

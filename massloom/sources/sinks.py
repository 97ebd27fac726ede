"""Writers. All write from the executors; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of a sorted file, about.
ROWS_OF_FILE = 1 << 19


def write_tsv(df: DataFrame, path: str, order: Sequence[str] = (), by: Sequence[str] = ()) -> None:
    """Tab separated text with a header; globally range sorted by ``order``.

    Rows to be sorted are counted first, so that the number of files follows it and a file stays small.
    """
    out = df.repartitionByRange(-(-df.count() // ROWS_OF_FILE) or 1, *order).sortWithinPartitions(*order) if order else df
    writer = out.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.csv(path, sep="\t", header=True, emptyValue="", nullValue="")


def write_documents(df: DataFrame, path: str, key: str = "pxd") -> None:
    """One JSON document per row, in a folder per project; empty sections are written as null."""
    body = F.to_json(F.struct(*[c for c in df.columns]), {"ignoreNullFields": "false"})
    df.select(key, body.alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def write_sdrf(df: DataFrame, path: str, key: str = "pxd", order: str = "sample_no") -> None:
    """Sample tables, a folder per project; ``name#0``, ``name#1`` share the header ``name``.

    Each project's rows are sorted within its own file; a project too large for one file
    continues in the next, which has no header.
    """
    columns = [c for c in df.columns if c not in (key, order)]
    header = "\t".join(c.split("#")[0] for c in columns)
    line = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`"), F.lit("not available")) for c in columns])
    body = df.select(key, F.col(order).cast("bigint").alias("_ord"), line.alias("value"))
    heads = df.select(key).distinct().select(key, F.lit(0).cast("bigint").alias("_ord"), F.lit(header).alias("value"))
    (
        heads.unionByName(body)
        .repartitionByRange(key, "_ord")
        .sortWithinPartitions(key, "_ord")
        .drop("_ord")
        .write.mode("overwrite")
        .partitionBy(key)
        .text(path)
    )


def write_events(df: DataFrame, path: str) -> None:
    """Append events, one JSON object per line."""
    df.write.mode("append").json(path)


def write_fragmentation_types(df: DataFrame, path: str) -> None:
    """The rows of ``fragmentation_types`` as text, a folder per run."""
    line = F.concat_ws("\t", "scan", "frag_tag")
    df.select("filename", line.alias("value")).write.mode("overwrite").partitionBy("filename").text(path)

"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.session import free_shuffles, scratch_dir  # noqa: F401 (the operators take both from here)

#: A word is a run of anything but these; only A-Z is lower-cased, so results match byte for byte.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lost executor later costs
    no recomputation, and ids made by ``monotonically_increasing_id`` are fixed from here on."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete a table of :func:`kept` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_id(df: DataFrame, name: str = "uid") -> DataFrame:
    return df.withColumn(name, F.monotonically_increasing_id())


def in_fold(column: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text modulo ``modulus`` equals ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links``(a, b): comp is the smallest node reachable.

    Rounds of "every node takes the smallest label around it, then the label of its label" until
    nothing changes; each round is a written table, so plans stay flat and lost tasks rerun alone.
    """
    both = kept(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = kept(both.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("node"), F.least("a", "l").alias("comp")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("m"))
        step = labels.join(near, labels.node == near.a).select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("c"))
        to = step.select(F.col("node").alias("c"), F.col("c").alias("up"))
        after = kept(step.join(to, "c").select("node", F.least("c", "up").alias("comp"), (F.least("c", "up") < F.col("old")).alias("moved")), "labels")
        settled = after.where("moved").isEmpty()
        release(labels)
        labels = after
        if settled:
            release(both)
            out = labels.select("node", "comp")
            out.kept_path = labels.kept_path
            return out

"""Ranking helpers: top rows per group, first and last rows, row numbers without a hot task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.session import checkpoint


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group.

    The rank filter lets Spark keep at most ``n`` rows per group and task before the shuffle,
    so a hot group reaches one task as ``n`` rows from each input partition only.
    """
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.where(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_in_order(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Values of the row with the smallest ``order`` per group, by a map-side combined ``min_by``."""
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in columns])


def last_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 20) -> DataFrame:
    """The last ``n`` rows of each group, for example the tail of an event log."""
    return top_n(df, keys, [F.col(c).desc() for c in order], n)


#: Rows of a group that one task may sort; larger groups are cut into ranges of about half as many.
MOST_ROWS = 1 << 18


def sparse(df: DataFrame, keys: Sequence[str], most: int = MOST_ROWS, slots: int = 1 << 16) -> bool:
    """Whether surely no group has more than ``most`` rows: no slot of hashed keys has. Reads the keys only."""
    counts = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(slots)).alias("_slot")).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") > most).isEmpty()


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str, most: int = MOST_ROWS
) -> DataFrame:
    """Row numbers 1..n per group, exact, without sorting a large group in one task.

    ``order`` must be total. Groups are counted first, reading the columns of ``by`` only. If none has
    more than ``most`` rows, a window numbers them. Larger groups are cut into ranges of the order
    at every 64th of a hashed sample of their keys; a pass over the keys counts rows by group and
    range, and a row's number is its place in its range plus the rows of the ranges before it.
    The wide rows are shuffled once and never copied.
    """
    if not by:
        return numbered(df.withColumn("_all", F.lit(0)), ["_all"], order, name, most).drop("_all")
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(sort)])
    groups = df.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    large = checkpoint(groups)
    cuts = large.agg(F.coalesce(F.sum(F.ceil(F.col("_n") * 2 / most)), F.lit(0))).first()[0]
    if not cuts:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*sort)).cast("long"))

    def near(table: DataFrame) -> DataFrame:  # a cut takes some hundred bytes
        return F.broadcast(table) if cuts <= 100_000 else table

    def matched(left: DataFrame, table: DataFrame, how: str, more: Column | None = None) -> DataFrame:
        on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by] + ([] if more is None else [more])
        return left.join(near(table), on, how)

    some = F.greatest(F.lit(1), F.floor(F.lit(most / 128.0))).cast("long")
    sample = matched(df.select(*by, keys.alias("_key")), large, "inner").where(F.pmod(F.xxhash64("_key"), some) == 0)
    sample = sample.groupBy(*by).agg(F.sort_array(F.collect_list("_key")).alias("_s"))
    every = F.transform(F.sequence(F.lit(64), F.greatest(F.lit(64), F.size("_s")), F.lit(64)), lambda i: F.get("_s", i - 1))
    cut = checkpoint(sample.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.array_compact(every).alias("_cuts")))
    place = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_key"))), F.lit(0))
    ranged = matched(df.withColumn("_key", keys), cut, "left").withColumn("_range", place).select(*df.columns, "_range")
    sizes = matched(df.select(*by, keys.alias("_key")), cut, "left").withColumn("_range", place).groupBy(*by, "_range").count()
    # one row per group and range
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.sum("count").over(earlier)).where("_before > 0").select(
        *[F.col(c).alias(f"_of_{c}") for c in by], F.col("_range").alias("_of_range"), "_before")
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*sort))
    placed = matched(ranged.withColumn("_at", inside), offsets, "left", F.col("_range") == F.col("_of_range"))
    return placed.select(*df.columns, (F.col("_at") + F.coalesce("_before", F.lit(0))).cast("long").alias(name))

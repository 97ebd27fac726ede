"""Range joins as equi joins on bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(
    points: DataFrame, value: Column, intervals: DataFrame, low: Column, high: Column, width: float
) -> DataFrame:
    """Pairs with ``low <= value <= high``. ``width`` should be near the usual interval length.

    A point falls in one bin and an interval is copied to each bin it touches, so every pair is
    met exactly once and no pair far outside its interval is ever built.
    """
    a = points.withColumn("_bin", F.floor(value / width)).withColumn("_value", value)
    b = (
        intervals.withColumn("_low", low)
        .withColumn("_high", high)
        .withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_low") / width), F.floor(F.col("_high") / width))))
    )
    return (
        a.join(b, "_bin")
        .where(F.col("_value").between(F.col("_low"), F.col("_high")))
        .drop("_bin", "_value", "_low", "_high")
    )

"""Event log streams. Each transformation takes a streaming (or batch) table of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom import schemas
from massloom.operators.reports import event_aggregates, with_status
from massloom.session import scratch_dir


def stream_events(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The event log as a stream with an event time column ``ts``."""
    raw = (
        spark.readStream.schema(schemas.EVENT)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    return raw.where("pxd is not null").withColumn("ts", F.try_to_timestamp("timestamp"))


def stream_event_summary(events: DataFrame) -> DataFrame:
    """Running summary per project, the columns of the batch summary."""
    return with_status(events.groupBy("pxd").agg(*event_aggregates()))


def stream_event_windows(
    events: DataFrame, size: str = "1 hour", slide: str | None = None, watermark: str = "1 hour"
) -> DataFrame:
    """Events per process and level in tumbling or sliding windows; late rows are dropped."""
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    return (
        events.withWatermark("ts", watermark)
        .groupBy(span.alias("w"), "process", "level")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "process", "level", "n")
    )


def stream_sessions(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Runs of a project: bursts of events parted by an inactivity gap."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.session_window("ts", gap).alias("s"), "pxd")
        .agg(F.count("*").alias("n_events"), F.max("ts").alias("last_ts"), F.count_if(F.col("level") == "ERROR").alias("errors"))
        .select(
            "pxd", F.col("s.start").alias("started"), "last_ts", "n_events", "errors",
            F.timestamp_diff("SECOND", F.col("s.start"), F.col("last_ts")).alias("seconds"),
        )
    )


def stream_dedupe(events: DataFrame, keys: Sequence[str], watermark: str = "1 day") -> DataFrame:
    """Each event once, though logs of a restart or a sub-folder repeat it."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(list(keys))


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process all input there is and return the written result.

    ``append`` writes with the file sink, which is exactly-once. ``complete`` and ``update``
    write each batch to its own folder; for ``complete`` the last batch is the result.
    """
    spark = stream.sparkSession
    root = scratch_dir(spark, name)
    out, state = f"{root}/out", f"{root}/state"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:
        def save(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        query = writer.foreachBatch(save).start()
    query.awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(out) if mode == "append" else spark.read.parquet(out)
    if mode == "complete":
        last = rows.agg(F.max("batch")).first()[0]
        return spark.read.parquet(f"{out}/batch={last}")
    return rows.drop("batch")

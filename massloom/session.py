"""Session defaults, and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "massloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only for a local master."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="massloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared folder, for written tables and stream state."""
    return f"{_shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, for tables that are read several times by
    different columns: each reading takes its own columns only."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(_shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done, and checkpoints that nothing reads: it does so
    once the driver has collected its garbage, which may otherwise be long after a large step."""
    gc.collect()
    spark._jvm.System.gc()

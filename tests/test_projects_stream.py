"""Project summaries that drop their state, and sketches that are stored and united."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from massloom.operators import psm as ops, reports
from massloom.streaming import events as st, projects

START = datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, projects.STORE)
    yield
    spark.conf.set(key, before)


def log(seed=1):
    """Events of projects that begin one after another; each ends with a completion."""
    rng, out = random.Random(seed), []
    for p in range(30):
        at = START + timedelta(minutes=20 * p)
        for i in range(rng.randint(1, 25)):
            at += timedelta(seconds=rng.randint(0, 90), microseconds=rng.randint(0, 999_999))
            out.append((at, f"PXD{p}", rng.choice(["ERROR", "WARNING", "INFO", "INFO", "DEBUG"]), rng.choice(["step", "decision", "skip"]), rng.choice(["search", "fetch", "llm"])))
        out.append((at, f"PXD{p}", "INFO", "completion", "report"))
    out.append((START + timedelta(days=9), "PXD999", "INFO", "step", "fetch"))  # moves event time past all others
    return out


def write(folder, rows, files, seed):
    """Files by time, rows shuffled inside, neighbouring files swapped."""
    rows, rng = sorted(rows), random.Random(seed)
    size = -(-len(rows) // files)
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    for i in range(0, len(parts) - 2, 2):
        parts[i], parts[i + 1] = parts[i + 1], parts[i]
    for k, part in enumerate(parts):
        rng.shuffle(part)
        lines = [json.dumps({"timestamp": t.isoformat(), "pxd": p, "level": lv, "category": c, "process": x}) for t, p, lv, c, x in part]
        (folder / f"part-{k:03d}.json").write_text("\n".join(lines))


def summary(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("files", [1, 8])
def test_summaries_of_a_shuffled_log_equal_the_batch(spark, rocks, tmp_path, files):
    write(tmp_path, log(), files, files)
    events = st.stream_events(spark, str(tmp_path), files_per_trigger=1)
    out = projects.stream_project_summaries(events, F.col("category") == "completion", idle="30 days", watermark="3 hours")
    got = st.run_available(out, "projects")
    batch = spark.read.schema(events.drop("ts").schema).json(str(tmp_path)).withColumn("ts", F.to_timestamp("timestamp"))
    assert summary(got) == summary(reports.event_summary(batch.where("pxd <> 'PXD999'")))


def test_state_holds_open_projects_only(spark, rocks, tmp_path):
    write(tmp_path, log(), 12, 3)
    events = st.stream_events(spark, str(tmp_path), files_per_trigger=1)
    out = projects.stream_project_summaries(events, F.col("category") == "completion", idle="30 days", watermark="3 hours")
    query = out.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}-state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    held = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    assert max(held) > 2 * held[-1] and held[-1] <= 6


def test_an_idle_project_is_over_without_a_completion(spark, rocks, tmp_path):
    rows = [(START, "A", "INFO", "step", "x"), (START + timedelta(minutes=50), "A", "ERROR", "step", "y"), (START + timedelta(days=2), "B", "INFO", "step", "x")]
    write(tmp_path, rows, 1, 1)
    out = projects.stream_project_summaries(st.stream_events(spark, str(tmp_path)), F.lit(False), idle="1 hour", watermark="0 seconds")
    got = st.run_available(out, "idle").collect()
    assert [(r.pxd, r.total_events, r.error_events, r.processes, r.status) for r in got] == [("A", 2, 1, "x;y", "completed_with_errors")]


def test_united_sketches_are_within_their_error(spark):
    rows = spark.range(120_000).select(
        F.concat(F.lit("run"), F.col("id") % 7).alias("filename"), F.concat(F.lit("P"), F.pmod(F.xxhash64("id"), F.lit(30_000))).alias("peptide"),
        F.concat(F.lit("q"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900)), F.lit(";q"), F.col("id") % 50).alias("proteins"))
    stored = ops.run_sketches(rows).cache()
    exact = rows.agg(F.count_distinct("peptide").alias("n")).first().n
    got = ops.united_sketches(stored).first()
    proteins = ops.distinct_proteins(rows).first().proteins_distinct
    assert got.num_psms == 120_000 and abs(got.unique_peptides - exact) < 0.04 * exact and abs(got.distinct_proteins - proteins) < 0.04 * proteins
    halves = ops.united_sketches(ops.run_sketches(rows.withColumn("half", F.col("filename") < "run3"), ["half", "filename"]), ["half"]).collect()
    assert sum(r.num_psms for r in halves) == 120_000 and len(halves) == 2
    empty = ops.united_sketches(ops.run_sketches(rows.withColumn("proteins", F.lit("")))).first()
    assert empty.distinct_proteins == 0

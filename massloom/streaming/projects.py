"""Project summaries from the event log that leave no state behind."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from massloom.operators.reports import with_status

#: The state store that timers need, a setting of the session.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LEVELS = ("ERROR", "WARNING", "INFO", "DEBUG")
COUNTS = ["total_events", *[f"{v.lower()}_events" for v in LEVELS], "decisions", "skips"]
_COUNTED = ", ".join(f"{c} long" for c in COUNTS)
STATE = f"{_COUNTED}, search_skipped boolean, processes string, first_us long, last_us long, over_us long, timer long"
OUTPUT = f"pxd string, {_COUNTED}, search_skipped boolean, processes string, first_us long, last_us long"


class ProjectSummary(StatefulProcessor):
    """Keeps one row per open project and a timer: at the completion event's time, or ``idle_ms`` after
    its last event. When event time has passed it, the summary is emitted and the row dropped."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("summary", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        n = dict(zip(COUNTS, held[: len(COUNTS)] if held else [0] * len(COUNTS), strict=True))
        skipped, names, first, last, over, timer = held[len(COUNTS) :] if held else (False, "", None, None, None, None)
        processes, ends = {p for p in (names or "").split(";") if p}, None
        for b in rows:  # a project has few rows at a time, for which lists are far faster than columns
            level, category, process, us, done = (b[c].tolist() for c in ("level", "category", "process", "us", "done"))
            n["total_events"] += len(us)
            for v in LEVELS:
                n[f"{v.lower()}_events"] += level.count(v)
            n["decisions"] += category.count("decision")
            n["skips"] += category.count("skip")
            skipped |= ("skip", "search") in zip(category, process, strict=True)
            processes.update(p for p in process if isinstance(p, str))
            first = min(x for x in (first, *us) if x is not None)
            last = max(x for x in (last, *us) if x is not None)
            ends = max((x for x in (ends, *(u for u, d in zip(us, done, strict=True) if d == 1)) if x is not None), default=None)
        # a completion's time stands; without one the timer moves with the last event
        over = ends if ends is not None else over
        due = -(-over // 1000) if over is not None else -(-last // 1000) + self.idle_ms
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if timer != due:
            self.handle.registerTimer(due)
        self.state.update((*n.values(), skipped, ";".join(sorted(processes)), first, last, over, due))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        self.state.clear()
        if held:
            names = [*COUNTS, "search_skipped", "processes", "first_us", "last_us"]
            yield pd.DataFrame([(key[0], *held[:-2])], columns=["pxd", *names])

    def close(self) -> None:
        pass


def stream_project_summaries(events: DataFrame, completed: Column, idle: str = "7 days", watermark: str = "1 hour") -> DataFrame:
    """The batch summary's columns, once for each project when it is over.

    A project is over when event time (the newest event less ``watermark``) has passed an event
    that is ``completed``, or ``idle`` after its last event; its state is then dropped, so state holds
    open projects only. Events may come in any order within the watermark; later ones are dropped.
    Rows without a project or a time take no part. The session needs the state store ``STORE``.
    """
    seconds = events.sparkSession.sql(f"select cast(interval '{idle}' as interval day to second) as i").first().i.total_seconds()
    rows = events.where("pxd is not null and ts is not null").withWatermark("ts", watermark)
    rows = rows.select("pxd", "level", "category", "process", F.unix_micros("ts").alias("us"), completed.alias("done"), "ts")
    out = rows.groupBy("pxd").transformWithStateInPandas(
        statefulProcessor=ProjectSummary(int(seconds * 1000)), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
    times = {f"{n}_ts": F.timestamp_micros(f"{n}_us") for n in ("first", "last")}
    return with_status(out.withColumns(times).drop("first_us", "last_us"))

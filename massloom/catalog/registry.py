"""The register itself. Query modules add to it when they are imported."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.catalog.inputs import Inputs, plain_sql

MODULES = ["matches", "modifications", "spectra", "peptides", "organisms", "projects", "summaries", "formats"]
_ENTRIES: dict[str, tuple[Callable[[Inputs], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    """Register a function of :class:`Inputs` under its own name."""

    def keep(fn: Callable[[Inputs], DataFrame]):
        _ENTRIES[fn.__name__] = (fn, sql)
        return fn

    return keep


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


def _load() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    for name in MODULES:
        import_module(f"massloom.catalog.{name}")
    return _ENTRIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: fn(Inputs(spark, folder))

    return {name: bind(fn) for name, (fn, _) in _load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: plain_sql(sql) for name, (_, sql) in _load().items() if sql}

"""Evidence from several sources brought together per file and per project."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.functions import text as tx


def valid_taxids(df: DataFrame, column: str = "taxid") -> DataFrame:
    """Rows whose taxid, read from an accession, is made of digits only."""
    found = tx.taxid(F.col(column))
    return df.withColumn(column, found).where(tx.is_taxid(F.col(column)))


def invalid_taxids(df: DataFrame, warning: str, column: str = "taxid") -> DataFrame:
    """Typed warnings for rows whose taxid is not a number."""
    return df.where(~tx.is_taxid(F.col(column))).select(
        "pxd", "raw_file", F.lit(warning).alias("warning"), F.col(column).alias("value")
    )


def reconcile_taxids(
    files: DataFrame, organism: DataFrame, llm: DataFrame, project: DataFrame, default: str | None = None
) -> DataFrame:
    """Taxid per file with its source and a typed warning.

    ``files``, ``organism`` and ``llm`` are keyed by (pxd, raw_file), ``project`` by pxd. Taxids
    are text. Agreement of organism and LLM wins, their conflict falls back to the project and
    never to the default, then organism, LLM, project and default in that order.
    """
    keys = ["pxd", "raw_file"]
    evidence = organism.select(*keys, F.col("taxid").alias("organism_taxid")).join(
        llm.select(*keys, F.col("taxid").alias("llm_taxid")), keys, "full"
    )
    rows = files.select(*keys).join(evidence, keys, "left").join(
        project.select("pxd", F.col("taxid").alias("project_taxid")), "pxd", "left"
    )
    o, l, p = (F.col(f"{s}_taxid") for s in ("organism", "llm", "project"))
    agree, clash = o.isNotNull() & l.isNotNull() & (o == l), o.isNotNull() & l.isNotNull() & (o != l)
    given = F.lit(default).cast("string")
    source = (
        F.when(agree, "organism_id+LLM (agreed)")
        .when(clash & p.isNotNull(), "PRIDE (fallback from disagreement)")
        .when(clash, F.lit(None))
        .when(o.isNotNull(), "organism_id")
        .when(l.isNotNull(), "LLM")
        .when(p.isNotNull(), "PRIDE")
        .when(given.isNotNull(), "default")
    )
    warning = (
        F.when(clash & p.isNotNull(), "TAXID_DISAGREEMENT_PRIDE_FALLBACK")
        .when(clash, "TAXID_DISAGREEMENT")
        .when(o.isNotNull() | l.isNotNull(), F.lit(None))
        .when(p.isNotNull(), "USING_PRIDE_TAXID")
        .when(given.isNotNull(), "USING_DEFAULT_TAXID")
        .otherwise("NO_TAXID_FOUND")
    )
    return rows.select(
        *keys,
        F.when(clash, p).otherwise(F.coalesce(o, l, p, given)).alias("taxid"),
        source.alias("source"), warning.alias("warning"),
        "organism_taxid", "llm_taxid", "project_taxid",
    )


def taxid_report(mapping: DataFrame) -> DataFrame:
    """Warnings of a project with summary counts; the warnings themselves are rows of ``mapping``."""
    kinds = [
        "TAXID_DISAGREEMENT_PRIDE_FALLBACK", "TAXID_DISAGREEMENT", "USING_PRIDE_TAXID",
        "USING_DEFAULT_TAXID", "NO_TAXID_FOUND",
    ]
    return mapping.groupBy("pxd").agg(
        F.count("warning").alias("total_warnings"),
        F.count("taxid").alias("files_with_taxid"),
        F.count_if(F.col("taxid").isNull()).alias("files_without_taxid"),
        *[F.count_if(F.col("warning") == k).alias(k.lower()) for k in kinds],
    )


def combine_projects(*parts: DataFrame, how: str = "left", key: str = "pxd") -> DataFrame:
    """Join result tables on the project. ``left`` keeps every project of the first table."""
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, key, how)
    return out


def drop_failed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every upstream result is present."""
    return df.dropna(how="any", subset=list(columns))


def with_run_facts(files: DataFrame, facts: DataFrame, column: str = "raw_file") -> DataFrame:
    """Facts per run joined by project and file stem."""
    keys = [k for k in ("pxd",) if k in files.columns and k in facts.columns] + ["stem"]
    return files.withColumn("stem", tx.stem(F.col(column))).join(facts, keys, "left")


def unconverted(raw: DataFrame, converted: DataFrame) -> DataFrame:
    """Raw files without a converted file of the same stem in their project."""
    done = converted.select("pxd", tx.stem(F.col("file")).alias("stem")).distinct()
    return raw.withColumn("stem", tx.stem(F.col("file"))).join(done, ["pxd", "stem"], "left_anti")


def conversion_rate(raw: DataFrame, converted: DataFrame) -> DataFrame:
    """Raw and converted files per project, and their ratio."""
    a = raw.groupBy("pxd").agg(F.count("*").alias("raw_files"))
    b = converted.groupBy("pxd").agg(F.count("*").alias("converted_files"))
    missing = unconverted(raw, converted).groupBy("pxd").agg(F.count("*").alias("failed_files"))
    n = F.coalesce("converted_files", F.lit(0))
    return a.join(b, "pxd", "left").join(missing, "pxd", "left").select(
        "pxd", "raw_files", n.alias("converted_files"),
        F.coalesce("failed_files", F.lit(0)).alias("failed_files"),
        (n / F.col("raw_files")).alias("conversion_rate"),
    )


def with_publication(projects: DataFrame, texts: DataFrame) -> DataFrame:
    """Projects that have cached publication text, with it."""
    return projects.join(texts, "accession")


def with_truth(scores: DataFrame, truth: DataFrame) -> DataFrame:
    """The true taxon per project; with several pairs the last in ``ord`` wins."""
    last = truth.groupBy("pxd").agg(F.max_by("parent_taxid", "ord").alias("parent_taxid"))
    return scores.join(last, "pxd", "left")


def with_exit_codes(log: DataFrame, exits: DataFrame) -> DataFrame:
    """Log entries with the exit code of each folder whose hash starts as logged.

    ``exits``: prefix, folder, exit_code; the logged hash is the first six characters.
    """
    codes = exits.select("prefix", F.substring("folder", 1, 6).alias("short_hash"), "folder", "exit_code")
    return log.join(codes, ["prefix", "short_hash"], "left")

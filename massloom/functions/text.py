"""Identifiers, paths, accessions and vocabulary lookups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from massloom.functions import rules
from massloom.functions.vocabulary import first_named, names_in, words_of
from massloom.schemas import known


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def scan_number(col: Column) -> Column:
    """Digits after ``scan=``, else the last run of digits, else NULL."""
    tagged = F.regexp_extract(col, r"scan=(\d+)", 1)
    last = F.regexp_extract(col, r"(\d+)\D*$", 1)
    return F.coalesce(blank_to_null(tagged), blank_to_null(last)).try_cast("bigint")


def strip_mods(col: Column, dialect: str = "brackets") -> Column:
    """Bare sequence. Dialects: ``brackets``, ``denovo`` (leading ``[x]-`` too), ``letters``."""
    if dialect == "brackets":
        return F.regexp_replace(col, r"\[.*?\]", "")
    if dialect == "denovo":
        return F.trim(F.regexp_replace(col, r"^\[.*?\]-|\[.*?\]", ""))
    if dialect == "letters":
        return F.regexp_replace(col, r"\(UniMod:\d+\)|\[[^\]]*\]|[^A-Z]", "")
    raise ValueError(f"unknown dialect {dialect!r}")


def first_protein(col: Column) -> Column:
    return F.substring_index(col, ";", 1)


def n_proteins(col: Column) -> Column:
    """Members of a ``;`` list; an empty or missing list has none."""
    return F.when(F.coalesce(col, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(col, ";")))


def basename(col: Column) -> Column:
    return F.regexp_extract(col, r"([^/\\]*)$", 1)


def stem(col: Column) -> Column:
    """File name without its folder and its last extension."""
    return F.regexp_replace(basename(col), r"(?<=.)\.[^.]*$", "")


def path_parts(col: Column) -> Column:
    """Struct of what a result path says: name, stem, run folder, raw file, project, threshold."""
    folder = blank_to_null(
        F.regexp_extract(col, r"[^/]*(?:CasanovoSequence|CascadiaSequence)[^/]*/([^/]+)", 1)
    )
    bare = blank_to_null(F.regexp_extract(folder, r"PXD\d+_(.*)", 1))
    return F.struct(
        basename(col).alias("name"),
        stem(col).alias("stem"),
        folder.alias("run_folder"),
        F.concat(F.coalesce(bare, folder), F.lit(".raw")).alias("raw_file"),
        blank_to_null(F.regexp_extract(col, r"(PXD\d+)", 1)).alias("pxd"),
        blank_to_null(F.regexp_extract(col, r"filtered(\d+)pct", 1)).try_cast("int").alias("threshold"),
    )


def taxid(col: Column) -> Column:
    """The first run of digits of an accession, with or without a taxonomy prefix."""
    return blank_to_null(F.regexp_extract(col, r"(?i)(?:NEWT:|taxid:)?(\d+)", 1))


def is_taxid(col: Column) -> Column:
    return F.coalesce(F.trim(col).rlike(r"^\d+$"), F.lit(False))


def aa_score_avg(col: Column) -> Column:
    """Mean of a comma list; NULL if the list is empty or any member is not a number."""
    parts = F.filter(F.split(col, ","), lambda x: x != "")
    values = F.transform(parts, lambda x: x.try_cast("double"))
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def llm_json(col: Column, schema: str) -> Column:
    """An answer as a struct: the whole text, else the first json block, else the first block."""
    fenced = F.regexp_extract(col, r"(?s)```json\s*(.*?)```", 1)
    any_block = F.regexp_extract(col, r"(?s)```(?:json)?\s*(.*?)```", 1)
    candidates = [F.trim(c) for c in (col, fenced, any_block)]
    return F.coalesce(*[F.when(c.rlike(r"(?s)^[\[{].*[\]}]$"), F.from_json(c, schema)) for c in candidates])


def cv_map(col: Column, kind: str) -> Column:
    """Vocabulary term for ``acquisition``, ``dissociation``, ``label`` or ``analyzer``."""
    if kind == "analyzer":
        return let(names_in(words_of(col), "analyzer"), lambda found: first_named(found, "analyzer"))
    table = {
        "acquisition": rules.ACQUISITION_CV,
        "dissociation": rules.DISSOCIATION_CV,
        "label": rules.LABEL_CV,
    }[kind]
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, F.lower(F.trim(col))), F.lit("not available"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_known(*cols: Column) -> Column:
    """The first value that is not a missing mark, else ``not available``."""
    return F.coalesce(*[known(c) for c in cols], F.lit("not available"))


def duration_text(start: Column, end: Column) -> Column:
    """``1h 2m 3s``, ``2m 3s`` or ``3s``; ``unknown`` if an end is missing."""
    secs = F.timestamp_diff("SECOND", start, end)
    h, m, s = F.floor(secs / 3600), F.floor(F.pmod(secs, F.lit(3600)) / 60), F.pmod(secs, F.lit(60))
    return (
        F.when(secs.isNull(), F.lit("unknown"))
        .when(h > 0, F.concat(h, F.lit("h "), m, F.lit("m "), s, F.lit("s")))
        .when(m > 0, F.concat(m, F.lit("m "), s, F.lit("s")))
        .otherwise(F.concat(s, F.lit("s")))
    )

"""Explicit schemas, and helpers for inputs whose columns or missing marks vary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "ARRAY<DOUBLE>": T.ArrayType(T.DoubleType()),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def _ddl(text: str) -> T.StructType:
    """A flat schema; no session is needed, so that modules can be imported before one exists."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in text.split(", "))])


PSM = _ddl(
    "psm_id BIGINT, peptide STRING, proteins STRING, num_proteins INT, filename STRING, "
    "scannr STRING, rank INT, label INT, expmass DOUBLE, calcmass DOUBLE, charge INT, "
    "peptide_len INT, missed_cleavages INT, semi_enzymatic INT, isotope_error DOUBLE, "
    "precursor_ppm DOUBLE, fragment_ppm DOUBLE, hyperscore DOUBLE, delta_next DOUBLE, "
    "delta_best DOUBLE, rt DOUBLE, aligned_rt DOUBLE, predicted_rt DOUBLE, "
    "delta_rt_model DOUBLE, ion_mobility DOUBLE, predicted_mobility DOUBLE, "
    "delta_mobility DOUBLE, matched_peaks INT, longest_b INT, longest_y INT, "
    "longest_y_pct DOUBLE, matched_intensity_pct DOUBLE, scored_candidates INT, "
    "poisson DOUBLE, sage_discriminant_score DOUBLE, posterior_error DOUBLE, "
    "spectrum_q DOUBLE, peptide_q DOUBLE, protein_q DOUBLE, ms2_intensity DOUBLE"
)

DIA_EXTRA = _ddl(
    "search_engine STRING, diann_precursor_id STRING, diann_modified_sequence STRING, "
    "diann_precursor_mz DOUBLE, diann_global_q_value DOUBLE, diann_pep DOUBLE, "
    "diann_channel STRING"
)

EVENT = _ddl(
    "timestamp STRING, pxd STRING, process STRING, level STRING, category STRING, "
    "message STRING, details MAP<STRING,STRING>"
)

SPECTRUM = _ddl(
    "pxd STRING, filename STRING, spectrum_id STRING, ms_level INT, filter_string STRING, "
    "precursor_mz DOUBLE, charge INT, iso_lower DOUBLE, iso_upper DOUBLE, "
    "mz ARRAY<DOUBLE>, intensity ARRAY<DOUBLE>"
)

_RUN = (
    "STRUCT<instrument_model: STRUCT<accession: STRING, name: STRING, category: STRING>, "
    "spectra_stats: STRUCT<acquisition_type: STRING, fragmentation_type: STRING, "
    "fragmentation_tag: STRING, high_accuracy_precursors: STRING, n_spectra: BIGINT, "
    "n_ms1_spectra: BIGINT, n_ms2_spectra: BIGINT>, "
    "summary: STRUCT<fragmentation_type: STRING, "
    "labeling: STRUCT<call: STRING, scores: MAP<STRING, DOUBLE>>>>"
)

_STUDY = (
    f"files MAP<STRING, {_RUN}>, "
    "search_criteria STRUCT<acquisition_type: STRING, fragmentation_type: STRING, "
    "high_accuracy_precursors: STRING, labeling: STRING>, "
    "knowledge STRUCT<instrument_model: STRING>, spectra_stats MAP<STRING, BIGINT>, "
    "state STRUCT<status: STRING, code: STRING, message: STRING>"
)

# The study document may stand alone or sit under a key of the aggregated document.
STUDY = f"pxd_id STRING, runAssessor STRUCT<{_STUDY}>, {_STUDY}"

PUBLICATION = (
    "documents ARRAY<STRUCT<passages: ARRAY<STRUCT<text: STRING, "
    "infons: STRUCT<section_type: STRING>>>>>"
)

PROJECT = (
    "accession STRING, doi STRING, references ARRAY<STRUCT<pubmedID: STRING, doi: STRING>>, "
    "files ARRAY<STRUCT<fileName: STRING, fileSizeBytes: BIGINT, "
    "publicFileLocations: ARRAY<STRUCT<name: STRING, value: STRING>>>>, "
    "organisms ARRAY<STRUCT<name: STRING, accession: STRING>>, "
    "experimentTypes ARRAY<STRUCT<name: STRING>>, "
    "sampleProcessingProtocol STRING, dataProcessingProtocol STRING"
)

TAXON_SCORE = _ddl("taxon_name STRING, taxon_id STRING, score DOUBLE")

# fixed values: taxonomic ranks, from broad to narrow
RANKS = (
    "domain realm subkingdom superphylum phylum subphylum superclass class subclass "
    "superorder order suborder infraorder superfamily family subfamily tribe subtribe "
    "genus subgenus species_group species_subgroup species subspecies strain varietas forma"
).split()


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first of ``candidates`` that ``df`` has; decided at plan time."""
    return next((name for name in candidates if name in df.columns), None)


def col_or_null(df: DataFrame, candidates: Sequence[str] | str, dtype: str) -> Column:
    """The first present candidate cast to ``dtype``, else a typed NULL."""
    name = resolve_column(df, [candidates] if isinstance(candidates, str) else candidates)
    return F.lit(None).cast(dtype) if name is None else F.col(f"`{name}`").cast(dtype)


def known(col: Column) -> Column:
    """NULL for blanks and for the words that stand for a missing value."""
    text = F.trim(col.cast("string"))
    return F.when(~F.upper(text).isin("", "UNKNOWN", "NONE", "NULL", "N/A", "NOT AVAILABLE"), text)

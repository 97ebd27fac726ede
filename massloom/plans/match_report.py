"""From raw match tables to the per-run result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.operators import psm as ops


def best_match_report(psm: DataFrame, q: float = 0.01, n: int = 10) -> DataFrame:
    """Per run: best matches, unique peptides, protein mentions and the quality gate.

    Matches are reduced to the best of each spectrum first; the counts of a run then come from
    one grouped pass over what is left.
    """
    best = ops.best_psm(psm.select("filename", "scannr", "hyperscore", "peptide", "proteins", "spectrum_q"))
    members = F.size(F.split(F.coalesce("proteins", F.lit("")), ";"))
    confident = F.count_if(F.col("spectrum_q") < q)
    return best.groupBy("filename").agg(
        F.count("*").alias("num_psms"),
        F.count_distinct("peptide").alias("num_unique_peptides"),
        F.sum(members).cast("bigint").alias("protein_mentions"),
        confident.alias("confident_psms"),
        (confident >= n).alias("passed"),
    )

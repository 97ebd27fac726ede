"""Modification discovery and site fractions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from massloom.operators import mods, psm as ops


def discover(ptm: DataFrame, unimod: DataFrame, n: int = 3, min_percent: float = 0.005) -> DataFrame:
    """Search settings from a modification summary: filter, keep the largest, match, lay out."""
    return mods.mods_to_maps(mods.top_ptms(mods.filter_ptm(ptm, min_percent), n), unimod)


def run_site_fractions(
    psm: DataFrame, unimod: DataFrame, by: Sequence[str] = ("filename",), q: float = 0.01, n: int = 10
) -> DataFrame:
    """Site fractions of the runs that pass the quality gate, best match per spectrum."""
    best = ops.best_psm(psm.select(*{*by, "filename", "scannr", "hyperscore", "peptide", "spectrum_q"}))
    return mods.site_fractions(ops.passing(best, by, q, n), unimod, by)

"""Mass arithmetic and peptide scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from massloom.functions import rules


def mz(mass: Column, z: Column) -> Column:
    """m/z of a neutral mass."""
    return (mass + z * F.lit(rules.PROTON)) / z


def neutral_mass(mz_col: Column, z: Column) -> Column:
    return mz_col * z - z * F.lit(rules.PROTON)


def mass_error_ppm(calc: Column, obs: Column, z: Column, isotope: Column | int = 0) -> Column:
    """Error relative to the observed m/z after taking ``isotope`` heavy atoms off it."""
    iso = F.lit(isotope) if isinstance(isotope, int) else isotope
    return (calc - (obs - iso * F.lit(rules.ISOTOPE_STEP) / z)) / obs * F.lit(1e6)


def fits_precursor(
    calc: Column, obs: Column, z: Column, tol: float = 50.0, lo: int = 0, hi: int = 1
) -> Column:
    """True if any isotope number in [lo, hi] brings the error strictly below ``tol``."""
    out = F.lit(False)
    for isotope in range(lo, hi + 1):
        out = out | (F.abs(mass_error_ppm(calc, obs, z, isotope)) < tol)
    return out


def peptide_score(scores: Column, fits: Column | None = None) -> Column:
    """Product of residue scores clipped to [eps, 1]; one less if the mass does not fit."""
    log_sum = F.aggregate(
        scores,
        F.lit(0.0),
        lambda acc, x: acc
        + F.ln(F.greatest(F.least(x.cast("double"), F.lit(1.0)), F.lit(rules.SCORE_EPS))),
    )
    score = F.exp(log_sum)
    return score if fits is None else F.when(fits, score).otherwise(score - 1)


def tag_masses(peptide: Column) -> Column:
    """Masses written in brackets with a decimal point, in order."""
    found = F.regexp_extract_all(peptide, F.lit(r"\[([+-]?\d+\.\d+)\]"), F.lit(1))
    return F.transform(found, lambda m: m.cast("double"))


def variable_mass(peptide: Column, static: Sequence[float] = (57.02146,)) -> Column:
    """Sum of the tag masses that are not within 0.01 of a static mass."""

    def moving(m: Column) -> Column:
        keep = F.lit(True)
        for s in static:
            keep = keep & (F.abs(m - F.lit(float(s))) >= 0.01)
        return keep

    return F.aggregate(F.filter(tag_masses(peptide), moving), F.lit(0.0), lambda acc, m: acc + m)


def sequence_mass(peptide: Column) -> Column:
    """Neutral mass of a bare sequence; NULL if it has a letter without a mass."""
    lookup = F.create_map(*[F.lit(x) for pair in rules.RESIDUE_MASS.items() for x in pair])
    letters = F.filter(F.split(peptide, ""), lambda a: a != "")
    return F.aggregate(letters, F.lit(rules.WATER), lambda acc, a: acc + F.try_element_at(lookup, a))

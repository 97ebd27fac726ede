"""De novo predictions: filtering, contaminants, peptide scores, evaluation, candidates."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.functions import mass as mz, rules
from massloom.operators.ranges import interval_join
from massloom.operators.ranking import top_n
from massloom.session import checkpoint


def filter_denovo(
    df: DataFrame, pct: int = 80, min_len: int = 10, sequence: str = "stripped_sequence", score: str = "score"
) -> DataFrame:
    """Sequences longer than ``min_len`` with a score of at least ``pct`` / 100."""
    return df.where((F.length(sequence) > min_len) & (F.col(score) >= pct / 100.0))


# K or R is cut unless P follows; before P only WK and MR are cut
TRYPSIN = r"(?<=[KR])(?!P)|(?<=WK)(?=P)|(?<=MR)(?=P)"


#: Residues that a task digests, about; its distinct peptides take some hundred MB.
DIGESTED = 1 << 22


def digest(
    proteins: DataFrame, missed: int = 2, min_len: int = 6, max_len: int = 50, rule: str = TRYPSIN
) -> DataFrame:
    """Distinct (accession, peptide) of a digestion with up to ``missed`` missed cleavages.

    Residues are counted first, and proteins dealt over so many tasks that none holds the peptides of a whole file.
    """
    residues = proteins.agg(F.sum(F.length("sequence"))).first()[0] or 0
    dealt = proteins.select("accession", "sequence").repartition(-(-residues // DIGESTED) or 1, "accession", "sequence")
    pieces = dealt.select(
        "accession", F.filter(F.split("sequence", rule), lambda p: p != "").alias("pieces")
    )
    spans = pieces.select(
        "accession", "pieces", F.explode(F.sequence(F.lit(1), F.greatest(F.size("pieces"), F.lit(1)))).alias("at")
    ).select(
        "accession",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.lit(missed + 1)),
                lambda n: F.when(
                    F.col("at") + n - 1 <= F.size("pieces"),
                    F.array_join(F.slice("pieces", F.col("at"), n), ""),
                ),
            )
        ).alias("peptide"),
    )
    return spans.where(F.length("peptide").between(min_len, max_len)).distinct()


def remove_contaminants(df: DataFrame, contaminant_peptides: DataFrame, column: str = "peptide") -> DataFrame:
    """Rows whose peptide is not among the contaminant peptides."""
    return df.join(
        contaminant_peptides.select(F.col("peptide").alias(column)).distinct(), column, "left_anti"
    )


def enough_peptides(df: DataFrame, n: int = 5, by: Sequence[str] = ("run",)) -> DataFrame:
    """Rows of the runs with at least ``n`` peptides."""
    counts = df.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") >= n)
    return df.join(counts.select(*by), list(by), "left_semi")


def peptide_scores(
    df: DataFrame, keep: str = "max", by: Sequence[str] = (), order: str | None = None
) -> DataFrame:
    """Score and match count per peptide; ``keep`` is ``max``, or ``last`` along ``order``."""
    if keep == "max":
        score = F.max("score")
    elif keep == "last" and order:
        score = F.max_by("score", order)
    else:
        raise ValueError("keep must be 'max', or 'last' with an order column")
    return df.groupBy(*by, "peptide").agg(score.alias("score"), F.count("*").alias("psms"))


def denovo_report(df: DataFrame, by: Sequence[str] = ("run",), thresholds: Sequence[float] = rules.SECTION_SCORES) -> DataFrame:
    """Spectra, counts at each score threshold, shortest, median and longest sequence."""
    length = F.length("sequence")
    return df.groupBy(*by).agg(
        F.count("*").alias("num_spectra"),
        *[F.count_if(F.col("score") >= t).alias(f"score_ge_{round(t * 100)}") for t in thresholds],
        F.min(length).alias("min_length"),
        F.median(length).alias("median_length"),
        F.max(length).alias("max_length"),
    )


def top_matches(df: DataFrame, n: int = 1, by: Sequence[str] = ("spectrum_id",), score: str = "score") -> DataFrame:
    """The ``n`` best matches per spectrum with their ``rank``; ties by sequence."""
    return top_n(df, by, [F.col(score).desc_nulls_last(), F.col("sequence")], n, rank="rank")


def candidates(
    spectra: DataFrame, peptides: DataFrame, ppm: float = 50.0, isotopes: tuple[int, int] = (0, 1)
) -> DataFrame:
    """Peptides whose mass fits a spectrum's precursor for some isotope number.

    ``spectra``: spectrum_id, precursor_mz, charge. ``peptides``: sequence, mass. Log mass makes
    the tolerance one constant width, so each spectrum meets only peptides near its own mass. A pair
    that fits several isotopes is kept where it meets at the nearest, so pairs are never shuffled.
    """
    lo, hi = isotopes
    near = spectra.distinct().withColumn("isotope", F.explode(F.sequence(F.lit(lo), F.lit(hi)))).withColumn(
        "_mz", F.col("precursor_mz") - F.col("isotope") * rules.ISOTOPE_STEP / F.col("charge")
    )
    target = mz.neutral_mass(F.col("_mz"), F.col("charge"))
    slack = F.col("charge") * F.col("precursor_mz") * (ppm * 1.01e-6)
    near = near.withColumn("_target", target).where("_target > 1")
    pairs = interval_join(
        peptides.distinct(), F.ln("mass"), near,
        F.ln(F.greatest(F.col("_target") - slack, F.lit(0.5))), F.ln(F.col("_target") + slack), 2e-6 * ppm,
    )

    def error(isotope: Column) -> Column:
        return mz.mass_error_ppm(mz.mz(F.col("mass"), F.col("charge")), F.col("precursor_mz"), F.col("charge"), isotope)

    found = error(F.col("isotope"))
    # a smaller isotope wins a tie
    others = [(F.col("isotope") == i) | (F.abs(error(F.lit(i))) > F.abs(found)) | (
        (F.abs(error(F.lit(i))) == F.abs(found)) & (F.col("isotope") < i)) for i in range(lo, hi + 1)]
    fit = pairs.withColumn("ppm", found).where(F.abs("ppm") < ppm)
    for nearest in others:
        fit = fit.where(nearest)
    keep = [c for c in fit.columns if c not in ("isotope", "ppm", "_mz", "_target")]
    return fit.select(*keep, "isotope", "ppm")


def candidate_summary(
    spectra: DataFrame, peptides: DataFrame, ppm: float = 50.0, isotopes: tuple[int, int] = (0, 1)
) -> DataFrame:
    """Per spectrum: number of :func:`candidates` and the one with the smallest error, ties by sequence.

    Pairs are as many as spectra times peptides of one mass, so they are neither shuffled nor sorted:
    a first pass counts them and finds the smallest error, a second keeps the pairs with that error.
    """
    size, peptides = F.abs("ppm"), checkpoint(peptides.distinct())
    totals = candidates(spectra, peptides, ppm, isotopes).groupBy("spectrum_id").agg(
        F.count("*").alias("n_candidates"), F.min(size).alias("_least"))
    totals = checkpoint(totals).withColumnRenamed("spectrum_id", "_of")
    known = spectra.join(totals.hint("merge"), F.col("spectrum_id").eqNullSafe(F.col("_of"))).drop("_of")
    closest = candidates(known, peptides, ppm, isotopes).where(size == F.col("_least"))
    return closest.groupBy("spectrum_id").agg(
        F.first("n_candidates").alias("n_candidates"),
        F.min_by("sequence", F.struct(size, "sequence")).alias("sequence"),
        F.min_by("ppm", F.struct(size, "sequence")).alias("ppm"),
    )


def pair_truth(truth: DataFrame, pred: DataFrame, key: str = "spectrum_id") -> DataFrame:
    """Truth with its prediction; a spectrum without a prediction keeps a NULL."""
    return truth.join(pred, key, "left")


_RESIDUES = np.zeros(128)
_RESIDUES[[ord(a) for a in rules.RESIDUE_MASS]] = list(rules.RESIDUE_MASS.values())
# no residue begins right after a line break
_RESIDUE_START, _DELTA = re.compile("(?<=[^\n\r\u0085\u2028\u2029])(?=[A-Z])"), re.compile("[+-][0-9.]+")


def residue_masses(sequence: str) -> np.ndarray:
    """Mass of each residue with its tag: a new residue begins at each capital, and the first signed
    number after it is added. Letters without a mass weigh nothing."""
    if sequence.isascii() and sequence.isalpha() and sequence.isupper():
        return _RESIDUES[np.frombuffer(sequence.encode(), np.uint8)]

    def mass(token: str) -> float:
        delta = _DELTA.search(token)
        try:
            tag = float(delta[0]) if delta else 0.0
        except ValueError:
            tag = 0.0
        return rules.RESIDUE_MASS.get(token[:1], 0.0) + tag

    return np.array([mass(token) for token in _RESIDUE_START.split(sequence)])


#: Pairs of sequences aligned together, and pairs of their residues compared at once.
ALIGNED, COMPARED = 256, 1 << 20


def _padded(masses: Sequence[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray]:
    """Masses as rows of one width, and how many each row has."""
    size = np.array([0 if m is None else len(m) for m in masses])
    out = np.zeros((len(size), max(1, size.max(initial=0))))
    out[np.arange(out.shape[1]) < size[:, None]] = np.concatenate([np.zeros(0), *[m for m in masses if m is not None]])
    return out, size


def _sums(own: np.ndarray, backward: bool) -> np.ndarray:
    """Running sums up to each residue, from the start or from the end, each added up in the order of the residues."""
    if not backward:
        return own.cumsum(axis=1)
    out = np.zeros_like(own)
    for j in range(own.shape[1]):
        out[:, : j + 1] += own[:, j, None]
    return out


def _meetings(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, backward: bool, cum_tol: float, ind_tol: float) -> tuple[np.ndarray, ...]:
    """(row, i, j, same) of the residues whose running sums are close, those of a row by i, then j."""
    sum_a, sum_b, found = _sums(a, backward), _sums(b, backward), []
    there = (np.arange(b.shape[1]) < n_b[:, None])[:, None, :]
    step = max(1, COMPARED // b.size)
    for at in range(0, a.shape[1], step):
        close = np.abs(sum_a[:, at : at + step, None] - sum_b[:, None, :]) < cum_tol
        row, i, j = np.nonzero(close & there & (np.arange(at, min(at + step, a.shape[1])) < n_a[:, None])[:, :, None])
        found.append((row, i + at, j))
    row, i, j = (np.concatenate(f) for f in zip(*found, strict=True))
    return row, i, j, np.abs(a[row, i] - b[row, j]) < ind_tol


def _aligned(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, mode: str, cum_tol: float, ind_tol: float) -> np.ndarray:
    """Flags by row and place, see :func:`aa_mask`."""
    shape = (len(a), max(a.shape[1], b.shape[1]))
    longer = np.maximum(n_a, n_b)

    def flags(row: np.ndarray, place: np.ndarray, same: np.ndarray) -> np.ndarray:
        out = np.full(shape, -1, np.int8)  # -1: no meeting
        at, first = np.unique(row * shape[1] + place, return_index=True)  # of several meetings the first
        out.ravel()[at] = same[first]
        return out

    if mode != "forward":
        row, i, j, same = _meetings(a, n_a, b, n_b, True, cum_tol, ind_tol)
    if mode == "backward":
        return flags(row, longer[row] - 1 - np.maximum(n_a[row] - 1 - i, n_b[row] - 1 - j), same) == 1
    ahead, i_ahead, j_ahead, same_ahead = _meetings(a, n_a, b, n_b, False, cum_tol, ind_tol)
    forward = flags(ahead, np.maximum(i_ahead, j_ahead), same_ahead) == 1
    if mode == "forward":
        return forward
    off = ~forward & (np.arange(shape[1]) < longer[:, None])
    stop = np.where(off.any(axis=1), off.argmax(axis=1), shape[1])
    beyond = (i >= stop[row]) & (j >= stop[row])
    mended = flags(row[beyond], np.maximum(i, j)[beyond], same[beyond])
    return np.where(mended >= 0, mended == 1, forward)


def aa_mask(truth: Column, pred: Column, mode: str = "best", cum_tol: float = 0.5, ind_tol: float = 0.1) -> Column:
    """Flags of two sequences' residues, one per place of the longer one.

    Two residues meet where the running sums up to them differ by less than ``cum_tol``; the place
    is the larger of theirs, and it is a match if their own masses differ by less than ``ind_tol``.
    Sums run from the start (``forward``) or, with places counted from the end, from the end
    (``backward``). ``best`` runs forward and, beyond the first place without a match, lets
    meetings from the end decide. As long as every residue weighs more than twice ``cum_tol``, a
    residue meets one other at most; of residues of no or negative mass, the first meeting counts.
    """
    if mode not in ("best", "forward", "backward"):
        raise ValueError("mode must be best, forward or backward")

    @F.pandas_udf("array<boolean>")
    def align(truths: pd.Series, preds: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(truths), ALIGNED):
            left, right = ([None if x is None else residue_masses(x) for x in c.iloc[at : at + ALIGNED].tolist()] for c in (truths, preds))
            (a, n_a), (b, n_b) = _padded(left), _padded(right)
            with np.errstate(invalid="ignore"):
                found = _aligned(a, n_a, b, n_b, mode, cum_tol, ind_tol)
            out += [None if x is None and y is None else f[:n] for x, y, f, n in zip(left, right, found, np.maximum(n_a, n_b), strict=True)]
        return pd.Series(out, index=truths.index, dtype=object)

    return align(truth, pred)


def aa_matches(pairs: DataFrame, mode: str = "best") -> DataFrame:
    """Adds ``aa_match``, ``n_true``, ``n_pred`` and ``pep_match`` to rows of (truth, pred).

    Equal sequences match in full and absent ones not at all; the rest are aligned where they
    lie, without a shuffle.
    """
    tokens = lambda c: F.coalesce(
        F.length(F.regexp_replace(F.col(c), r"(?<=.)(?:[^A-Z])", "")), F.lit(0)
    )
    same = F.col("truth") == F.col("pred")
    both = F.col("truth").isNotNull() & F.col("pred").isNotNull()
    differ = lambda c: F.when(both & ~same, F.col(c))
    n = F.greatest(tokens("truth"), tokens("pred"))
    aligned = pairs.withColumn("aa_match", aa_mask(differ("truth"), differ("pred"), mode))
    trivial = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda _: F.coalesce(same, F.lit(False)))
    return aligned.withColumn("aa_match", F.coalesce("aa_match", F.when(n > 0, trivial), F.array())).select(
        *pairs.columns, "aa_match",
        tokens("truth").alias("n_true"), tokens("pred").alias("n_pred"),
        (both & F.forall("aa_match", lambda x: x)).alias("pep_match"),
    )


def aa_match_metrics(pairs: DataFrame, by: Sequence[str] = (), mode: str = "best") -> DataFrame:
    """Residue precision and recall, and peptide precision, over pairs of (truth, pred)."""
    rows = aa_matches(pairs, mode)
    hits = F.sum(F.size(F.filter("aa_match", lambda x: x)))
    return rows.groupBy(*by).agg(
        (hits / (F.sum("n_pred") + 1e-8)).alias("aa_precision"),
        (hits / (F.sum("n_true") + 1e-8)).alias("aa_recall"),
        (F.count_if("pep_match") / (F.count("*") + 1e-8)).alias("pep_precision"),
    )


def aa_pr_at(df: DataFrame, threshold: float, n_total: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall of residues scored above ``threshold``; rows are (score, correct)."""
    above = F.col("score") > threshold
    right = F.count_if(above & F.col("correct"))
    total = F.lit(n_total) if n_total else F.count("*")
    return df.groupBy(*by).agg(
        F.try_divide(right, F.count_if(above)).alias("precision"), F.try_divide(right, total).alias("recall")
    )

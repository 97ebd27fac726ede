"""Spectrum level expressions: filter strings and peak clean-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, not once per use inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_filter_string(col: Column) -> Column:
    """Struct of accuracy, MS level, dissociation flags, fragmentation type, tag, error code."""
    detector = F.regexp_extract(col, r"^(\S+)", 1)
    accuracy = F.when(detector.isin("FTMS", "ASTMS"), "HR").when(detector == "ITMS", "LR")
    level = F.when(col.contains(" ms "), F.lit(1)).otherwise(
        F.regexp_extract(col, r" ms(\d) ", 1).try_cast("int")
    )
    hcd, cid, etd = (col.contains(f"@{kind}") for kind in ("hcd", "cid", "etd"))
    kinds = hcd.cast("int") + cid.cast("int") + etd.cast("int")
    error = (
        F.when(accuracy.isNull(), "UnrecognizedDetector")
        .when(level.isNull(), "UnrecognizedMSLevel")
        .when(col.contains("@") & (kinds == 0), "UnrecognizedFragmentation")
        .when(level == 0, "UnknownMSLevel")
        .when((level == 2) & ~kinds.isin(1, 2), "CantParseFilterStr")
        .when((level == 2) & (kinds == 2) & ~etd, "UnrecognizedFragmentation")
    )
    kind = (
        F.when(etd & hcd, "EThcD")
        .when(etd & cid, "ETciD")
        .when(hcd, "HCD")
        .when(cid, "IT_CID")
        .when(etd, "IT_ETD")
    )
    ok = error.isNull() & (level == 2)
    return F.struct(
        accuracy.alias("accuracy"),
        level.alias("ms_level"),
        hcd.alias("hcd"),
        cid.alias("cid"),
        etd.alias("etd"),
        F.when(ok, F.concat_ws("_", accuracy, kind))
        .when(error.isNull() & (level == 1), "MS1")
        .alias("frag_type"),
        F.when(ok, F.concat_ws(" ", accuracy, F.replace(kind, F.lit("_"), F.lit(" "))))
        .when(error.isNull(), "??")
        .alias("frag_tag"),
        error.alias("error_code"),
    )


def clean_peaks(
    mz: Column,
    intensity: Column,
    precursor_mz: Column,
    charge: Column,
    min_mz: float = 50.0,
    max_mz: float = 2500.0,
    precursor_tol: float = 2.0,
    min_intensity: float = 0.01,
    max_peaks: int = 150,
    min_peaks: int = 20,
    max_charge: int = 10,
) -> Column:
    """Cleaned peaks as an array of (mz, intensity), or NULL for a spectrum to drop.

    Order: m/z range; peaks near the precursor m/z; square root; below ``min_intensity`` of the
    base peak; the most intense ``max_peaks``; unit norm. Ties in intensity go to the lower m/z.
    """
    pairs = F.zip_with(mz, intensity, lambda m, i: F.struct(m.alias("mz"), i.cast("double").alias("i")))
    kept = F.filter(
        pairs,
        lambda p: p["mz"].between(min_mz, max_mz)
        & (F.coalesce(F.abs(p["mz"] - precursor_mz), F.lit(1e9)) > precursor_tol)
        & (p["i"] > 0),
    )
    rooted = F.array_sort(
        F.transform(kept, lambda p: F.struct((-F.sqrt(p["i"])).alias("neg"), p["mz"].alias("mz")))
    )

    def strongest(peaks: Column) -> Column:
        base = F.try_element_at(peaks, F.lit(1))["neg"]
        return let(base, lambda b: F.filter(F.slice(peaks, 1, max_peaks), lambda p: -p["neg"] >= -b * min_intensity))

    def scaled(peaks: Column) -> Column:
        norm = F.sqrt(F.aggregate(peaks, F.lit(0.0), lambda acc, p: acc + p["neg"] * p["neg"]))
        by_mz = let(
            norm,
            lambda n: F.array_sort(
                F.transform(peaks, lambda p: F.struct(p["mz"].alias("mz"), (-p["neg"] / n).alias("intensity")))
            ),
        )
        return F.when((F.size(peaks) >= min_peaks) & charge.between(1, max_charge), by_mz)

    return let(rooted, lambda r: let(strongest(r), scaled))


def bin_peaks(mz: Column, intensity: Column, low: Column, high: Column, width: Column) -> Column:
    """Bins of one spectrum in the open range (low, high): (bin, largest intensity), one per bin."""
    pairs = F.zip_with(mz, intensity, lambda m, i: F.struct(m.alias("mz"), i.cast("double").alias("i")))
    inside = F.filter(pairs, lambda p: (p["mz"] > low) & (p["mz"] < high))
    binned = F.array_sort(
        F.transform(
            inside,
            lambda p: F.struct(F.floor((p["mz"] - low) / width).alias("bin"), p["i"].alias("intensity")),
        )
    )

    def last_of_bin(b: Column) -> Column:
        return F.filter(
            b,
            lambda p, i: (i == F.size(b) - 1)
            | (F.try_element_at(b, (i + 2).cast("int"))["bin"] != p["bin"]),
        )

    return let(binned, last_of_bin)

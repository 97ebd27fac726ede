"""Peptide-spectrum match tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom import schemas
from massloom.functions import mass as mz
from massloom.functions import modseq, text as tx
from massloom.operators.ranking import numbered, sparse, top_n
from massloom.session import written

SPECTRUM_KEY = ["filename", "scannr"]


def best_psm(df: DataFrame, score: str = "hyperscore", keys: Sequence[str] = SPECTRUM_KEY) -> DataFrame:
    """One row per spectrum: the highest score, NULL last; ties by the remaining columns.

    A spectrum has few rows, so sorting them before the shuffle would spill and drop next to nothing: rows go
    straight to their spectrum's task, and are cut beforehand only if a spectrum may have very many.
    """
    rest = [c for c in df.columns if c not in (*keys, score)]
    order = [F.col(score).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]
    return top_n(df.repartition(*keys) if sparse(df, keys) else df, keys, order, 1)


def search_summary(psm: DataFrame, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Matches, unique peptides and protein mentions; ``proteins_distinct`` is a true count.

    A mention counts each member of a list, an empty list counts one. Without ``approximate``
    the distinct counts are exact.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    members = F.size(F.split(F.coalesce("proteins", F.lit("")), ";"))
    totals = psm.groupBy(*by).agg(
        F.count("*").alias("num_psms"),
        count("peptide").alias("num_unique_peptides"),
        F.sum(members).cast("bigint").alias("protein_mentions"),
    )
    return totals


def distinct_proteins(psm: DataFrame, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Distinct members over all protein lists."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    lists = psm.select(*by, "proteins").where("proteins <> ''").distinct()
    members = lists.select(*by, F.explode(F.split("proteins", ";")).alias("protein"))
    return members.groupBy(*by).agg(count("protein").alias("proteins_distinct"))


def run_sketches(psm: DataFrame, by: Sequence[str] = ("filename",), precision: int = 12) -> DataFrame:
    """Matches of each run, and sketches of its peptides and proteins that can be stored and united.

    A sketch takes at most about 2**``precision`` bytes whatever the run holds; its standard error is near
    0.8 / 2**(precision / 2).
    """
    members = F.explode(F.split("proteins", ";")).alias("protein")
    lists = psm.where("proteins <> ''").select(*by, "proteins").distinct().select(*by, members)
    proteins = lists.groupBy(*by).agg(F.hll_sketch_agg("protein", precision).alias("protein_sketch"))
    peptides = psm.groupBy(*by).agg(F.count("*").alias("num_psms"), F.hll_sketch_agg("peptide", precision).alias("peptide_sketch"))
    return peptides.join(proteins, list(by), "left")


def united_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Matches and estimated distinct peptides and proteins of all runs of a group, from
    :func:`run_sketches` alone: no match is read again."""
    def united(column: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(column, F.lit(True))), F.lit(0))

    return sketches.groupBy(*by).agg(
        F.sum("num_psms").alias("num_psms"), united("peptide_sketch").alias("unique_peptides"), united("protein_sketch").alias("distinct_proteins"))


def per_file_stats(psm: DataFrame) -> DataFrame:
    return psm.groupBy("filename").agg(
        F.count("*").alias("num_psms"), F.count_distinct("peptide").alias("num_unique_peptides")
    )


def quality_stats(psm: DataFrame, by: Sequence[str] = ("filename",), q: float = 0.01) -> DataFrame:
    """Mean q-value, matches and confident matches per run."""
    return psm.groupBy(*by).agg(
        F.avg("spectrum_q").alias("mean_q"),
        F.count("*").alias("total_psms"),
        F.count_if(F.col("spectrum_q") < q).alias("confident_psms"),
    )


def quality_gate(
    psm: DataFrame, by: Sequence[str] = ("filename",), q: float = 0.01, n: int = 10
) -> DataFrame:
    """Gate decision per run: enough matches with ``spectrum_q`` below ``q``."""
    return quality_stats(psm, by, q).withColumn("passed", F.col("confident_psms") >= n)


def passing(psm: DataFrame, by: Sequence[str] = ("filename",), q: float = 0.01, n: int = 10) -> DataFrame:
    """Matches of the runs that pass the gate."""
    return psm.join(quality_gate(psm, by, q, n).where("passed").select(*by), list(by), "left_semi")


def with_psm_id(psm: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return numbered(psm, by, order, "psm_id")


def rt_seconds(df: DataFrame, column: str = "rt", unit: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``rt_sec``. Without ``unit`` a table (or group) counts as seconds if its median is
    above 300, else as minutes.

    Whether the median exceeds 300 follows from how many values lie on each side and, for an
    even split, from the two values next to it, so no value list is gathered.
    """
    x = F.col(column).cast("double")
    if unit:
        return df.withColumn("rt_sec", x * 60 if unit == "min" else x)
    low, high = F.count_if(x <= 300), F.count_if(x > 300)
    seconds = (
        F.when(low < high, True)
        .when(low > high, False)
        .otherwise((F.max(F.when(x <= 300, x)) + F.min(F.when(x > 300, x))) / 2 > 300)
    )
    verdict = df.groupBy(*by).agg(F.coalesce(seconds, F.lit(False)).alias("_sec"))
    if by:
        joined = df.join(verdict, list(by), "left")
        return joined.withColumn("rt_sec", F.when(F.col("_sec"), x).otherwise(x * 60)).drop("_sec")
    flag = verdict.scalar()
    return df.withColumn("rt_sec", F.when(flag, x).otherwise(x * 60))


def delta_mass(psm: DataFrame, mode: str = "closed", static: Sequence[float] = (57.02146,)) -> DataFrame:
    """Adds ``base_mass`` and ``delta_mass``; ``open`` takes the calculated mass as it is."""
    moving = F.lit(0.0) if mode == "open" else mz.variable_mass(F.col("peptide"), static)
    out = psm.withColumn("base_mass", F.col("calcmass") - moving)
    return out.withColumn("delta_mass", F.col("expmass") - F.col("base_mass"))


def spectrum_title(psm: DataFrame) -> DataFrame:
    """Adds ``spectrum``: file stem, scan, scan, charge."""
    scan = tx.scan_number(F.col("scannr")).cast("string")
    title = F.concat_ws(".", tx.stem(F.col("filename")), scan, scan, F.col("charge").cast("string"))
    return psm.withColumn("spectrum", title)


def to_ptm_input(psm: DataFrame, mode: str = "closed", static: Sequence[float] = (57.02146,)) -> DataFrame:
    """The table that modification profiling takes, one row per match."""
    wide = spectrum_title(delta_mass(rt_seconds(psm), mode, static))
    return wide.select(
        "spectrum",
        tx.basename(F.col("filename")).alias("spectrum_file"),
        tx.strip_mods(F.col("peptide")).alias("peptide"),
        F.col("peptide").alias("modified_peptide"),
        "charge",
        F.col("rt_sec").alias("retention"),
        F.col("expmass").alias("observed_mass"),
        mz.mz(F.col("expmass"), F.col("charge")).alias("observed_mz"),
        F.col("base_mass").alias("calculated_mass"),
        mz.mz(F.col("base_mass"), F.col("charge")).alias("calculated_mz"),
        "delta_mass",
        "hyperscore",
        tx.first_protein(F.col("proteins")).alias("protein"),
    )


def bracket_masses(sequences: DataFrame, unimod: DataFrame, column: str) -> DataFrame:
    """(``column``, ``rewritten``) of the distinct sequences that name ids of the reference.

    Each sequence gets the masses of its own ids by a join, so neither side is gathered.
    """
    known = unimod.groupBy(F.col("unimod_id").cast("int").alias("_id")).agg(F.min("mono_mass").alias("_mass"))
    tagged = sequences.select(column).where(F.col(column).contains("(UniMod:")).distinct()
    ids = tagged.select(column, F.explode(modseq.unimod_ids(F.col(column))).alias("_id"))
    masses = ids.join(known, "_id").groupBy(column).agg(
        F.map_from_entries(F.collect_list(F.struct("_id", "_mass"))).alias("_masses"))
    return masses.select(column, modseq.unimod_to_mass(F.col(column), F.col("_masses")).alias("rewritten"))


def unimod_to_mass(df: DataFrame, unimod: DataFrame, column: str = "peptide") -> DataFrame:
    """Rewrite ``(UniMod:n)`` in ``column`` as a bracket mass; unknown ids stay."""
    joined = df.join(bracket_masses(df, unimod, column), column, "left")
    return joined.withColumn(column, F.coalesce("rewritten", column)).select(*df.columns)


# fixed values: legacy DIA column -> name
LEGACY_DIA = {
    "File.Name": "File",
    "Precursor.Charge": "Charge",
    "Precursor.MZ": "PrecursorMZ",
}


def dia_tsv_to_psm(df: DataFrame) -> DataFrame:
    """Legacy DIA table: renames, a bare peptide if there is none, and the engine tag."""
    out = df.withColumnsRenamed({k: v for k, v in LEGACY_DIA.items() if k in df.columns})
    if "Peptide" not in out.columns and "Modified.Peptide" in out.columns:
        bare = tx.blank_to_null(F.regexp_extract("`Modified.Peptide`", r"([A-Z]+)", 1))
        out = out.withColumn("Peptide", bare)
    return out.withColumn("search_engine", F.lit("DiaNN"))


def dia_to_psm(df: DataFrame, unimod: DataFrame, order: Sequence[str] | None = None, compat: bool = False) -> DataFrame:
    """DIA report as the canonical match table plus seven columns that trace it back.

    ``psm_id`` is numbered per run when ``order`` names a total order, else it is NULL. Numbering reads
    its rows several times, so the report and the rewritten rows are each made and written once for it.
    ``compat`` measures the peptide length with its tags.
    """
    def take(names: Sequence[str] | str, dtype: str) -> Column:
        return schemas.col_or_null(df, names, dtype)

    def text(name: str) -> Column:
        return F.coalesce(take(name, "string"), F.lit(""))

    peptide = F.coalesce("_rewritten", text("Modified.Sequence"))
    length = F.length(peptide if compat else tx.strip_mods(text("Modified.Sequence"), "letters"))
    made = {
        "peptide": peptide,
        "proteins": text("Protein.Ids"),
        "num_proteins": tx.n_proteins(text("Protein.Ids")),
        "filename": text("Run"),
        "charge": take("Precursor.Charge", "int"),
        "peptide_len": length,
        "rt": take("RT", "double"),
        "predicted_rt": take("Predicted.RT", "double"),
        "ion_mobility": take("IM", "double"),
        "predicted_mobility": take("Predicted.IM", "double"),
        "spectrum_q": take("Q.Value", "double"),
        "peptide_q": take(["Peptidoform.Q.Value", "Q.Value"], "double"),
        "protein_q": take(["Protein.Q.Value", "PG.Q.Value"], "double"),
        "ms2_intensity": take("Precursor.Quantity", "double"),
        "search_engine": F.lit("DiaNN"),
        "diann_precursor_id": text("Precursor.Id"),
        "diann_modified_sequence": text("Modified.Sequence"),
        "diann_precursor_mz": take("Precursor.Mz", "double"),
        "diann_global_q_value": take("Global.Q.Value", "double"),
        "diann_pep": take("PEP", "double"),
        "diann_channel": text("Channel"),
    }
    fields = [*schemas.PSM, *schemas.DIA_EXTRA]
    if order is not None:
        df = written(df, "dia-report")
    sequences = df.select(text("Modified.Sequence").alias("_modified"))
    rewritten = bracket_masses(sequences, unimod, "_modified").withColumnRenamed("rewritten", "_rewritten")
    out = df.join(rewritten, text("Modified.Sequence") == F.col("_modified"), "left").select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    if order is None:
        return out
    ids = numbered(written(out.drop("psm_id"), "dia-psm"), ["filename"], list(order), "psm_id")
    return ids.select(*[f.name for f in fields])


def resolve_spectrum_file(psm: DataFrame, files: DataFrame, column: str = "filename") -> DataFrame:
    """Adds ``actual_file``: the exact name, the name with ``.mzML``, the first file that starts
    with the name, else the name itself. Names are matched once each, then joined back.

    The prefix match runs only over names without an exact hit: each file name is cut at the
    lengths that occur among those names, which makes it an equi join.
    """
    names = psm.select(F.col(column).alias("name")).distinct()
    have = files.select(F.col("file").alias("actual")).distinct()
    exact = names.join(have, F.col("name") == F.col("actual"), "left")
    open_names = exact.where("actual is null and not endswith(name, '.mzML')").select("name")
    lengths = open_names.agg(F.array_sort(F.collect_set(F.length("name"))).alias("ns")).scalar()
    cuts = have.withColumn("ns", lengths).select("actual", F.explode("ns").alias("n"))
    prefixes = cuts.where(F.length("actual") >= F.col("n")).select(
        F.expr("substr(actual, 1, n)").alias("name"), "actual"
    )
    by_prefix = (
        open_names.join(prefixes, "name")
        .groupBy("name")
        .agg(
            F.coalesce(
                F.min(F.when(F.col("actual") == F.concat("name", F.lit(".mzML")), F.col("actual"))),
                F.min("actual"),
            ).alias("found")
        )
    )
    resolved = exact.join(by_prefix, "name", "left").select(
        F.col("name").alias(column), F.coalesce("actual", "found", "name").alias("actual_file")
    )
    return psm.join(resolved, column, "left")


def file_status(psm: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected files with their match counts; a file without matches failed."""
    counts = psm.groupBy("filename").agg(F.count("*").alias("psm_count"))
    return expected.join(counts, "filename", "left").select(
        "filename",
        F.coalesce("psm_count", F.lit(0)).alias("psm_count"),
        F.when(F.col("psm_count") > 0, "success").otherwise("failed").alias("status"),
    )

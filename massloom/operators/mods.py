"""Modification reference matching, site fractions and search settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.functions import modseq, text as tx
from massloom.operators.ranges import interval_join
from massloom.operators.ranking import top_n
from massloom.session import checkpoint

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def mod_sites(unimod: DataFrame, hidden: bool = False) -> DataFrame:
    """Allowed residues and termini per modification; positions tied to a protein are left out."""
    rows = unimod if hidden else unimod.where("not hidden")
    anywhere = (F.col("position") == "Anywhere") & F.trim("site").rlike("^[A-Z]$")
    term = F.when(F.col("position") == "Any N-term", "N-term").when(
        F.col("position") == "Any C-term", "C-term"
    )
    return rows.groupBy("unimod_id").agg(
        F.array_sort(F.collect_set(F.when(anywhere, F.trim("site")))).alias("residues"),
        F.array_sort(F.collect_set(term)).alias("terms"),
    )


def _reference(unimod: DataFrame) -> DataFrame:
    return unimod.groupBy("unimod_id").agg(
        F.min("mod_name").alias("mod_name"), F.min("mono_mass").alias("mono_mass")
    )


def _shuffled(reference: DataFrame) -> DataFrame:
    """The reference may be large, and grouped rows are taken for smaller than they are: no join broadcasts it."""
    return reference.hint("merge")


def match_mods(masses: DataFrame, unimod: DataFrame, tol: float = 0.01) -> DataFrame:
    """Best reference record per (mass, residue, term).

    Records within ``tol``; those whose visible sites allow the residue or terminus first, then
    the smaller difference, then reference order. Masses without a match are not returned.
    """
    sites = _reference(unimod).join(_shuffled(mod_sites(unimod)), "unimod_id", "left")
    shifts = masses.select("mass", "residue", "term").distinct()
    edge = tol * 1.001
    near = interval_join(
        shifts, F.col("mass"), _shuffled(sites), F.col("mono_mass") - edge, F.col("mono_mass") + edge, 2 * tol
    ).withColumn("diff", F.abs(F.col("mono_mass") - F.col("mass")))
    allowed = F.coalesce(F.array_contains("residues", F.col("residue")), F.lit(False)) | F.coalesce(
        F.array_contains("terms", F.col("term")), F.lit(False)
    )
    order = F.struct(F.when(allowed, 0).otherwise(1), "diff", "unimod_id")
    # a tolerance written in decimal must accept its own edge
    return (
        near.where(F.col("diff") <= tol + 1e-9)
        .groupBy("mass", "residue", "term")
        .agg(F.min_by(F.struct("unimod_id", "mod_name", "mono_mass"), order).alias("m"))
        .select("mass", "residue", "term", "m.*")
    )


def mod_event_rows(psm: DataFrame, by: Sequence[str] = (), compat: bool = False) -> DataFrame:
    """Distinct events per stripped peptide: (by, stripped, pos, residue, term, mass, unimod_id)."""
    return _events(_forms(psm, by), by, compat)


def _forms(psm: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct modified peptides with their stripped form."""
    forms = psm.select(*by, F.trim("peptide").alias("peptide")).distinct()
    return forms.withColumn("stripped", tx.strip_mods(F.col("peptide"), "letters")).where("stripped <> ''")


def _events(forms: DataFrame, by: Sequence[str], compat: bool) -> DataFrame:
    tagged = forms.select(*by, "stripped", F.explode(modseq.mod_events(F.col("peptide"), compat)).alias("e"))
    return tagged.select(*by, "stripped", "e.*").distinct()


def _event_key(row: Sequence[str] = ("mass", "residue", "term", "unimod_id")) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in row])


def mod_definitions(events: DataFrame, unimod: DataFrame, tol: float = 0.01, hidden: bool = True) -> DataFrame:
    """Identity of each distinct event: key, reference id, name, mass and allowed sites.

    A mass outside the reference keeps itself as key, with the sites it was seen on.
    """
    kinds = events.select("mass", "residue", "term", "unimod_id").distinct().withColumn("event", _event_key())
    by_mass = match_mods(kinds.where("unimod_id is null"), unimod, tol)
    sites = mod_sites(unimod, hidden)
    named = kinds.where("unimod_id is not null").join(_shuffled(_reference(unimod)), "unimod_id", "left")
    matched = (
        kinds.where("unimod_id is null").drop("unimod_id").alias("k")
        .join(
            by_mass.alias("m"),
            (F.col("k.mass") == F.col("m.mass"))
            & F.col("k.residue").eqNullSafe(F.col("m.residue"))
            & F.col("k.term").eqNullSafe(F.col("m.term")),
            "left",
        )
        .select("k.event", "k.mass", "k.residue", "k.term", "m.unimod_id", "m.mod_name")
    )
    every = matched.unionByName(
        named.select("event", F.col("mono_mass").alias("mass"), "residue", "term", "unimod_id", "mod_name")
    )
    key = F.coalesce(
        F.concat(F.lit("unimod:"), F.col("unimod_id")),
        F.concat(F.lit("mass:"), F.format_string("%+.5f", "mass")),
    )
    every = every.withColumn("mod_key", key)
    per_key = every.groupBy("mod_key").agg(
        F.min("unimod_id").alias("unimod_id"),
        F.min("mod_name").alias("mod_name"),
        F.min("mass").alias("mass_shift"),
        F.array_sort(F.collect_set("residue")).alias("seen_residues"),
        F.array_sort(F.collect_set("term")).alias("seen_terms"),
    )
    none = F.array().cast("array<string>")
    per_key = per_key.join(_shuffled(sites), "unimod_id", "left").select(
        "mod_key", "unimod_id", "mod_name", "mass_shift",
        F.when(F.col("unimod_id").isNull(), F.col("seen_residues")).otherwise(
            F.coalesce("residues", none)).alias("residues"),
        F.when(F.col("unimod_id").isNull(), F.col("seen_terms")).otherwise(
            F.coalesce("terms", none)).alias("terms"),
    )
    return every.select("event", "mod_key").join(per_key, "mod_key")


def residue_counts(peptides: DataFrame, by: Sequence[str], column: str = "stripped") -> DataFrame:
    """Peptides and letters per group over unique peptides, as one row with a count map.

    Letters are counted by length differences, so nothing is exploded.
    """
    unique = peptides.select(*by, column).distinct()
    size = F.length(column)
    sums = [F.sum(size - F.length(F.replace(F.col(column), F.lit(a)))).alias(a) for a in LETTERS]
    wide = unique.groupBy(*by).agg(F.count("*").alias("unique_peptides"), *sums)
    pairs = [x for a in LETTERS for x in (F.lit(a), F.col(a))]
    return wide.select(*by, "unique_peptides", F.create_map(*pairs).alias("letters"))


def site_fractions(
    psm: DataFrame, unimod: DataFrame, by: Sequence[str] = (), tol: float = 0.01, hidden: bool = True,
    compat: bool = False,
) -> DataFrame:
    """Modified over potential sites per modification (and per group of ``by``).

    Numerator: distinct (stripped peptide, modification, position). Denominator: the allowed
    residues in all unique stripped peptides, plus one per peptide for each allowed terminus.
    """
    by = list(by)
    # the distinct forms and the few definitions feed two branches each: both are kept; a peptide is
    # parsed once, however many groups have it, and its marks are joined back
    forms = checkpoint(_forms(psm, by))
    parsed = forms.select("peptide", "stripped").distinct()
    events = parsed.select("peptide", "stripped", F.explode(modseq.mod_events(F.col("peptide"), compat)).alias("e"))
    events = checkpoint(events.select("peptide", "stripped", "e.*").withColumn("event", _event_key()))
    defs = checkpoint(mod_definitions(events, unimod, tol, hidden))
    totals = residue_counts(forms, by)
    marks = events.select("peptide", "stripped", "pos", "event").join(defs.select("event", "mod_key"), "event")
    marks = marks.groupBy("peptide", "stripped", "mod_key").agg(F.collect_set("pos").alias("at"))  # at most a peptide's length
    sites = (
        forms.select(*by, "peptide").join(marks, "peptide")
        .groupBy(*by, "mod_key", "stripped").agg(F.size(F.array_distinct(F.flatten(F.collect_set("at")))).alias("n"))
        .groupBy(*by, "mod_key")
        .agg(F.sum("n").cast("bigint").alias("modified_sites"), F.count("*").alias("peptides_with_mod"))
    )
    facts = defs.drop("event").dropDuplicates(["mod_key"])
    joined = sites.join(facts, "mod_key")
    if by:
        joined = joined.join(totals, by)
    else:
        one = totals.select(F.struct("unique_peptides", "letters").alias("t")).scalar()
        joined = joined.withColumn("t", one).select("*", "t.*").drop("t")
    potential = F.aggregate(
        "residues", F.lit(0).cast("bigint"),
        lambda acc, a: acc + F.coalesce(F.try_element_at(F.col("letters"), a), F.lit(0)),
    ) + F.size("terms") * F.col("unique_peptides")
    return (
        joined.withColumn("potential_sites", potential)
        .where("potential_sites > 0")
        .select(
            *by, "mod_key", "unimod_id", "mod_name",
            F.when(F.col("mass_shift").isNotNull(), F.format_string("%+.6f", "mass_shift")).alias("mass_shift"),
            F.array_join("residues", "").alias("allowed_residues"),
            F.array_join("terms", ";").alias("allowed_terms"),
            "unique_peptides", "peptides_with_mod", "modified_sites", "potential_sites",
            F.round(F.col("modified_sites") / F.col("potential_sites"), 6).alias("fraction_modified"),
        )
    )


def site_fraction_report(fractions: DataFrame, by: Sequence[str] = ("filename",)) -> DataFrame:
    """Per run: how many modifications were analysed, and the one with the largest fraction."""
    order = F.struct("fraction_modified", "modified_sites", "mod_key")
    return fractions.groupBy(*by).agg(
        F.count("*").alias("num_mods_analyzed"),
        F.sum("modified_sites").alias("modified_sites"),
        F.max_by("mod_key", order).alias("top_mod"),
    )


def filter_ptm(ptm: DataFrame, min_percent: float = 0.005) -> DataFrame:
    """Named modifications at or above ``min_percent`` percent points."""
    name = F.trim("modification")
    drop = (
        name.startswith("Unannotated mass-shift")
        | name.contains("Isotopic peak")
        | name.contains("isotopic peak")
        | name.isin("None", "nan")
    )
    return ptm.where(name.isNotNull() & ~drop & (F.col("percent_psms") >= min_percent))


def top_ptms(ptm: DataFrame, n: int = 3, by: Sequence[str] = (), order: str = "ord") -> DataFrame:
    """The ``n`` modifications with most matches, per group if ``by`` is given."""
    keys = [F.col("psms").desc(), F.col(order)]
    return top_n(ptm, by, keys, n) if by else ptm.orderBy(*keys).limit(n)


def ptm_classes(ptm: DataFrame, n: int = 3) -> DataFrame:
    """Matches per modification name, the largest ``n`` names."""
    totals = ptm.groupBy("modification").agg(F.sum("psms").cast("bigint").alias("psms"))
    return totals.orderBy(F.col("psms").desc(), "modification").limit(n)


def usable_mods(ptm: DataFrame, unimod: DataFrame, tol: float = 0.01, max_mass: float = 1000.0) -> DataFrame:
    """Summary rows with a sane mass, a reference match and at least one usable site."""
    sane = ptm.where(F.abs("mass_shift") <= max_mass)
    shifts = sane.select(
        F.col("mass_shift").alias("mass"), F.lit(None).cast("string").alias("residue"),
        F.lit(None).cast("string").alias("term"),
    )
    found = match_mods(shifts, unimod, tol).select(F.col("mass").alias("mass_shift"), "unimod_id", "mod_name")
    sites = mod_sites(unimod, hidden=True).where("size(residues) + size(terms) > 0")
    return sane.join(found, "mass_shift").join(_shuffled(sites), "unimod_id")


def mods_to_maps(
    ptm: DataFrame, unimod: DataFrame, tol: float = 0.01, fixed_percent: float = 95.0, order: str = "ord"
) -> DataFrame:
    """Search settings as rows (site, kind, mass, rank).

    At or above ``fixed_percent`` a modification is static: one mass per site, the first in
    order wins. Otherwise it is variable: distinct masses per site in order. Termini are
    written ``^``/``$`` when static and ``[``/``]`` when variable.
    """
    usable = usable_mods(ptm, unimod, tol).withColumn("fixed", F.col("percent_psms") >= fixed_percent)

    def written(n_term: str, c_term: str) -> Column:
        return F.transform("terms", lambda t: F.when(t == "N-term", n_term).otherwise(c_term))

    rows = usable.select(
        F.explode(F.concat("residues", F.when(F.col("fixed"), written("^", "$")).otherwise(written("[", "]")))).alias("site"),
        "fixed", F.col("mass_shift").alias("mass"), F.col(order).alias("ord"),
    )
    static = rows.where("fixed").groupBy("site").agg(
        F.min_by("mass", "ord").alias("mass"), F.min("ord").alias("ord")
    ).withColumn("kind", F.lit("static"))
    variable = rows.where("not fixed").groupBy("site", "mass").agg(F.min("ord").alias("ord")).withColumn(
        "kind", F.lit("variable")
    )
    return static.unionByName(variable).select("site", "kind", "mass", "ord")


def limit_mods(mods: DataFrame, ptm: DataFrame, classes: DataFrame) -> DataFrame:
    """Settings whose mass, to five places, belongs to one of the selected classes."""
    wanted = ptm.join(classes.select("modification"), "modification", "left_semi").select(
        F.round(F.col("mass_shift").cast("double"), 5).alias("_m")
    )
    return mods.withColumn("_m", F.round("mass", 5)).join(wanted, "_m", "left_semi").drop("_m")


def supplement_mods(fractions: DataFrame, protocol: DataFrame, by: Sequence[str], min_fraction: float = 0.05) -> DataFrame:
    """Detected modifications at or above ``min_fraction`` that the protocol does not name."""
    keys = [*by, "unimod_id"]
    seen = fractions.where((F.col("fraction_modified") >= min_fraction) & F.col("unimod_id").isNotNull())
    return seen.join(protocol.select(*keys).distinct(), keys, "left_anti")

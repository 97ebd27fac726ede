"""Project metadata, publications, annotations and the sample table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.functions import modseq, protocol, rules, text as tx
from massloom.operators.ranking import numbered, top_n
from massloom.schemas import known
from massloom.session import checkpoint


def has_keyword(df: DataFrame, words: Sequence[str] = rules.PROTEOLYSIS_WORDS, name: str = "has_keyword") -> DataFrame:
    """Flag: any of ``words`` in the lower-cased text of the whole record."""
    body = F.lower(F.to_json(F.struct(*df.columns)))
    hit = F.lit(False)
    for word in words:
        hit = hit | body.contains(word.lower())
    return df.withColumn(name, hit)


def publication_ids(projects: DataFrame) -> DataFrame:
    """Top DOI, else the first reference DOI; PubMed ids that are neither zero nor blank."""
    refs = F.coalesce("references", F.array())
    ids = F.filter(
        F.transform(refs, lambda r: F.trim(r["pubmedID"].cast("string"))),
        lambda x: x.isNotNull() & ~x.isin("", "0"),
    )
    dois = F.filter(F.transform(refs, lambda r: r["doi"]), lambda x: x.isNotNull())
    return projects.withColumn("pubmed_ids", ids).withColumn(
        "publication_doi", F.coalesce(tx.blank_to_null(F.col("doi")), F.try_element_at(dois, F.lit(1)))
    )


def file_links(projects: DataFrame) -> DataFrame:
    """Files of a project with the first location named FTP, else the first ``ftp://`` one."""
    rows = projects.select("accession", F.posexplode("files").alias("ord", "f"))
    places = F.coalesce("f.publicFileLocations", F.array())
    by_name = F.filter(places, lambda p: p["name"] == "FTP Protocol")
    by_prefix = F.filter(places, lambda p: p["value"].startswith("ftp://"))
    return rows.select(
        "accession", "ord", F.col("f.fileName").alias("file"), F.col("f.fileSizeBytes").alias("bytes"),
        F.coalesce(
            F.try_element_at(by_name, F.lit(1))["value"], F.try_element_at(by_prefix, F.lit(1))["value"]
        ).alias("ftp_url"),
    )


def select_raw_files(files: DataFrame, n: int | None = None, key: str = "accession") -> DataFrame:
    """Raw files, one per name, the first ``n`` per project by name."""
    raw = files.where(F.lower("file").endswith(".raw")).dropDuplicates([key, "file"])
    return raw if n is None else top_n(raw, [key], [F.col("file")], n)


def survey(projects: DataFrame) -> DataFrame:
    """Survey row per project: first PubMed id, raw files, organisms, experiment types, keyword."""
    def names(column: str) -> Column:
        return F.array_join(F.transform(F.coalesce(column, F.array()), lambda x: F.coalesce(x["name"], F.lit(""))), "; ")

    raw = F.filter(F.coalesce("files", F.array()), lambda f: F.lower(f["fileName"]).endswith(".raw"))
    return has_keyword(projects, name="limited_proteolysis").select(
        "accession",
        F.coalesce(F.try_element_at("references", F.lit(1))["pubmedID"].cast("string"), F.lit("")).alias("pubmed_id"),
        F.size(raw).alias("raw_file_count"),
        names("organisms").alias("organism"),
        names("experimentTypes").alias("experiment_types"),
        "limited_proteolysis",
    )


def in_scope(projects: DataFrame) -> DataFrame:
    return projects.where("raw_file_count > 0 and trim(pmc_id) <> ''")


def next_batch(projects: DataFrame, n: int = 500, order: Sequence[str] = ("raw_file_count", "accession")) -> DataFrame:
    """The first ``n`` projects that have not been reanalysed."""
    return projects.where("not reannotated").orderBy(*order).limit(n)


def protocol_facts(projects: DataFrame, sample: str = "sample_protocol", data: str = "data_protocol") -> DataFrame:
    """Facts read from the protocol texts of each project."""
    s, d = F.coalesce(F.col(sample), F.lit("")), F.coalesce(F.col(data), F.lit(""))
    swapped = F.concat(d, F.lit(" "), s)
    named = ["cleavage_agent", "reduction_reagent", "alkylation_reagent"]
    out = projects.withColumns({
        "_named": protocol.named_facts(s, d),
        "precursor_tolerance": protocol.mass_tolerance(swapped, "precursor"),
        "fragment_tolerance": protocol.mass_tolerance(swapped, "fragment"),
        "scan_range": protocol.scan_range(s),
        "collision_energy": protocol.collision_energy(s),
    })
    numbers = ["precursor_tolerance", "fragment_tolerance", "scan_range", "collision_energy"]
    return out.select(
        *projects.columns, *[F.col(f"_named.{c}").alias(c) for c in named], *numbers, F.col("_named.protocol_mods").alias("protocol_mods"))


def annotation_confidence(rows: DataFrame, by: Sequence[str] = ("pxd", "kind")) -> DataFrame:
    """Completeness and overall confidence from field rows and two given scores.

    Overall = 0.5 evidence + 0.2 completeness + 0.3 format.
    """
    share = F.count("value") / F.count("*")
    scores = rows.groupBy(*by).agg(
        F.max("evidence_score").alias("evidence_score"), F.max("format_score").alias("format_score"),
        share.alias("completeness"),
    )
    overall = 0.5 * F.col("evidence_score") + 0.2 * F.col("completeness") + 0.3 * F.col("format_score")
    return scores.withColumn("overall", overall)


def annotation_coverage(rows: DataFrame) -> DataFrame:
    """Known and total values per kind and field, with every subtotal."""
    return rows.cube("kind", "field").agg(
        F.count("value").alias("known"), F.count("*").alias("total"),
        (F.count("value") / F.count("*")).alias("coverage"),
    )


BIOLOGY = {
    "organism": ["species", "organism"],
    "organism_part": ["tissue", "organ"],
    "disease": ["disease_state", "disease"],
    "cell_type": ["cell_type", "cell type"],
    "cell_line": ["cell_line", "cell line"],
    "sex": ["sex"],
    "age": ["age"],
    "instrument": ["instrument"],
    "fragmentation": ["fragmentation", "fragmentation method"],
}


def annotation_wide(rows: DataFrame) -> DataFrame:
    """Field rows as one row per project, the fields the sample table reads."""
    picks = []
    for name, fields in BIOLOGY.items():
        found = [F.max(F.when(F.col("field") == f, known(F.col("value")))) for f in fields]
        picks.append(F.coalesce(*found).alias(f"ann_{name}"))
    return rows.groupBy("pxd").agg(*picks)


def sdrf_mods(files: DataFrame, protocol_rows: DataFrame, fractions: DataFrame, min_fraction: float = 0.05) -> DataFrame:
    """Modification strings per file: those the protocol names, then those found in the data.

    A file has one row per modification of the reference at most, so its list stays short.
    """
    facts = protocol_rows.select("pxd", "protocol_mods", "alkylation_reagent")
    named = files.join(facts, "pxd").select(
        "pxd", "stem", F.posexplode("protocol_mods").alias("ord", "m")
    ).select(
        "pxd", "stem", F.lit(0).alias("grp"), F.col("ord").cast("double").alias("ord"),
        F.col("m.unimod_id").alias("unimod_id"),
        modseq.sdrf_mod(F.col("m.name"), F.col("m.unimod_id"), F.col("m.kind"), F.col("m.residues")).alias("mod"),
    )
    names = F.create_map(*[F.lit(x) for k, (n, _) in rules.CANONICAL_MODS.items() for x in (k, n)])
    sites = F.create_map(*[F.lit(x) for k, (_, r) in rules.CANONICAL_MODS.items() for x in (k, r)])
    uid = F.col("unimod_id")
    alkylated = (uid == 4) & F.col("alkylation_reagent").isNotNull()
    site = F.when(alkylated, "C").otherwise(
        F.coalesce(F.try_element_at(sites, uid), tx.blank_to_null(F.substring("allowed_residues", 1, 1)), F.lit("X"))
    )
    name = F.coalesce(F.try_element_at(names, uid), F.col("mod_name"), F.concat(F.lit("UNIMOD:"), uid))
    seen = fractions.where((F.col("fraction_modified") >= min_fraction) & uid.isNotNull())
    found = (
        seen.join(files.select("pxd", "stem"), ["pxd", "stem"], "left_semi")
        .join(named.select("pxd", "unimod_id").distinct(), ["pxd", "unimod_id"], "left_anti")
        .join(facts.select("pxd", "alkylation_reagent"), "pxd", "left")
        .select(
            "pxd", "stem", F.lit(1).alias("grp"), (-F.col("fraction_modified")).alias("ord"), "unimod_id",
            modseq.sdrf_mod(name, uid, F.when(alkylated, "Fixed").otherwise("Variable"), site).alias("mod"),
        )
    )
    rows = named.unionByName(found)
    ordered = F.array_sort(F.collect_list(F.struct("grp", "ord", "unimod_id", "mod")))
    return rows.groupBy("pxd", "stem").agg(F.transform(ordered, lambda m: m["mod"]).alias("mods"))


def sdrf(
    files: DataFrame, annotations: DataFrame, runs: DataFrame, projects: DataFrame, fractions: DataFrame,
    llm: DataFrame, tool: str = "massloom",
) -> DataFrame:
    """Sample table: one row per raw file. Columns with brackets are those of the standard.

    ``files``: pxd, raw_file. ``annotations``: from :func:`annotation_wide`. ``runs``: per (pxd,
    stem) instrument, acquisition, label and fragmentation tag. ``projects``: pxd, protocols,
    organism, organism_part, disease, and the study's own fall-back values. ``llm``: (pxd,
    raw_file, treatment, enrichment). An optional column appears if some row has a value; one
    small aggregate decides that and how many modification columns there are.
    """
    # four joins read the facts, none the protocols they come from
    facts = checkpoint(protocol_facts(projects).drop("sample_protocol", "data_protocol"))
    rows = files.withColumn("stem", tx.stem(F.col("raw_file")))
    mods = sdrf_mods(rows, facts, fractions)
    wide = (
        numbered(rows, ["pxd"], ["raw_file"], "sample_no")
        .join(facts, "pxd", "left")
        .join(annotations, "pxd", "left")
        .join(runs, ["pxd", "stem"], "left")
        .join(mods, ["pxd", "stem"], "left")
        .join(llm, ["pxd", "raw_file"], "left")
    )
    wide = checkpoint(wide)  # read twice: for the columns that are there, and for the rows
    instrument = tx.first_known(F.col("instrument"), F.col("ann_instrument"), F.col("study_instrument"))
    organism = F.trim(F.regexp_replace("organism", r"\s*\([^)]+\)", ""))
    sex = F.lower("ann_sex")

    def short(column: str, limit: int) -> Column:
        text = F.trim(column)
        return F.when(F.length(text).between(1, limit), text)

    disease = F.lower(tx.first_known(F.col("ann_disease"), F.col("disease")))
    fixed = {
        "source name": F.concat("pxd", F.lit("-Sample-"), "sample_no"),
        "characteristics[organism]": F.lower(tx.first_known(F.col("ann_organism"), organism)),
        "characteristics[organism part]": F.lower(tx.first_known(F.col("ann_organism_part"), F.col("organism_part"))),
        "characteristics[disease]": disease,
        "?characteristics[cell type]": F.col("ann_cell_type"),
        "?characteristics[cell line]": F.col("ann_cell_line"),
        "characteristics[biological replicate]": F.lit("1"),
        "characteristics[sex]": F.when(sex.isin("male", "female", "intersex"), sex).otherwise("not available"),
        "characteristics[age]": tx.first_known(F.col("ann_age")),
        "characteristics[individual]": F.col("stem"),
        "?characteristics[treatment]": short("treatment", 200),
        "?characteristics[enrichment process]": short("enrichment", 100),
        "assay name": F.concat(F.lit("run "), "sample_no"),
        "technology type": F.lit("proteomic profiling by mass spectrometry"),
        "comment[proteomics data acquisition method]": tx.cv_map(
            F.coalesce("acquisition_type", "study_acquisition", F.lit("")), "acquisition"),
        "comment[label]": tx.cv_map(F.coalesce("labeling", "study_labeling", F.lit("")), "label"),
        "comment[instrument]": instrument,
        "comment[cleavage agent details]": F.coalesce("cleavage_agent", F.lit("not available")),
        "comment[fraction identifier]": F.lit("1"),
        "comment[technical replicate]": F.lit("1"),
        "comment[dissociation method]": tx.cv_map(
            F.coalesce(tx.blank_to_null(F.col("fragmentation_tag")), "ann_fragmentation", "study_fragmentation",
                       F.lit("")), "dissociation"),
        "*mods": F.lit(None),
        "?comment[precursor mass tolerance]": F.col("precursor_tolerance"),
        "?comment[fragment mass tolerance]": F.col("fragment_tolerance"),
        "?comment[reduction reagent]": F.col("reduction_reagent"),
        "?comment[alkylation reagent]": F.col("alkylation_reagent"),
        "?comment[ms2 mass analyzer]": tx.cv_map(instrument, "analyzer"),
        "?comment[ms1 scan range]": F.col("scan_range"),
        "?comment[collision energy]": F.col("collision_energy"),
        "comment[data file]": F.col("raw_file"),
        "comment[sdrf version]": F.lit("v1.1.0"),
        "comment[sdrf annotation tool]": F.lit(tool),
        "factor value[disease]": disease,
    }
    optional = [n for n in fixed if n.startswith("?")]
    have = wide.agg(
        F.max(F.size(F.coalesce("mods", F.array()))).alias("n_mods"),
        *[F.coalesce(F.bool_or(fixed[n].isNotNull()), F.lit(False)).alias(f"o{i}") for i, n in enumerate(optional)],
    ).first()
    shown = {n for i, n in enumerate(optional) if have[f"o{i}"]}
    out = []
    for name, value in fixed.items():
        if name == "*mods":
            out += [
                F.coalesce(F.try_element_at("mods", F.lit(j + 1)), F.lit("not applicable")).alias(
                    f"comment[modification parameters]#{j}")
                for j in range(have["n_mods"] or 0)
            ]
        elif not name.startswith("?"):
            out.append(value.alias(name))
        elif name in shown:
            out.append(F.coalesce(value, F.lit("not available")).alias(name[1:]))
            if name.endswith("[cell line]"):
                out.append(F.lit("not available").alias("characteristics[cellosaurus accession]"))
    return wide.select("pxd", "sample_no", *out)


# fixed values: keys of a hint file that are not sample columns
HINT_SKIP = ["dataset_identifier", "experiment_identifier", "sdrf_template"]


def hint_rows(runs: DataFrame, hints: DataFrame) -> DataFrame:
    """Sample cells filled by hint, as (pxd, path, sample_no, ord, key, value), origin in brackets.

    ``runs``: pxd, path and the run facts. ``hints``: pxd, ord, key, value. One cell per run and
    hint line of the same project; the wide table is a pivot on ``ord`` of one project.
    """
    lines = hints.where(F.col("key").isNotNull() & ~F.col("key").isin(HINT_SKIP))
    cells = numbered(runs, ["pxd"], ["path"], "sample_no").join(lines, "pxd")
    blank = F.col("value") == ""
    written = F.when(blank, F.lit("")).otherwise(F.concat("value", F.lit("[HUMAN]")))

    def fill(name: str, *pairs: tuple[Column, str]) -> tuple[Column, Column]:
        out = F.when(~blank, written)
        for condition, value in pairs:
            out = out.when(condition, value)
        return F.col("key") == name, out.otherwise("")

    accurate, frag, acq = F.col("high_accuracy_precursors"), F.col("fragmentation_type"), F.col("acquisition_type")
    cases = [
        (F.col("key") == "source name", F.concat(F.lit("sample "), "sample_no", F.lit("[AG-TBA]"))),
        (F.col("key") == "comment[data file]", F.concat("path", F.lit("[DATA]"))),
        (F.col("key") == "comment[instrument]",
         F.concat(F.lit("NT="), "instrument", F.lit(";AC="), "instrument_accession", F.lit("[DATA]"))),
        (F.col("key") == "comment[tool metadata]", F.lit("RunAssessor v0.1[TOOL]")),
        fill(
            "comment[proteomics data acquisition method]",
            (acq == "DDA", "NT=data-dependent acquisition;AC=MS:1003221[DATA-I]"),
            (acq == "DIA", "NT=data-independent acquisition;AC=MS:1003215[DATA-I]"),
        ),
        fill(
            "comment[precursor mass tolerance]",
            (accurate == "true", "20 ppm[DATA-DI]"), (accurate == "false", "3.1 Da[DATA-DI]"),
        ),
        fill(
            "comment[fragment mass tolerance]",
            (frag.startswith("HR"), "20 ppm[DATA-DI]"), (frag.startswith("LR"), "0.6 Da[DATA-DI]"),
        ),
    ]
    value = F.when(*cases[0])
    for condition, result in cases[1:]:
        value = value.when(condition, result)
    return cells.select("pxd", "path", "sample_no", "ord", "key", value.otherwise(written).alias("value"))


SECTIONS = {
    "run_assessor": "run_assessor_found",
    "organisms": "organism_results_found",
    "search": "search_results_found",
    "site_fractions": "site_fractions_found",
    "llm": "llm_metadata_found",
    "project": "project_metadata_found",
}


def project_document(projects: DataFrame, **sections: DataFrame) -> DataFrame:
    """One row per project: a struct per section (NULL if absent) and flags that say which exist.

    Each section is a table with one row per project; lists of a section stay their own tables.
    """
    out = projects.select("pxd").distinct()
    for name, flag in SECTIONS.items():
        part = sections.get(name)
        if part is None:
            out = out.withColumn(name, F.lit(None).cast("string"))
        else:
            fields = [c for c in part.columns if c != "pxd"]
            out = out.join(part.select("pxd", F.struct(*fields).alias(name)), "pxd", "left")
        out = out.withColumn(flag, F.col(name).isNotNull())
    return out

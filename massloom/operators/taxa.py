"""Peptide to taxon tables: lineage mapping, weights, sampling, overlap, clusters, goodness."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom import schemas
from massloom.functions import rules
from massloom.operators.ranking import numbered, top_n
from massloom.session import checkpoint, free_shuffles, scratch_dir


def write_peptide_taxa(edges: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """The table (sequence, taxon_id) written once in ``buckets`` sorted files by hash of the sequence.

    Lookups then join file by file: the table, which may be far larger than any project, is never
    shuffled again. ``path`` is a folder that all executors reach, by default a new one in the
    shared folder. The returned table keeps its buckets without a catalog.
    """
    spark = edges.sparkSession
    entry = f"{name}_{uuid.uuid4().hex}"
    writer = edges.select("sequence", "taxon_id").repartition(buckets, "sequence").write.bucketBy(buckets, "sequence").sortBy("sequence")
    writer.option("path", path or scratch_dir(spark, name)).format("parquet").saveAsTable(entry)
    return spark.table(entry)


def lookup_taxa(peptides: DataFrame, peptide_taxa: DataFrame) -> DataFrame:
    """Edges (sequence, taxon_id) of the distinct peptides asked for.

    With a table of :func:`write_peptide_taxa` only the peptides asked for are shuffled.
    """
    return peptide_taxa.join(peptides.select("sequence").distinct(), "sequence", "left_semi")


def ranks_present(lineage: DataFrame) -> list[str]:
    return [r for r in schemas.RANKS if f"{r}_id" in lineage.columns]


def restrict_taxa(
    edges: DataFrame, lineage: DataFrame, query_ids: DataFrame | Sequence[int], rank: str = "species"
) -> DataFrame:
    """Edges to taxa below a query taxon that are defined at ``rank`` or deeper.

    The query taxa are a table with ``taxon_id``, or a list of ids; a taxon's ids at all ranks are
    matched with it by one semi join.
    """
    if not isinstance(query_ids, DataFrame):
        query_ids = edges.sparkSession.createDataFrame([(int(q),) for q in query_ids], "taxon_id long")
    ranks = ranks_present(lineage)
    deep = [r for r in ranks if schemas.RANKS.index(r) >= schemas.RANKS.index(rank)]
    ids = F.array_compact(F.array(*[F.col(f"{r}_id").cast("long") for r in ranks]))
    at_rank = F.coalesce(*[F.col(f"{r}_id") for r in deep], F.lit(None)).isNotNull()
    above = lineage.where(at_rank).select("taxon_id", F.explode(F.array_distinct(ids)).alias("_above"))
    wanted = query_ids.select(F.col("taxon_id").cast("long").alias("_above"))
    return intersect_taxa(edges, above.join(wanted, "_above", "left_semi").select("taxon_id"))


def intersect_taxa(edges: DataFrame, allowed: DataFrame) -> DataFrame:
    """Edges whose taxon is in the allowed set."""
    return edges.join(allowed.select("taxon_id").distinct(), "taxon_id", "left_semi")


def keep_taxa(edges: DataFrame, taxa: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    keys = [*by, "taxon_id"]
    return edges.join(taxa.select(*keys).distinct(), keys, "left_semi").select(*edges.columns)


def to_rank(edges: DataFrame, lineage: DataFrame, rank: str = "species", drop_null: bool = False) -> DataFrame:
    """Edges with each taxon replaced by its ancestor at ``rank``, distinct per peptide.

    A taxon without lineage drops out unless none of the peptide's taxa has one, in which case
    they stay as they are. A taxon without that rank becomes NULL and still counts.
    """
    mapped = edges.join(
        lineage.select("taxon_id", F.col(f"{rank}_id").alias("_at"), F.lit(True).alias("_known")), "taxon_id", "left"
    )
    any_known = mapped.groupBy("sequence").agg(F.count("_known").alias("_n"))
    out = (
        mapped.join(any_known, "sequence")
        .where("_known or _n = 0")
        .select("sequence", F.when(F.col("_n") > 0, F.col("_at")).otherwise(F.col("taxon_id")).alias("taxon_id"))
        .distinct()
    )
    return out.where("taxon_id is not null") if drop_null else out


def attach_scores(edges: DataFrame, scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score and match count of each edge's peptide; peptides without one keep NULLs."""
    return edges.join(scores.select(*by, F.col("peptide").alias("sequence"), "score", "psms"), [*by, "sequence"], "left")


def weighted_sample(
    df: DataFrame, n: int, weight: str = "weight", key: str = "sequence", seed: int = 1234, by: Sequence[str] = (),
) -> DataFrame:
    """At most ``n`` rows drawn without replacement with chances in proportion to ``weight``.

    Each row gets an exponential key from a hash of its identity, and the smallest keys win;
    the draw does not depend on how the rows are partitioned. The hash is 52 bits of the MD5 of
    ``<seed>/<key>``. Rows without a positive weight are never drawn; reading the result fails if
    no row of a group has one.
    """
    text = F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))
    bits = F.conv(F.left(F.md5(text), F.lit(13)), 16, 10).cast("double")
    uniform = (bits + 0.5) / float(1 << 52)
    positive = F.when(F.col(weight) > 0, F.col(weight))
    fails = F.raise_error(F.lit("all weights are zero")).cast("double")
    checked = df.groupBy(*by).agg(F.when(F.count("*") == 0, 1.0).otherwise(F.coalesce(F.max(positive), fails)).alias("_most"))
    drawn = df.withColumn("_w", positive).withColumn("_key", -F.ln(uniform) / F.col("_w"))
    drawn = drawn.join(checked, list(by)) if by else drawn.withColumn("_most", checked.scalar())
    drawn = drawn.where("_w is not null and _most > 0").drop("_w", "_most")
    order = [F.col("_key"), F.col(key)]
    if by:
        drawn = top_n(drawn, by, order, n)
    else:
        drawn = drawn.orderBy(*order).limit(n)
    return drawn.drop("_key")


def sample_peptides(edges: DataFrame, n: int, seed: int = 1234, by: Sequence[str] = ()) -> DataFrame:
    """Edges of a sample of ``n`` peptides, in each group; a peptide weighs one over its number of taxa."""
    keys = [*by, "sequence"]
    degree = edges.groupBy(*keys).agg((F.lit(1.0) / F.count("*")).alias("weight"))
    picked = weighted_sample(degree, n, seed=seed, by=by).select(*keys)
    return edges.join(picked, keys, "left_semi")


def taxon_weights(edges: DataFrame, scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weight per taxon and whether some peptide is its alone.

    A peptide gives each of its n taxa log10(psms / n^3 + 1).
    """
    by = list(by)
    rows = edges.join(scores.withColumnRenamed("peptide", "sequence"), [*by, "sequence"])
    degree = edges.groupBy(*by, "sequence").agg(F.count("*").alias("n_taxa"))
    weight = F.log10(F.col("psms") / F.pow("n_taxa", F.lit(3)) + 1)
    return (
        rows.join(degree, [*by, "sequence"])
        .where("taxon_id is not null")
        .groupBy(*by, "taxon_id")
        .agg(F.sum(weight).alias("weight"), F.bool_or(F.col("n_taxa") == 1).alias("unique_taxon"))
        .where(F.col("taxon_id") != rules.EXCLUDED_TAXON)
    )


def selected_taxa(weights: DataFrame, n: int | None = None, by: Sequence[str] = (), few: int = 0) -> DataFrame:
    """The ``n`` heaviest taxa and every unique one; all taxa if ``n`` is None. With ``few``, groups of
    fewer taxa than that keep all of theirs."""
    by = list(by)
    if n is None:
        return weights.distinct()
    weights = checkpoint(weights)  # read up to three times
    order = [F.col("weight").desc(), F.col("taxon_id")]
    if by:
        top = top_n(weights, by, order, n)
        sizes = weights.groupBy(*by).agg((F.count("*") < few).alias("_all"))
        rest = weights.join(sizes, by).where("_all or unique_taxon").drop("_all")
    else:
        top = weights.orderBy(*order).limit(n)
        small = weights.agg((F.count("*") < few).alias("s")).scalar()
        rest = weights.where(F.col("unique_taxon") | small)
    return top.unionByName(rest).distinct()


def graph_taxa(edges: DataFrame, by: Sequence[str] = (), exclude: Sequence[int] = (rules.EXCLUDED_TAXON,)) -> DataFrame:
    """Edges without excluded taxa and without taxa that have a single edge."""
    kept = edges.where(~F.col("taxon_id").isin(list(exclude)))
    many = kept.groupBy(*by, "taxon_id").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return kept.join(many, [*by, "taxon_id"], "left_semi").select(*edges.columns)


def with_taxon_names(scores: DataFrame, lineage: DataFrame) -> DataFrame:
    """Adds ``taxon_name``; a taxon without a name is an error when the row is read."""
    named = scores.join(lineage.select("taxon_id", "taxon_name"), "taxon_id", "left")
    missing = F.raise_error(F.concat(F.lit("no name for taxon "), F.col("taxon_id"))).cast("string")
    return named.withColumn("taxon_name", F.coalesce("taxon_name", missing))


def taxon_table(posterior: DataFrame, lineage: DataFrame) -> DataFrame:
    """Named taxa with a numeric score from a raw result table (id, score, type)."""
    rows = posterior.where("type = 'taxon'").select(
        F.col("id").try_cast("bigint").alias("taxon_id"), F.col("score").try_cast("double").alias("score")
    )
    return with_taxon_names(rows.where("taxon_id is not null and score is not null"), lineage)


def taxon_classes(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Taxa with equal peptide sets share a class, named after its smallest taxon.

    Sets are compared by their size and two independent order-free fingerprints.
    """
    by = list(by)
    prints = edges.groupBy(*by, "taxon_id").agg(
        F.count("*").alias("n_peptides"),
        F.bit_xor(F.xxhash64("sequence")).alias("_a"),
        F.sum(F.xxhash64("sequence", F.lit(7)).cast("decimal(38,0)")).alias("_b"),
    )
    heads = prints.groupBy(*by, "n_peptides", "_a", "_b").agg(
        F.min("taxon_id").alias("class_id"), F.count("*").alias("n_taxa")
    )
    return prints.join(heads, [*by, "n_peptides", "_a", "_b"]).select(
        *by, "taxon_id", "class_id", "n_peptides", "n_taxa"
    )


#: Classes of a block, blocks that one block meets in a tile, peptides of a class that a tile's row may hold.
BLOCK_CLASSES, TILE_BLOCKS, PART_PEPTIDES = 256, 8, 1 << 16
#: Peptides of small tiles that share a task's group, about.
BATCH_PEPTIDES = 1 << 18


def _tile(members: pd.DataFrame, heads: pd.DataFrame, threshold: float, whole: bool) -> pd.DataFrame:
    """Shared peptides of each member and head of two blocks, from bitmaps over the members' peptides.

    A head smaller than the member's share of peptides can't hold enough of them. If the rows are
    ``whole`` sets, only pairs that may pass the threshold are returned, else all that share any.
    """
    words, at = np.unique(np.concatenate(members["peptides"].tolist()), return_inverse=True)

    def bitmaps(rows: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        bits = np.zeros((n, -(-len(words) // 64) * 64), bool)
        bits[rows, places] = True
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    mine = bitmaps(np.repeat(np.arange(len(members)), members["peptides"].str.len()), at, len(members))
    held = np.concatenate(heads["peptides"].tolist())
    places = np.minimum(np.searchsorted(words, held), len(words) - 1)
    known = words[places] == held
    theirs = bitmaps(np.repeat(np.arange(len(heads)), heads["peptides"].str.len())[known], places[known], len(heads))
    n, size = members["n_peptides"].to_numpy(), heads["n_peptides"].to_numpy()
    ids, others, out = members["class_id"].to_numpy(), heads["class_id"].to_numpy(), []
    for i in range(len(members)):
        least = n[i] * threshold - 1e-6
        fits = np.flatnonzero((size > least) & (others != ids[i]))
        shared = np.bitwise_count(mine[i] & theirs[fits]).sum(axis=1, dtype=np.int64)
        keep = shared > (least if whole else 0)
        out.append((np.full(keep.sum(), ids[i]), others[fits[keep]], shared[keep], np.full(keep.sum(), n[i])))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pd.DataFrame(dict(zip(["member", "head", "shared", "n_peptides"], columns, strict=True)))


def class_overlap(edges: DataFrame, threshold: float = 0.9, classes: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Directed overlap between classes above ``threshold``: shared peptides / size of ``member``, in
    each group of ``by``.

    Exact without building every pair. A member of n peptides may lack fewer than d = n - floor(t n)
    of them, so of any p of its peptides a partner has at least p - d + 1. Each member looks for
    partners with about 2 d peptides, first in the order (taxa that hold it, hash): rare ones, and
    members of a family of near-copies choose the same. Classes with the same smallest peptides by two
    hashes, as most near-copies are and hardly any others, form blocks; two blocks meet in a tile, as bitmaps, if the one
    holds as many of the peptides that the other looks for as some member of it needs. So a family costs its
    output, not the square of every shared peptide, and a class without near-copies is a block of its own.
    """
    by, kinds = list(by), edges.schema
    if classes is None:
        edges = checkpoint(edges.select(*by, "taxon_id", "sequence"))  # read for the classes and for their peptides
        classes = taxon_classes(edges, by)
    heads = classes.where("taxon_id = class_id").select(*by, "taxon_id", "class_id", "n_peptides")
    core = checkpoint(edges.join(heads, [*by, "taxon_id"]).select(*by, "class_id", "sequence", "n_peptides"))
    spread = checkpoint(core.groupBy(*by, "sequence").agg(F.count("*").alias("df")).withColumn("pid", F.monotonically_increasing_id()))
    hashed = F.xxhash64("pid")
    core = core.join(spread, [*by, "sequence"]).select(
        *by, "class_id", "n_peptides", "pid", hashed.alias("hash"), (F.col("df") + (F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30))).alias("order"))
    core = checkpoint(core)
    del edges, heads, spread
    free_shuffles(core.sparkSession)
    keys = [*by, "class_id"]
    n = F.max("n_peptides")
    need = n - F.floor(n * threshold)
    share = F.least(F.lit(1.0), 2 * need / n + 1e-3)
    grid = F.percentile_approx("order", [i / 50 for i in range(1, 51)], 10_000)
    limits = core.groupBy(*keys).agg(
        need.alias("need"), F.try_element_at(grid, F.ceil(share * 50).cast("int")).alias("limit"),
        F.xxhash64(F.min("hash"), F.min(F.xxhash64("pid", F.lit(1)))).alias("least"), n.alias("n"))
    family = limits.groupBy(*by, "least").agg(F.ceil(F.count("*") / BLOCK_CLASSES).alias("splits"))
    limits = limits.join(family, [*by, "least"]).withColumn("block", F.xxhash64("least", F.pmod(F.xxhash64("class_id"), "splits")))
    limits = checkpoint(limits.select(*keys, "need", "limit", "n", "block"))
    core = core.join(limits.select(*keys, "limit", "need", "block"), keys)
    # the quantile is near, not exact: a member whose limit leaves it too few peptides asks with all
    p = F.count_if(F.col("order") <= F.col("limit"))
    asked = core.groupBy(*keys, "block").agg(p.alias("p"), F.max("need").alias("d"), F.max("n_peptides").alias("n"))
    asked = asked.withColumn("enough", F.col("p") >= F.col("d"))
    least = F.min(F.when(F.col("enough"), F.col("p")).otherwise(F.col("n")) - F.col("d") + 1)
    least = asked.groupBy(*by, F.col("block").alias("mb")).agg(least.alias("least"))
    probe = core.join(asked.select(*keys, "enough"), keys).where("order <= limit or not enough").select(*by, "pid", F.col("block").alias("mb")).distinct()
    met = probe.join(core.select(*by, "pid", F.col("block").alias("hb")).distinct(), [*by, "pid"]).groupBy(*by, "mb", "hb").agg(F.count("*").alias("met"))
    met = met.join(least, [*by, "mb"]).where("met >= least")
    partners = met.groupBy(*by, "mb").agg(F.ceil(F.count("*") / TILE_BLOCKS).alias("tiles"))
    met = checkpoint(met.join(partners, [*by, "mb"]).select(*by, "mb", "hb", F.pmod(F.xxhash64("hb"), "tiles").alias("tile")))
    free_shuffles(met.sparkSession)
    sizes = limits.groupBy(*by, F.col("block").alias("hb")).agg(F.sum("n").alias("size"))
    tiles = met.join(sizes, [*by, "hb"]).groupBy(*by, "mb", "tile").agg(F.sum("size").alias("theirs"))
    tiles = tiles.join(sizes.withColumnRenamed("hb", "mb"), [*by, "mb"]).select(*by, "mb", "tile", (F.col("theirs") + F.col("size")).alias("size"))
    tiles = checkpoint(tiles)
    batches = -(-(tiles.agg(F.sum("size")).first()[0] or 0) // BATCH_PEPTIDES) or 1
    largest = limits.agg(F.max("n")).first()[0] or 1
    parts = -(-largest // PART_PEPTIDES)
    sets = core.groupBy(*keys, "block", F.pmod("hash", F.lit(parts)).alias("part")).agg(
        F.max("n_peptides").alias("n_peptides"), F.sort_array(F.collect_list("pid")).alias("peptides"))
    sets = checkpoint(sets)
    del core, asked, probe
    free_shuffles(sets.sparkSession)
    kind = kinds["taxon_id"].dataType.simpleString()
    names = [F.col(c).cast("string").alias(f"_k{i}") for i, c in enumerate(by)]
    texts = [f"_k{i}" for i in range(len(by))]

    def side(tiles: DataFrame, block: str) -> DataFrame:  # new names, as both sides come from the same tables
        rest = [F.col(c).alias(c) for c in ("mb", "tile", "part", "class_id", "n_peptides", "peptides")]
        hashed = F.xxhash64(*by, "mb", "tile", "part")
        slot = F.when(F.col("size") * 64 <= BATCH_PEPTIDES, F.pmod(hashed, F.lit(batches))).otherwise(hashed).alias("_slot")
        return tiles.join(sets.withColumnRenamed("block", block), [*by, block]).select(slot, *names, *rest)

    tile_keys = [*texts, "mb", "tile", "part"]
    members, others = side(tiles, "mb"), side(met.join(tiles, [*by, "mb", "tile"]), "hb")

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"member": [], "head": [], "shared": [], "n_peptides": [], **{t: [] for t in texts}})]
        held = b.groupby(tile_keys, sort=False).indices if len(b) else {}
        for key, rows in (a.groupby(tile_keys, sort=False).indices if len(a) else {}).items():
            if key in held:
                found = _tile(a.iloc[rows], b.iloc[held[key]], threshold, parts == 1)
                out.append(found.assign(**dict(zip(texts, key, strict=False))))
        return pd.concat(out[1:] or out, ignore_index=True)

    text = "".join(f", {t} string" for t in texts)
    shared = members.groupBy("_slot").cogroup(others.groupBy("_slot")).applyInPandas(
        compare, f"member {kind}, head {kind}, shared long, n_peptides long{text}")
    back = [F.col(t).cast(kinds[c].dataType).alias(c) for t, c in zip(texts, by, strict=True)]
    shared = shared.select(*back, "member", "head", "shared", "n_peptides")
    if parts > 1:
        shared = shared.groupBy(*by, "member", "head").agg(F.sum("shared").alias("shared"), F.max("n_peptides").alias("n_peptides"))
    return shared.withColumn("overlap", F.col("shared") / F.col("n_peptides")).where(F.col("overlap") > threshold)


def cluster_taxa(edges: DataFrame, weights: DataFrame, threshold: float = 0.9, by: Sequence[str] = ()) -> DataFrame:
    """Clusters (head, member) of taxa: heaviest first, a head absorbs all that overlap with it, in each
    group of ``by``.

    The greedy choice, in rounds: a taxon becomes a head once every heavier one that could
    absorb it is known not to be a head, and is absorbed once one of them is. Taxa with equal
    peptide sets act as one, led by the heaviest. A member may belong to several heads.
    """
    by = list(by)
    rank = F.struct((-F.col("weight")).alias("w"), F.col("taxon_id").alias("t"))
    weights = checkpoint(weights.select(*by, "taxon_id", "weight"))  # read twice, as the edges are
    known = checkpoint(edges.join(weights, [*by, "taxon_id"], "left_semi").select(*by, "taxon_id", "sequence").distinct())
    classes = checkpoint(taxon_classes(known, by))
    free_shuffles(known.sparkSession)
    best = classes.join(weights.select(*by, "taxon_id", "weight"), [*by, "taxon_id"]).groupBy(*by, "class_id").agg(F.min(rank).alias("rank"))
    best = checkpoint(best)
    links = class_overlap(known, threshold, classes, by).select(*by, "member", "head")
    links = checkpoint(
        links.join(best.select(*by, F.col("class_id").alias("member"), F.col("rank").alias("mr")), [*by, "member"])
        .join(best.select(*by, F.col("class_id").alias("head"), F.col("rank").alias("hr")), [*by, "head"])
    )
    heavier = links.where("hr < mr").select(*by, "member", "head")
    state = checkpoint(best.select(*by, "class_id", F.lit(None).cast("boolean").alias("is_head")))
    while True:  # each round decides at least the heaviest open class of every chain
        above = heavier.join(state.withColumnRenamed("class_id", "head"), [*by, "head"]).groupBy(*by, F.col("member").alias("class_id")).agg(
            F.coalesce(F.bool_or("is_head"), F.lit(False)).alias("absorbed"),
            F.count_if(F.col("is_head").isNull()).alias("open"),
        )
        new = state.join(above, [*by, "class_id"], "left").select(
            *by, "class_id",
            F.when(F.col("is_head").isNotNull(), F.col("is_head"))
            .when(F.coalesce("absorbed", F.lit(False)), F.lit(False))
            .when(F.coalesce("open", F.lit(0)) == 0, F.lit(True))
            .alias("is_head"),
        )
        state = checkpoint(new)
        if state.where("is_head is null").isEmpty():
            break
    heads = state.where("is_head").join(best, [*by, "class_id"]).select(
        *by, F.col("class_id").alias("head"), F.col("rank.t").alias("head_taxon")
    )
    own = heads.select(*by, "head_taxon", F.col("head").alias("class_id"))
    others = links.join(heads, [*by, "head"]).select(*by, "head_taxon", F.col("member").alias("class_id"))
    return own.unionByName(others).join(classes.select(*by, "class_id", "taxon_id"), [*by, "class_id"]).select(
        *by, F.col("head_taxon").alias("head"), F.col("taxon_id").alias("member")
    )


def _harmonic(n: Column) -> Column:
    """1 + 1/2 + .. + 1/n: a table for small n, the asymptotic series beyond."""
    exact, total = [0.0], 0.0
    for i in range(1, 33):
        total += 1.0 / i
        exact.append(total)
    x = n.cast("double")
    series = F.ln(x) + 0.5772156649015329 + 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * F.pow(x, F.lit(4)))
    table = F.array(*[F.lit(v) for v in exact])
    return F.when(n <= 32, F.try_element_at(table, (F.least(n, F.lit(32)) + 1).cast("int"))).otherwise(series)


def goodness(scores: DataFrame, weights: DataFrame, by: Sequence[str] = ("param_id",), p: float = 1.0) -> DataFrame:
    """Rank overlap of weight order and score order, over the squared entropy of the scores.

    With ``p`` = 1 the overlap is the mean over depths 1..k of the common share of both tops;
    a taxon at rank m in the worse list adds the sum of 1/d for d = m..k. Smaller ``p`` weighs
    early depths more. Weights that have columns of ``by``, as a run, are ranked within them. A ranked list holds the taxa of one graph, which pruning has cut.
    """
    by = list(by)
    ranked = scores.select(*by, "taxon_id", "score", (-F.col("score")).alias("_low"))
    ranked = numbered(ranked, by, ["_low", "taxon_id"], "_s").drop("_low")
    own = [c for c in by if c in weights.columns]
    heavy = weights.select(*own, "taxon_id", (-F.col("weight")).alias("_low"))
    heavy = numbered(heavy, own, ["_low", "taxon_id"], "_w").drop("_low")
    joined = ranked.join(heavy, [*own, "taxon_id"], "left")
    if own:
        joined = joined.join(heavy.groupBy(*own).agg(F.count("*").alias("_nw")), own, "left").withColumn("_nw", F.coalesce("_nw", F.lit(0)))
    else:
        joined = joined.withColumn("_nw", heavy.agg(F.count("*").alias("n")).scalar())
    totals = joined.groupBy(*by).agg(
        F.sum("score").alias("_sum"), F.least(F.count("*"), F.max("_nw")).alias("_k")
    )
    rows = joined.join(totals, by)
    share = F.col("score") / F.col("_sum")
    entropy = -F.sum(F.when(share > 0, share * F.ln(share)).otherwise(0.0))
    worst = F.greatest("_s", "_w")
    both = F.col("_w").isNotNull() & (worst <= F.col("_k"))
    if p == 1.0:
        part = (_harmonic(F.col("_k")) - _harmonic(worst - 1)) / F.col("_k")
    else:
        part = F.aggregate(
            F.sequence(worst.cast("int"), F.greatest(F.col("_k"), worst).cast("int")),
            F.lit(0.0),
            lambda acc, d: acc + (1 - p) * F.pow(F.lit(p), d - 1) / d,
        )
    out = rows.groupBy(*by).agg(F.sum(F.when(both, part).otherwise(0.0)).alias("overlap"), entropy.alias("entropy"))
    return out.withColumn("goodness", F.try_divide(F.col("overlap"), F.col("entropy") * F.col("entropy")))


def best_params(goodness_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The parameter set with the largest goodness; ties go to larger alpha, beta, prior."""
    params = F.struct("alpha", "beta", "prior")
    best = goodness_rows.groupBy(*by).agg(
        F.max(F.struct(F.coalesce("goodness", F.lit(-math.inf)), params.alias("p"))).alias("b")
    )
    return best.select(*by, "b.p.alpha", "b.p.beta", "b.p.prior", F.col("b").getField("col1").alias("goodness"))


def with_grid(
    df: DataFrame, alphas: Sequence[float] = rules.GRID_ALPHA, betas: Sequence[float] = rules.GRID_BETA,
    priors: Sequence[float] = rules.GRID_PRIOR,
) -> DataFrame:
    """Every row once per parameter set; the grid is a literal array, so this is an explode."""
    grid = [
        F.struct(F.lit(i).alias("param_id"), F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(c).alias("prior"))
        for i, (a, b, c) in enumerate((a, b, c) for a in alphas for b in betas for c in priors)
    ]
    return df.withColumn("_p", F.explode(F.array(*grid))).select(*df.columns, "_p.*")

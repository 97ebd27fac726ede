"""From de novo peptides to a named taxon table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.functions import rules
from massloom.operators import denovo, graph, inference, taxa
from massloom.session import checkpoint


def taxon_edges(
    predictions: DataFrame, contaminants: DataFrame, peptide_taxa: DataFrame, lineage: DataFrame,
    query_ids: Sequence[int], rank: str = "species", pct: int = 80, sample: int | None = None, max_taxa: int | None = None,
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Scored edges (by, sequence, taxon_id, score, psms) and taxon weights of each group of ``by``, for
    example project and run. All peptides and taxa stay unless ``sample`` or ``max_taxa`` asks for
    fewer in each group. A peptide's taxa do not depend on the group, so they are looked up once."""
    by = list(by)
    kept = denovo.filter_denovo(predictions, pct).withColumnRenamed("stripped_sequence", "peptide")
    kept = denovo.remove_contaminants(kept, denovo.digest(contaminants))
    scores = checkpoint(denovo.peptide_scores(kept, by=by))
    found = taxa.lookup_taxa(scores.withColumnRenamed("peptide", "sequence"), peptide_taxa)
    inside = taxa.restrict_taxa(found, lineage, query_ids, rank)
    edges = taxa.to_rank(inside, lineage, rank)
    if by:
        edges = scores.select(*by, F.col("peptide").alias("sequence")).join(edges, "sequence")
    edges = checkpoint(edges if sample is None else taxa.sample_peptides(edges, sample, by=by))
    weights = checkpoint(taxa.taxon_weights(edges, scores, by))
    edges = taxa.keep_taxa(edges, taxa.selected_taxa(weights, max_taxa, by), by)
    return taxa.attach_scores(edges, scores, by), weights


def infer_taxa(
    edges: DataFrame, weights: DataFrame, lineage: DataFrame,
    alphas: Sequence[float] = rules.GRID_ALPHA, betas: Sequence[float] = rules.GRID_BETA,
    priors: Sequence[float] = rules.GRID_PRIOR, threshold: float = 0.9, by: Sequence[str] = (), **solver,
) -> DataFrame:
    """Posteriors for the whole grid in one job, the best set by goodness, and its named table, for each
    group of ``by``: a group's result is that of a job over its rows alone.

    The weight order is that of the cluster heads, so near-copies of a taxon count once. Sets of
    a group whose messages did not settle are not rated; it is an error if a group has none that did.
    """
    by = list(by)
    scores = checkpoint(inference.component_posteriors(edges, alphas, betas, priors, by=by, **solver))
    keys = [*by, "param_id"]
    settled = scores.groupBy(*keys).agg(F.bool_and("converged").alias("ok")).where("ok").select(*keys)
    lost = scores.select(*by).distinct().join(settled, by, "left_anti") if by else scores.where(settled.select(F.count("*") == 0).scalar())
    if not lost.isEmpty():
        raise RuntimeError("a group has no parameter set that settled; raise max_iter")
    scores = scores.join(settled, keys, "left_semi")
    clusters = taxa.cluster_taxa(edges.where("taxon_id is not null"), weights, threshold, by)
    heads = weights.join(clusters.select(*by, F.col("head").alias("taxon_id")).distinct(), [*by, "taxon_id"], "left_semi")
    params = graph.grid_params(edges.sparkSession, alphas, betas, priors)
    rated = taxa.goodness(scores, heads, keys).join(params, "param_id")
    best = taxa.best_params(rated, by).drop("goodness")
    chosen = best.join(params, ["alpha", "beta", "prior"]).select(*keys)
    return taxa.with_taxon_names(scores.join(chosen, keys, "left_semi"), lineage)

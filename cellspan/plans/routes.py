"""Whole analyses as compositions of operators.

Each function returns the tables a user would store; large intermediates are cut once where several
later steps read them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspan.operators import batch, cells, expression, features, graph, intervals, linalg, methylation, neighbors, regions, sites
from cellspan.plans.bounded import bounded_rows
from cellspan.plans.guards import checked
from cellspan.plans.sizes import broadcast_if_small
from cellspan.plans.storage import cut_lineage, stored


@dataclass(frozen=True)
class FeatureMatrix:
    """Counts per (cell, feature) with feature and cell metadata."""

    counts: DataFrame
    var: DataFrame
    obs: DataFrame


@dataclass(frozen=True)
class DifferentialMatrix:
    """Differential rows, merged leading regions, their per-cell values and z-scores."""

    dmr: DataFrame
    regions: DataFrame
    matrix: DataFrame


def feature_matrix(
    site_rows: DataFrame, candidates: DataFrame, chrom_order: DataFrame, blacklist: DataFrame, cell_table: DataFrame,
    annotation: DataFrame, *, n: int, context: str = "CGN", blacklist_fraction: float = 0.2, floor_percent: float = 5.0,
    exact: bool = True,
) -> FeatureMatrix:
    """Canonical, blacklist-free, numbered regions; integer counts; the ``n`` best regions; annotated cells.

    ``candidates`` is ``chrom, start, end, peak_var, n_cpg, n_obs_cells`` and must be disjoint
    (``intervals.overlapping_pairs_check``). An invalid site count stops the route, and so do fewer than ``n`` eligible regions
    unless ``exact`` is off.
    """
    kept = intervals.remove_blacklisted(intervals.canonical_chroms(candidates, chrom_order), blacklist, blacklist_fraction)
    numbered = cut_lineage(intervals.number_features(kept, chrom_order, "VMR_%06d").drop("feature_rank"))
    usable = sites.guarded_sites(sites.context_filter(site_rows, context, "dinucleotide"), "count")
    counts = checked(intervals.count_over_regions(usable.watched, numbered), usable)
    var = features.rank_regions(features.with_coverage(counts, numbered), cell_table, n, floor_percent=floor_percent, exact=exact)
    return FeatureMatrix(counts.join(var.select("feature_id"), "feature_id", "left_semi"), var, cells.annotate_obs(cell_table, annotation))


def differential_matrix(
    site_rows: DataFrame, cell_table: DataFrame, chrom_order: DataFrame, *, context: str = "CGN", round_sites: bool = False,
    smooth_bandwidth: int = 1000, bandwidth: int = 2000, step: int = 1000, threshold: float = 0.02, min_cells: int = 6,
    max_raw_p: float = 0.01, min_abs_diff: float = 0.25, top: int = 200, min_observed: int = 30, cell_filter: dict | None = None,
    permute_seed: int = 0,
) -> DifferentialMatrix:
    """Sites to group contrasts to leading hypomethylated regions to a z-scored region-by-cell table.

    An invalid site count, a sample with fewer than two labels and a run that leaves no cell are errors.
    Cells pass ``meth_cell_filter`` (its bounds in ``cell_filter``) before smoothing. Contrasts run for
    the real and for permuted labels in one job, which gives ``dmr`` its ``adj_p``.
    Regions belong to a sample and are filled from that sample's cells only.
    """
    valid = sites.guarded_sites(sites.context_filter(site_rows, context), "convert")
    passed = checked(cells.meth_cell_filter(cells.meth_cell_stats(sites.binary_calls(valid.watched, round_sites)), **(cell_filter or {})), valid)
    pairs, comparable = cells.guarded_pairs(cell_table.join(passed.select("cell_id"), "cell_id", "left_semi"))
    checked(pairs, comparable)
    # every row of the context has been looked at above
    usable = sites.context_filter(site_rows, context)
    if passed.isEmpty():
        raise ValueError("no cell passes the site and methylation bounds")
    usable = usable.join(broadcast_if_small(passed.select("cell_id")), "cell_id", "left_semi")
    calls = sites.binary_calls(usable, round_sites)
    # one exchange of the calls: smoothing, residuals and windows stay in its tiles
    tiles = methylation.tile_calls(calls, bandwidth=bandwidth)
    residuals = methylation.tile_residuals(tiles, smooth_bandwidth, bandwidth=bandwidth)
    windows = methylation.label_windows(residuals, cell_table, bandwidth=bandwidth, step=step, permute_seed=permute_seed)
    contrasts = methylation.compare_windows(windows, bandwidth=bandwidth, step=step, min_cells=min_cells)
    dmr = cut_lineage(methylation.diff_methylation(contrasts, threshold=threshold))
    hypo = regions.hypo_label(regions.dmr_threshold(dmr, max_raw_p=max_raw_p, min_abs_diff=min_abs_diff))
    leading = regions.top_n_per_label(regions.best_per_interval(hypo), chrom_order, top)
    merged = intervals.merge_overlapping(leading, ["sample_id"], label="hypo")
    numbered = cut_lineage(intervals.number_features(merged, chrom_order, "{sample_id}__merged_hypo_DMR_%06d", ["sample_id"]))
    # the sample goes into the chromosome key, so a region only meets its own sample's cells
    key = F.concat_ws("|", "sample_id", "chrom").alias("chrom")
    own = usable.join(cell_table.select("cell_id", F.col("sample_id")), "cell_id") if "sample_id" not in usable.columns else usable
    values = regions.region_mean_of_site_ratios(
        own.select("cell_id", key, "pos", "mc", "cov"), numbered.select(key, "start", "end", "feature_id")
    )
    return DifferentialMatrix(dmr, numbered, regions.region_zscore(cut_lineage(values), min_observed=min_observed))


def expression_clusters(
    counts: DataFrame, *, qc: dict | None = None, min_gene_cells: int = 3, genes: int = 2000, components: int = 50,
    k: int = 15, iterations: int = 10, correct_batches: bool = True, markers: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """Counts to ``(cell_id, cluster)`` and one-versus-rest marker scores: QC, normalisation, variable
    genes, scaling, components, batch correction by sample, mutual neighbours, communities.

    Without ``markers`` their scores, which no cluster depends on, are not derived."""
    packed = expression.packed_cells(counts)
    good = cut_lineage(expression.cell_qc(expression.cell_metrics(expression.unpacked(packed)), **(qc or {})).select("cell_id"))
    kept = expression.packed_totals(expression.packed_gene_min_cells(stored(cells.restrict_to_cells(packed, good)), min_gene_cells))
    values = expression.packed_values(kept)
    names = sorted(r["gene"] for r in bounded_rows(expression.highly_variable_genes(values, genes), genes, "variable genes"))
    members = kept.select("cell_id", "sample_id")
    scores, _ = linalg.pca(expression.scale_rows(stored(expression.chosen_counts(kept, names)), len(names)), components)
    if correct_batches:
        scores = batch.harmonize(scores.withColumnRenamed("sample_id", "batch"))
    edges = neighbors.mutual_edges(neighbors.knn(scores.select("cell_id", "vec"), k))
    clusters = cut_lineage(graph.graph_communities(edges, members, iterations))
    return clusters, expression.rank_genes_wilcoxon(values, clusters, "cluster") if markers else None

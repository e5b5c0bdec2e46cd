"""Differential-region rows: thresholds, labels, selection, per-cell matrices and display order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspan.functions.columns import clip
from cellspan.operators.intervals import join_sites_to_regions, with_chrom_rank
from cellspan.plans.prefix import global_row_number, tile_running_max
from cellspan.plans.sizes import broadcast_if_small
from cellspan.plans.storage import cut_lineage


def dmr_threshold(dmr: DataFrame, *, max_raw_p: float = 0.01, min_abs_diff: float = 0.25) -> DataFrame:
    """Rows with ``raw_p`` strictly below the limit and at least the given methylation difference."""
    diff = F.abs(F.col("meth_a") - F.col("meth_b"))
    return dmr.where((F.col("raw_p") < max_raw_p) & (diff >= min_abs_diff)).withColumn("abs_diff", diff)


def hypo_label(dmr: DataFrame) -> DataFrame:
    """Name the hypomethylated label and the other one; an unknown ``low_group`` is an error."""
    low = F.col("low_group")
    bad = F.raise_error(F.concat(F.lit("invalid low group: "), F.coalesce(low, F.lit("null"))))
    return dmr.withColumn(
        "hypo", F.when(low == "group_A", F.col("cell_type_a")).when(low == "group_B", F.col("cell_type_b")).otherwise(bad)
    ).withColumn("other", F.when(low == "group_A", F.col("cell_type_b")).when(low == "group_B", F.col("cell_type_a")).otherwise(bad))


def best_per_interval(hypo: DataFrame, *, pooled: bool = False) -> DataFrame:
    """One row per (sample, label, interval): largest difference, then smallest p, then the last key.

    ``pooled`` ignores the sample and breaks ties by ``comparison`` instead of ``other``. An
    aggregate (not a window) keeps it combinable before the shuffle.
    """
    last = "comparison" if pooled else "other"
    keys = ([] if pooled else ["sample_id"]) + ["hypo", "chrom", "start", "end"]
    rank = F.struct(-F.col("abs_diff"), F.col("raw_p"), F.col(last))
    return hypo.groupBy(*keys).agg(F.min_by(F.struct("abs_diff", "raw_p", last), rank).alias("b")).select(*keys, "b.*")


def top_n_per_label(best: DataFrame, chrom_order: DataFrame, n: int = 200) -> DataFrame:
    """The ``n`` leading regions of each (sample, label); the rank limit is pushed below the shuffle."""
    keys = [F.desc("abs_diff"), F.asc("raw_p"), F.asc_nulls_last("chrom_rank"), F.asc("chrom"), F.asc("start"), F.asc("end")]
    w = Window.partitionBy("sample_id", "hypo").orderBy(*keys)
    ranked = with_chrom_rank(best, chrom_order).withColumn("label_rank", F.row_number().over(w).cast("long"))
    return ranked.where(F.col("label_rank") <= n).drop("chrom_rank")


def resolve_comparisons(comparisons: DataFrame, fallback: DataFrame) -> DataFrame:
    """Which result each comparison uses: its own, the fallback's, or an error; ineligible ones go.

    ``comparisons``: ``sample_id, comparison, status, dmr_file``; ``fallback``: ``sample_id,
    comparison, dmr_file``.
    """
    other = fallback.select("sample_id", "comparison", F.col("dmr_file").alias("__fallback"))
    open_ = comparisons.where(F.col("status") != "ineligible").join(other, ["sample_id", "comparison"], "left")
    error = F.raise_error(F.concat(F.lit("unresolved comparison: "), F.col("comparison")))
    chosen = (
        F.when(F.col("status") == "complete", F.col("dmr_file"))
        .when((F.col("status") == "known_fdr_zero_failure") & F.col("__fallback").isNotNull(), F.col("__fallback"))
        .otherwise(error)
    )
    return open_.select("sample_id", "comparison", "status", chosen.alias("dmr_file"))


def pairwise_rollup(comparisons: DataFrame) -> DataFrame:
    """Comparisons by status and the overall verdict."""
    at = lambda s, n: F.count_if(F.col("status") == s).alias(n)
    counts = comparisons.agg(
        F.count("*").alias("comparisons"), at("complete", "completed"), at("ineligible", "ineligible"),
        at("failed", "failed"), at("known_fdr_zero_failure", "fallback_needed"),
    )
    known = F.col("completed") + F.col("ineligible")
    return counts.withColumn(
        "status",
        F.when(F.col("comparisons") == known, "complete")
        .when(F.col("comparisons") == known + F.col("fallback_needed"), "complete_with_fallback_needed")
        .otherwise("failed"),
    )


def region_mean_of_site_ratios(sites: DataFrame, regions: DataFrame, *, position_base: int = 0) -> DataFrame:
    """Unweighted mean over sites of the per-site methylation ratio, per (cell, region).

    Repeated rows of a site are summed first. Not the same as sum(mc)/sum(cov). The coordinate test
    takes the position as it is unless ``position_base=1``. Both aggregations share one shuffle: the
    rows are placed by (cell, region) before the per-site sum.
    """
    hits = join_sites_to_regions(
        sites.select("cell_id", "chrom", "pos", "mc", "cov"), regions.select("chrom", "start", "end", "feature_id"),
        position_base=position_base,
    )
    placed = hits.repartition("cell_id", "feature_id")
    per_site = placed.groupBy("cell_id", "feature_id", "pos").agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))
    ratio = F.when(F.col("cov") > 0, F.col("mc") / F.col("cov")).otherwise(
        F.raise_error(F.concat(F.lit("zero coverage at position "), F.col("pos").cast("string"))).cast("double")
    )
    return per_site.groupBy("cell_id", "feature_id").agg(F.avg(ratio).alias("value"), F.count("*").alias("n_sites"))


def region_zscore(matrix: DataFrame, *, min_observed: int = 30, clip_at: float | None = None) -> DataFrame:
    """z per region over its observed cells with the population deviation.

    Null where fewer than ``min_observed`` cells or no spread. Statistics are aggregated and joined
    back, so a region seen in every cell never becomes one window group.
    """
    stats = matrix.groupBy("feature_id").agg(
        F.avg("value").alias("__m"), F.stddev_pop("value").alias("__sd"), F.count("value").alias("observed_cells")
    )
    ok = (F.col("observed_cells") >= min_observed) & (F.col("__sd") > 0)
    z = F.when(ok, (F.col("value") - F.col("__m")) / F.col("__sd"))
    out = matrix.join(broadcast_if_small(stats, materialize=True), "feature_id").withColumn("z", z if clip_at is None else clip(z, clip_at))
    return out.drop("__m", "__sd")


def zscore_qc(matrix: DataFrame, *, min_observed: int = 30) -> DataFrame:
    """Observed cells and eligibility per region."""
    return matrix.groupBy("feature_id").agg(
        F.count("value").alias("observed_cells"),
        ((F.count("value") >= min_observed) & (F.stddev_pop("value") > 0)).alias("eligible"),
    )


def own_label_for_region(matrix: DataFrame, cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Give each merged region to the supporting label with the lowest mean; unobserved last, ties by name.

    ``regions`` has ``feature_id, labels`` (array).
    """
    support = regions.select("feature_id", F.explode("labels").alias("cell_type"))
    means = (
        matrix.join(broadcast_if_small(cells.select("cell_id", "cell_type")), "cell_id").groupBy("feature_id", "cell_type")
        .agg(F.avg("value").alias("label_mean"))
    )
    scored = support.join(means, ["feature_id", "cell_type"], "left")
    rank = F.struct(F.col("label_mean").isNull().alias("a"), F.coalesce("label_mean", F.lit(0.0)).alias("b"), F.col("cell_type").alias("c"))
    return scored.groupBy("feature_id").agg(F.min_by(F.struct("cell_type", "label_mean"), rank).alias("o")).select(
        "feature_id", F.col("o.cell_type").alias("own_label"), F.col("o.label_mean").alias("own_mean")
    )


def heatmap_cell_order(cells: DataFrame, own: DataFrame) -> DataFrame:
    """Row axis: cells whose label owns a region, by (label, id), numbered from 1."""
    kept = cells.select("cell_id", "cell_type").distinct().join(own.select(F.col("own_label").alias("cell_type")), "cell_type", "left_semi")
    return global_row_number(kept, [F.col("cell_type"), F.col("cell_id")], "position")


def heatmap_region_order(regions: DataFrame, own: DataFrame, chrom_order: DataFrame) -> DataFrame:
    """Column axis: regions by (owner label, genome order), numbered from 1."""
    placed = with_chrom_rank(regions.select("chrom", "start", "end", "feature_id"), chrom_order).join(own.select("feature_id", "own_label"), "feature_id")
    order = [F.col("own_label"), F.col("chrom_rank").asc_nulls_last(), F.col("chrom"), F.col("start"), F.col("end"), F.col("feature_id")]
    return global_row_number(placed, order, "position").drop("chrom_rank")


def contiguous_groups(ordered: DataFrame, label: str, position: str = "position") -> DataFrame:
    """Runs of one label along a 1..n order: first, last, centre.

    A run opens where the label differs from the row before. The neighbour is found by an equi-join
    on ``position - 1`` and the run start by a tiled running maximum, so no task holds the whole order.
    """
    rows = ordered.select(F.col(position).alias("__pos"), F.col(label).alias("label"))
    before = rows.select((F.col("__pos") + 1).alias("__pos"), F.col("label").alias("__before"), F.lit(True).alias("__has"))
    linked = rows.join(before, "__pos", "left")
    opens = F.col("__has").isNull() | ~F.col("label").eqNullSafe(F.col("__before"))
    marked = cut_lineage(linked.withColumn("__open", F.when(opens, F.col("__pos"))).select("__pos", "label", "__open"))
    runs = tile_running_max(marked, [], "__pos", "__open", "run_start", inclusive=True)
    return runs.groupBy("run_start").agg(F.first("label").alias("label"), F.max("__pos").alias("run_end")).withColumn(
        "center", (F.col("run_start") + F.col("run_end")) / 2
    )


def adjacent_duplicates(sites: DataFrame) -> DataFrame:
    """Coordinates listed more than once within a cell.

    In the coordinate-sorted files this checks, equal consecutive coordinates and repeated
    coordinates are the same thing, and the repeat count needs no order.
    """
    return sites.groupBy("cell_id", "chrom", "pos").agg(F.count("*").alias("copies")).where("copies > 1")

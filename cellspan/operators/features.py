"""Feature (region or bin) tables: coverage, ranking, nesting, combination and count checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspan.functions.columns import safe_ratio
from cellspan.operators.intervals import non_overlapping
from cellspan.operators.quality import require_empty
from cellspan.plans.guards import Guard
from cellspan.plans.prefix import global_row_number
from cellspan.plans.quantiles import exact_quantiles
from cellspan.plans.sizes import broadcast_if_small
from cellspan.plans.storage import cut_lineage


def feature_coverage(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Cells with coverage per feature; uncovered features count zero."""
    n = counts.where(F.col("cov") > 0).groupBy("feature_id").agg(F.count("*").alias("covered_cells"))
    return features.join(n, "feature_id", "left").withColumn("covered_cells", F.coalesce("covered_cells", F.lit(0).cast("long")))


def with_coverage(counts: DataFrame, features: DataFrame) -> DataFrame:
    return feature_coverage(counts, features)


def _coverage_cutoff(covered: DataFrame, cells: DataFrame, n: int, floor_percent: float):
    """max(ceil(cells * floor%), n-th largest coverage) as a scalar subquery."""
    nth = covered.orderBy(F.desc("covered_cells")).limit(n).agg(F.min("covered_cells")).scalar()
    floor = cells.agg(F.ceil(F.count_distinct("cell_id") * F.lit(floor_percent) / 100)).scalar()
    return F.greatest(nth, floor)


def _complete(top: DataFrame, n: int, exact: bool) -> DataFrame:
    """``top``, stored once and refused when it holds fewer than ``n`` rows, if ``exact``."""
    if not exact:
        return top
    top = cut_lineage(top)
    found = top.count()
    if found < n:
        raise ValueError(f"{n} features were asked for, {found} are eligible")
    return top


def rank_regions(covered: DataFrame, cells: DataFrame, n: int, *, floor_percent: float = 0.0, exact: bool = True) -> DataFrame:
    """The ``n`` best coverage-eligible regions with ``selection_rank``.

    Order: ``peak_var`` desc, ``n_obs_cells`` desc, ``n_cpg`` desc, id. The top-n runs before the
    numbering window, so that window sees exactly ``n`` rows. Fewer are an error unless ``exact`` is off.
    """
    keys = [F.desc("peak_var"), F.desc("n_obs_cells"), F.desc("n_cpg"), F.asc("feature_id")]
    covered = cut_lineage(covered)  # one row per region, read for the cutoff and for the ranking
    eligible = covered.where(F.col("covered_cells") >= _coverage_cutoff(covered, cells, n, floor_percent))
    top = _complete(eligible.orderBy(*keys).limit(n), n, exact)
    return top.withColumn("length", F.col("end") - F.col("start")).withColumn(
        "selection_rank", F.row_number().over(Window.orderBy(*keys)).cast("long")
    )


def rank_regions_summary(covered: DataFrame, cells: DataFrame, n: int, *, floor_percent: float = 0.0) -> DataFrame:
    """Effective cutoff, its share of the cells, and how many regions pass it."""
    covered = cut_lineage(covered)
    cut = _coverage_cutoff(covered, cells, n, floor_percent)
    marked = covered.withColumn("__cut", cut)
    return marked.agg(
        F.count("*").alias("source_features"),
        F.max("__cut").alias("min_covered_cells"),
        F.count_if(F.col("covered_cells") >= F.col("__cut")).alias("eligible_features"),
    ).withColumn(
        "effective_covered_percent",
        F.col("min_covered_cells") * 100.0 / cells.agg(F.count_distinct("cell_id")).scalar(),
    )


def rank_bins(prevalence: DataFrame, n: int, *, exact: bool = True) -> DataFrame:
    """The ``n`` bins most often hypomethylated (ties by id), with ``selection_rank``.

    Fewer are an error unless ``exact`` is off.
    """
    keys = [F.desc("hypo_cells"), F.asc("feature_id")]
    top = _complete(prevalence.where(F.col("hypo_cells") > 0).orderBy(*keys).limit(n), n, exact)
    return top.withColumn("selection_rank", F.row_number().over(Window.orderBy(*keys)).cast("long"))


def rank_bins_summary(prevalence: DataFrame, cells: DataFrame, n: int) -> DataFrame:
    """Boundary count of the top ``n``, bins tied with it, and its share of the cells."""
    boundary = rank_bins(prevalence, n, exact=False).agg(F.min("hypo_cells")).scalar()
    return prevalence.withColumn("__b", boundary).agg(
        F.count_if(F.col("hypo_cells") > 0).alias("nonzero_hypo_bins"),
        F.max("__b").alias("boundary_hypo_cells"),
        F.count_if(F.col("hypo_cells") == F.col("__b")).alias("boundary_tied_bins"),
    ).withColumn(
        "effective_hypo_percent",
        F.col("boundary_hypo_cells") * 100.0 / cells.agg(F.count_distinct("cell_id")).scalar(),
    )


def nested_subset(ranked: DataFrame, k: int, *, exact: bool = True) -> DataFrame:
    """The first ``k`` ranked features. Ranks other than ``1..k``, once each, are an error unless ``exact`` is off."""
    first = ranked.where(F.col("selection_rank") <= k)
    if exact:
        first = cut_lineage(first)
        require_empty(nested_subset_problem(first, k), f"ranks 1 to {k} are not complete")
    return first


def nested_subset_problem(ranked: DataFrame, k: int) -> DataFrame:
    """One row when the ranks ``1..k`` are not present exactly once, else none."""
    return nested_subset(ranked, k, exact=False).agg(
        F.count("*").alias("rows"), F.count_distinct("selection_rank").alias("ranks"), F.min("selection_rank").alias("lowest")
    ).where((F.col("rows") != k) | (F.col("ranks") != k) | (F.col("lowest") != 1))


def combine_features(vmr: DataFrame, dmr: DataFrame) -> DataFrame:
    """VMRs followed by the DMRs that overlap none of them, ranked 1..n in that order."""
    cols = ["chrom", "start", "end", "feature_id", "selection_rank"]
    first = vmr.select(*cols).withColumn("feature_source", F.lit("VMR")).withColumn("__o", F.lit(0))
    rest = non_overlapping(dmr.select(*cols), vmr).select(*cols).withColumn("feature_source", F.lit("pooled_DMR")).withColumn("__o", F.lit(1))
    both = first.unionByName(rest).withColumnRenamed("selection_rank", "__r")
    order = [F.col("__o"), F.col("__r"), F.col("feature_id")]
    return global_row_number(both, order, "selection_rank").drop("__o", "__r")


def combine_inputs(
    vmr: DataFrame, dmr: DataFrame, vmr_counts: DataFrame, dmr_counts: DataFrame, vmr_cells: DataFrame, dmr_cells: DataFrame
) -> tuple[DataFrame, DataFrame, list[Guard]]:
    """Features (as :func:`combine_features`) and counts of both sources, and the guards of a sound combination.

    Both sources have the same cells, no feature id is in both, at least one DMR overlaps no VMR, and methylated reads
    don't exceed reads. The feature and cell rules are counted on the small tables; the counts are read once.
    """
    combined = combine_features(vmr, dmr)
    ids = combined.groupBy("feature_id").agg(F.count("*").alias("copies"))
    disjoint = Guard(ids, "combined features", {"a feature id of both sources": F.col("copies") > 1}, ["feature_id"])
    added = Guard(combined.where("feature_source = 'pooled_DMR'"), "DMRs that overlap no VMR", {}, [], at_least=1)
    side = lambda df, name: df.select("cell_id").distinct().withColumn(name, F.lit(True))
    both = side(vmr_cells, "in_vmr").join(side(dmr_cells, "in_dmr"), "cell_id", "full_outer")
    cells = Guard(both, "combined cells", {"a cell of one source only": F.col("in_vmr").isNull() | F.col("in_dmr").isNull()}, ["cell_id", "in_vmr", "in_dmr"])
    var = combined.where("feature_source = 'VMR'").unionByName(added.watched).join(disjoint.watched.select("feature_id"), "feature_id")
    tall = vmr_counts.select("cell_id", "feature_id", "mc", "cov").unionByName(dmr_counts.select("cell_id", "feature_id", "mc", "cov"))
    sound = Guard(tall, "combined counts", {"mc above cov": F.col("mc") > F.col("cov"), "a negative count": (F.col("mc") < 0) | (F.col("cov") < 0)},
                  ["cell_id", "feature_id", "mc", "cov"])
    kept = sound.watched.join(broadcast_if_small(var.select("feature_id")), "feature_id", "left_semi")
    counts = kept.join(broadcast_if_small(cells.watched.select("cell_id")), "cell_id", "left_semi")
    return var, counts, [disjoint, added, cells, sound]


def model_input_summary(vmr: DataFrame, dmr: DataFrame, combined: DataFrame) -> DataFrame:
    """Counts of a combined input; ``combined_features`` must equal VMRs plus added DMRs."""
    return combined.agg(
        F.count_if(F.col("feature_source") == "VMR").alias("vmr_features"),
        F.count_if(F.col("feature_source") == "pooled_DMR").alias("dmrs_added"),
        F.count("*").alias("combined_features"),
    ).withColumn("source_dmrs", dmr.agg(F.count("*")).scalar()).withColumn(
        "dmrs_overlapping_removed", F.col("source_dmrs") - F.col("dmrs_added")
    ).withColumn(
        "vmr_features",
        F.when(F.col("vmr_features") == vmr.agg(F.count("*")).scalar(), F.col("vmr_features")).otherwise(
            F.raise_error(F.lit("combined input lost VMR features")).cast("long")
        ),
    )


def shared_ids(a: DataFrame, b: DataFrame, key: str = "feature_id") -> DataFrame:
    """Ids present in both sets; must be empty before features are combined."""
    return a.select(key).intersect(b.select(key))


def cell_methylation_qc(counts: DataFrame) -> DataFrame:
    """Depth, overall methylation, and unweighted mean over covered features, per cell."""
    return counts.groupBy("cell_id").agg(
        F.sum("cov").alias("sequencing_depth"),
        safe_ratio(F.sum("mc"), F.sum("cov")).alias("overall_mcg"),
        F.avg(F.when(F.col("cov") > 0, F.col("mc") / F.col("cov"))).alias("mean_mcg"),
    )


def _metrics_long(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*keys, F.explode(pairs).alias("__m")).select(*keys, "__m.metric", "__m.value").where("value is not null")


def metric_by_group(df: DataFrame, group: str, metrics: Sequence[str]) -> DataFrame:
    """Box-plot numbers per (group, metric): quartiles and whiskers at 1.5 interquartile ranges."""
    long = _metrics_long(df, [group], metrics)
    q = exact_quantiles(long, [group, "metric"], "value", [0.25, 0.5, 0.75])
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("quantile")))
    box = q.groupBy(group, "metric").agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    return long.join(box, [group, "metric"]).groupBy(group, "metric", "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        F.min(F.when(v >= F.col("q1") - reach, v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("q3") + reach, v)).alias("whisker_high"),
    )


def metric_distribution(df: DataFrame, group: str, metrics: Sequence[str]) -> DataFrame:
    """count, mean, std, min, 1/5/50/95/99 %, max per (group, metric), one row per statistic set."""
    long = _metrics_long(df, [group], metrics)
    basic = long.groupBy(group, "metric").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    ps = [0.01, 0.05, 0.5, 0.95, 0.99]
    q = exact_quantiles(long, [group, "metric"], "value", ps)
    wide = q.groupBy(group, "metric").agg(
        *[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(f"p{round(p * 100):02d}") for p in ps]
    )
    return basic.join(wide, [group, "metric"])


def coverage_quantiles(covered: DataFrame) -> DataFrame:
    """Quantiles of covered cells over all features."""
    return exact_quantiles(covered, [], "covered_cells", [0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0])


def check_counts_layers(counts: DataFrame, batch: str) -> DataFrame:
    """One row: invalid values in the count layers and whether the batch column can be used."""
    return counts.agg(
        F.count("*").alias("n_values"),
        F.count_if(F.col("mc") > F.col("cov")).alias("mc_above_cov"),
        F.count_if((F.col("mc") < 0) | (F.col("cov") < 0)).alias("negative"),
        F.count_distinct(batch).alias("batches"),
    ).withColumn("pass", (F.col("mc_above_cov") == 0) & (F.col("negative") == 0)).withColumn(
        "few_batches", F.col("batches") < 2
    )

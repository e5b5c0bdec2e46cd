"""Genomic interval operators: interval joins, exclusion, merging, ordering, numbering.

Intervals are 0-based half-open ``[start, end)``. Every join keys on ``(chrom, bin)`` so the planner
sees an equi-join with a residual range test. The interval side is counted and broadcast only below
a limit, which spares the sites a shuffle; beyond it the join is sort-merge and AQE splits hot bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspan.functions.columns import bin_index, overlap_length
from cellspan.plans.prefix import global_row_number, tile_running_max
from cellspan.plans.sizes import broadcast_if_small
from cellspan.plans.storage import cut_lineage

BIN = 10_000


def zero_based(position: str, position_base: int) -> Column:
    """0-based coordinate of ``position``: base 1 subtracts one, base 0 takes it as it is."""
    if position_base not in (0, 1):
        raise ValueError("position_base is 0 or 1")
    return F.col(position) - position_base


def explode_bins(intervals: DataFrame, bin_size: int = BIN) -> DataFrame:
    """One row per bin an interval touches, as ``__bin``."""
    return intervals.withColumn(
        "__bin",
        F.explode(F.sequence(bin_index("start", bin_size), bin_index(F.col("end") - 1, bin_size))),
    )


def index_regions(regions: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Regions by bin, ready for any number of site joins: derived once, broadcast if small."""
    return broadcast_if_small(explode_bins(regions, bin_size), materialize=True)


def join_sites_to_regions(
    sites: DataFrame,
    regions: DataFrame,
    *,
    position: str = "pos",
    position_base: int = 1,
    bin_size: int = BIN,
) -> DataFrame:
    """Every (site, region) with ``start <= position < end``; a site has one bin, so no duplicates.

    ``regions`` may be the output of :func:`index_regions` with the same ``bin_size``.
    """
    index = regions if "__bin" in regions.columns else index_regions(regions, bin_size)
    keyed = sites.withColumn("__p", zero_based(position, position_base)).withColumn(
        "__bin", bin_index("__p", bin_size)
    )
    hit = (F.col("start") <= F.col("__p")) & (F.col("__p") < F.col("end"))
    return keyed.join(index, ["chrom", "__bin"]).where(hit).drop("__bin", "__p")


def count_over_regions(
    sites: DataFrame, regions: DataFrame, *, position_base: int = 1, bin_size: int = BIN
) -> DataFrame:
    """Methylated and total reads per (cell, region); only covered pairs are kept."""
    hits = join_sites_to_regions(
        sites.select("cell_id", "chrom", "pos", "mc", "cov"),
        regions.select("chrom", "start", "end", "feature_id", *[c for c in ("__bin",) if c in regions.columns]),
        position_base=position_base,
        bin_size=bin_size,
    )
    return (
        hits.groupBy("cell_id", "feature_id")
        .agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))
        .where(F.col("cov") > 0)
    )


def count_over_bins(
    sites: DataFrame, bins: DataFrame, bin_size: int, *, position_base: int = 1
) -> DataFrame:
    """Reads per (cell, kept bin): arithmetic bin key, then the half-open test (a last bin may be short).

    ``bins`` has ``chrom, start, end, feature_id`` with ``start`` on a bin edge.
    """
    keyed = sites.select("cell_id", "chrom", "mc", "cov", zero_based("pos", position_base).alias("__p"))
    keyed = keyed.withColumn("__bin", bin_index("__p", bin_size))
    kept = bins.select("chrom", "start", "end", "feature_id", bin_index("start", bin_size).alias("__bin"))
    return (
        keyed.join(broadcast_if_small(kept), ["chrom", "__bin"])
        .where((F.col("start") <= F.col("__p")) & (F.col("__p") < F.col("end")))
        .groupBy("cell_id", "feature_id")
        .agg(F.sum("mc").alias("mc"), F.sum("cov").alias("cov"))
        .where(F.col("cov") > 0)
    )


def tile_genome(chrom_order: DataFrame, bin_size: int) -> DataFrame:
    """Fixed bins of every chromosome, ``chrom_<bin start>`` as id; the last bin is cut at the size."""
    return (
        chrom_order.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(bin_size).cast("long"))))
        .withColumn("end", F.least(F.col("start") + bin_size, F.col("size")))
        .select("chrom", "start", "end", F.concat_ws("_", "chrom", "start", "end").alias("feature_id"))
    )


def _overlapping_keys(a: DataFrame, b: DataFrame, test: Column, bin_size: int) -> DataFrame:
    """Distinct ``(chrom, start, end)`` of ``a`` for which some row of ``b`` passes ``test``."""
    left = explode_bins(a.select("chrom", "start", "end").distinct(), bin_size)
    right = index_regions(b.select("chrom", "start", "end").distinct(), bin_size).select(
        F.col("chrom").alias("__chrom"), F.col("__bin").alias("__obin"),
        F.col("start").alias("__s"), F.col("end").alias("__e"),
    )
    on = (F.col("chrom") == F.col("__chrom")) & (F.col("__bin") == F.col("__obin")) & test
    return left.join(right, on, "left_semi").select("chrom", "start", "end").distinct()


def remove_blacklisted(
    intervals: DataFrame, blacklist: DataFrame, fraction: float = 0.2, *, bin_size: int = BIN
) -> DataFrame:
    """Drop an interval when one single blacklist entry covers at least ``fraction`` of its length."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    shared = overlap_length("start", "end", "__s", "__e")
    test = (shared > 0) & (shared / (F.col("end") - F.col("start")) >= F.lit(float(fraction)))
    return intervals.join(_overlapping_keys(intervals, blacklist, test, bin_size), ["chrom", "start", "end"], "left_anti")


def non_overlapping(a: DataFrame, b: DataFrame, *, bin_size: int = BIN) -> DataFrame:
    """Rows of ``a`` that share no base with any row of ``b``."""
    test = overlap_length("start", "end", "__s", "__e") > 0
    return a.join(_overlapping_keys(a, b, test, bin_size), ["chrom", "start", "end"], "left_anti")


def merge_overlapping(
    intervals: DataFrame,
    keys: Sequence[str] = (),
    *,
    label: str | None = None,
    max_of: Sequence[str] = (),
    min_of: Sequence[str] = (),
    bridge_gaps: int = 0,
) -> DataFrame:
    """Merge intervals that share at least one base, per ``keys`` and chromosome.

    Touching intervals stay apart (``bridge_gaps`` widens the reach). Intervals with one start
    always merge, so they collapse first; starts are then unique and the running end is scanned in
    position tiles. Output: ``source_count``, sorted ``labels`` (when ``label`` is given) and the
    requested maxima/minima.
    """
    group = [*keys, "chrom"]
    firsts = [F.max("end").alias("end"), F.count("*").alias("__n")]
    merges = [F.max("end").alias("end"), F.sum("__n").alias("source_count")]
    if label:
        firsts.append(F.collect_set(label).alias("__labels"))
        merges.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set("__labels")))).alias("labels"))
    for c in max_of:
        firsts.append(F.max(c).alias(c))
        merges.append(F.max(c).alias(c))
    for c in min_of:
        firsts.append(F.min(c).alias(c))
        merges.append(F.min(c).alias(c))
    # the scans below read this table several times: compute the input once
    starts = cut_lineage(intervals.groupBy(*group, "start").agg(*firsts))
    reach = tile_running_max(
        starts.withColumn("__reach", F.col("end") + F.lit(bridge_gaps).cast("long")),
        group, "start", "__reach", "__prior", inclusive=False,
    )
    opens = F.col("__prior").isNull() | (F.col("start") >= F.col("__prior"))
    marked = reach.withColumn("__open", F.when(opens, F.col("start"))).drop("__prior", "__reach")
    islands = tile_running_max(marked, group, "start", "__open", "__island", inclusive=True)
    return (
        islands.groupBy(*group, "__island")
        .agg(*merges)
        .withColumnRenamed("__island", "start")
        .select(*group, "start", "end", *[c for c in ("labels",) if label], "source_count", *max_of, *min_of)
    )


def overlapping_pairs_check(intervals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Intervals that overlap an earlier one (by start); empty exactly when the set is disjoint."""
    group = [*keys, "chrom"]
    starts = cut_lineage(intervals.groupBy(*group, "start").agg(F.max("end").alias("end"), F.count("*").alias("n_same_start")))
    prior = tile_running_max(starts, group, "start", "end", "prior_end", inclusive=False)
    return prior.where((F.col("n_same_start") > 1) | (F.col("start") < F.col("prior_end"))).select(
        *group, "start", "end", "n_same_start", "prior_end"
    )


def canonical_chroms(intervals: DataFrame, chrom_order: DataFrame) -> DataFrame:
    """Only rows on declared chromosomes."""
    return intervals.join(chrom_order.select("chrom"), "chrom", "left_semi")


def dropped_chroms(intervals: DataFrame, chrom_order: DataFrame) -> DataFrame:
    """Rows lost to :func:`canonical_chroms`, counted per chromosome."""
    return (
        intervals.join(chrom_order.select("chrom"), "chrom", "left_anti")
        .groupBy("chrom").agg(F.count("*").alias("dropped_rows"))
    )


def with_chrom_rank(df: DataFrame, chrom_order: DataFrame) -> DataFrame:
    """Add ``chrom_rank``: place in the declared order, null for an undeclared chromosome."""
    return df.join(chrom_order.select("chrom", F.col("rank").alias("chrom_rank")), "chrom", "left")


def genome_order_keys(*tail: str) -> list[Column]:
    """Sort keys: declared chromosomes by rank, undeclared last by name, then ``tail``."""
    return [F.col("chrom_rank").asc_nulls_last(), F.col("chrom"), *[F.col(t) for t in tail]]


def genome_order(intervals: DataFrame, chrom_order: DataFrame, *tail: str) -> DataFrame:
    """Globally sorted by (chromosome rank, start, end, ...): a range-partitioned sort."""
    keys = genome_order_keys("start", "end", *tail)
    return with_chrom_rank(intervals, chrom_order).orderBy(*keys)


def number_features(
    intervals: DataFrame, chrom_order: DataFrame, pattern: str = "VMR_%06d", keys: Sequence[str] = ()
) -> DataFrame:
    """``feature_id`` in genome order (per ``keys``), e.g. ``VMR_000001``.

    ``pattern`` is a printf pattern; with keys, each ``{key}`` is replaced by the key's value.
    """
    ranked = global_row_number(
        with_chrom_rank(intervals, chrom_order), genome_order_keys("start", "end"), "feature_rank", keys
    )
    parts: list[Column] = []
    text = pattern
    for key in keys:
        before, found, text = text.partition("{" + key + "}")
        parts.append(F.lit(before))
        if found:
            parts.append(F.col(key))
    parts.append(F.format_string(text, "feature_rank"))
    return ranked.withColumn("feature_id", F.concat(*parts)).drop("chrom_rank")


# The two accepted spellings of a feature coordinate.
FEATURE_PATTERNS = (r"^(chr[^:]+):(\d+)-(\d+)$", r"^(chr.+?)[_-](\d+)[_-](\d+)$")


def parse_feature_id(features: DataFrame, bin_size: int, column: str = "feature_id") -> DataFrame:
    """Split coordinate ids into ``chrom, start, end, bin``, with ``problem`` naming a bad row."""
    groups = []
    for i, kind in ((1, "string"), (2, "bigint"), (3, "bigint")):
        options = [F.nullif(F.regexp_extract(column, p, i), F.lit("")) for p in FEATURE_PATTERNS]
        groups.append(F.coalesce(*options).cast(kind))
    out = (
        features.withColumn("chrom", groups[0]).withColumn("start", groups[1]).withColumn("end", groups[2])
        .withColumn("bin", bin_index("start", bin_size))
    )
    copies = out.where(F.col("chrom").isNotNull()).groupBy("chrom", "bin").agg(F.count("*").alias("__copies"))
    problem = (
        F.when(F.col("chrom").isNull(), "unparsable")
        .when(F.col("end") <= F.col("start"), "invalid_interval")
        .when((F.col("start") % bin_size != 0) | (F.col("end") - F.col("start") > bin_size), "not_aligned")
        .when(F.col("__copies") > 1, "duplicate_bin")
    )
    return out.join(copies, ["chrom", "bin"], "left").withColumn("problem", problem).drop("__copies")


def interval_stats(intervals: DataFrame) -> DataFrame:
    """Count, covered bases and longest interval."""
    length = F.col("end") - F.col("start")
    return intervals.agg(
        F.count("*").alias("n_intervals"),
        F.coalesce(F.sum(length), F.lit(0)).alias("total_bp"),
        F.coalesce(F.max(length), F.lit(0)).alias("max_length"),
    )


def distinct_features(intervals: DataFrame, label: str) -> DataFrame:
    """Exact-unique intervals per label."""
    return intervals.select("chrom", "start", "end", label).distinct()

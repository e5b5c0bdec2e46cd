"""Smoothing, residual, variable-region, group-contrast and hypomethylation-score operators.

The formulas are this package's own definitions, stated in each docstring; positions are genomic,
so windows are positional ranges, never time windows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspan.functions.columns import int_div, safe_ratio
from cellspan.functions.stats import binomial_upper_tail, student_two_sided, welch_t
from cellspan.operators.intervals import join_sites_to_regions, merge_overlapping
from cellspan.operators.quality import require_empty
from cellspan.plans.prefix import global_row_number, ordered_blocks, prefix_sum
from cellspan.plans.quantiles import exact_quantiles
from cellspan.plans.sizes import BROADCAST_ROWS, broadcast_if_small
from cellspan.plans.storage import cut_lineage, stored

TILE = 65_536
#: Positions of a tile of :func:`tile_calls`; a multiple of every step.
SITE_TILE = 32_000
#: Calls of one bucket of :func:`save_tiles`, about.
BUCKET_CALLS = 1_000_000


def _tricube_tile(bandwidth: int):
    """Kernel sums of one padded tile (sorted unique positions) by neighbour offset."""

    def smooth(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("pos", ignore_index=True)
        pos = tile["pos"].to_numpy()
        n, meth = tile["n"].to_numpy(float), tile["meth"].to_numpy(float)
        top, bottom = meth.copy(), n.copy()
        for k in range(1, len(pos)):
            gap = pos[k:] - pos[:-k]
            near = np.flatnonzero(gap < bandwidth)
            if not len(near):
                break
            weight = (1.0 - (gap[near] / bandwidth) ** 3) ** 3
            for here, there in ((near, near + k), (near + k, near)):
                # indices are unique within one offset, so plain fancy addition is exact
                top[here] += weight * meth[there]
                bottom[here] += weight * n[there]
        tile["smoothed"] = top / bottom
        return tile.loc[tile["core"], ["chrom", "pos", "n", "meth", "smoothed"]]

    return smooth


def smooth_methylation(calls: DataFrame, bandwidth: int = 1000, *, tile: int = TILE) -> DataFrame:
    """Tricube-smoothed methylation per position.

    ``smoothed(p) = sum_j K(|p - p_j| / h) * meth_j / sum_j K * n_j`` over positions ``p_j`` closer
    than ``h = bandwidth``, with ``K(u) = (1 - u^3)^3``. Cells collapse to one row per position
    first. Each chromosome is cut into tiles padded by the bandwidth, so a group holds at most
    ``tile + 2 * bandwidth`` positions whatever the depth.
    """
    sites = calls.groupBy("chrom", "pos").agg(F.count("*").alias("n"), F.sum("call").alias("meth"))
    return _smoothed_positions(sites, bandwidth, tile)


def _smoothed_positions(sites: DataFrame, bandwidth: int, tile: int) -> DataFrame:
    reach = F.sequence(int_div(F.greatest(F.col("pos") - bandwidth, F.lit(0)), tile), int_div(F.col("pos") + bandwidth, tile))
    padded = sites.select("chrom", "pos", "n", "meth", F.explode(reach).alias("tile")).withColumn(
        "core", int_div("pos", tile) == F.col("tile")
    )
    return padded.groupBy("chrom", "tile").applyInPandas(
        _tricube_tile(bandwidth), "chrom string, pos bigint, n bigint, meth bigint, smoothed double"
    )


def _tiles_of(position, bandwidth: int, tile: int):
    """Tiles that hold a 0-based position: its own, and the one before it where that one's last windows reach it."""
    return F.explode(F.sequence(int_div(F.greatest(position - bandwidth, F.lit(0)), tile), int_div(position, tile))).alias("tile")


def tile_calls(calls: DataFrame, *, bandwidth: int = 2000, tile: int = SITE_TILE, extra: Sequence[str] = ()) -> DataFrame:
    """``calls`` placed once by (chromosome, tile): the layout that residuals and windows of any cell and label keep.

    A tile also holds the calls up to ``bandwidth`` behind it, which its last windows reach. ``core`` marks the tile a call
    belongs to; ``extra`` columns stay.
    """
    at = F.col("pos") - 1
    rows = calls.select("cell_id", *extra, "chrom", "pos", "call", _tiles_of(at, bandwidth, tile))
    return rows.withColumn("core", int_div(at, tile) == F.col("tile")).repartition("chrom", "tile")


def tile_buckets(calls: DataFrame, least: int = 8) -> int:
    """Buckets for :func:`save_tiles`: a bucket is read by one task, so their number follows the calls."""
    return max(least, -(-calls.count() // BUCKET_CALLS))


def save_tiles(tiles: DataFrame, table: str, buckets: int) -> DataFrame:
    """``tiles`` (of :func:`tile_calls`) as a table bucketed and sorted by chromosome and tile; its readers need no exchange."""
    tiles.write.bucketBy(buckets, "chrom", "tile").sortBy("chrom", "tile", "pos").format("parquet").mode("errorifexists").saveAsTable(table)
    return tiles.sparkSession.table(table)


def tile_residuals(
    tiles: DataFrame, smooth_bandwidth: int = 1000, *, bandwidth: int = 2000, tile: int = SITE_TILE, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``tiles`` with the ``residual`` of each call: the call minus its position's tricube-smoothed methylation.

    The numbers of :func:`call_residuals`, but no call leaves its tile: positions, which are few beside calls, are summed where
    they lie, smoothed, and broadcast, or beyond ``broadcast_rows`` sent to the tiles that hold them and carried on to the calls that
    follow them in position order.
    ``bandwidth`` and ``tile`` are those of :func:`tile_calls`.
    """
    sums = tiles.where("core").groupBy("chrom", "tile", "pos").agg(F.count("*").alias("n"), F.sum("call").alias("meth")).drop("tile")
    smoothed = cut_lineage(_smoothed_positions(sums, smooth_bandwidth, TILE))
    if smoothed.count() <= broadcast_rows:
        # a broadcast join leaves the calls where they are as well
        known = F.broadcast(smoothed.select("chrom", "pos", F.col("smoothed").alias("__m")))
        return tiles.join(known, ["chrom", "pos"]).withColumn("residual", F.col("call") - F.col("__m")).drop("__m")
    others = [c for c in tiles.columns if c not in ("chrom", "tile", "pos")]
    types = dict(tiles.dtypes)
    positions = smoothed.select("chrom", "pos", "smoothed", _tiles_of(F.col("pos") - 1, bandwidth, tile)).repartition("chrom", "tile").select(
        "chrom", "tile", "pos", "smoothed", *[F.lit(None).cast(types[c]).alias(c) for c in others])
    both = positions.unionByName(tiles.select("chrom", "tile", "pos", F.lit(None).cast("double").alias("smoothed"), *others))
    # a position's own row sorts before its calls
    along = Window.partitionBy("chrom", "tile").orderBy("pos", F.col("smoothed").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__m", F.last("smoothed", ignorenulls=True).over(along))
    return carried.where(F.col("smoothed").isNull()).withColumn("residual", F.col("call") - F.col("__m")).drop("smoothed", "__m")


def own_residuals(residuals: DataFrame) -> DataFrame:
    """Each call once, without the layout columns: what operators over regions take."""
    return residuals.where("core").drop("tile", "core") if "core" in residuals.columns else residuals


def call_residuals(calls: DataFrame, smoothed: DataFrame) -> DataFrame:
    """Each call minus the smoothed value of its position."""
    joined = calls.select("cell_id", "chrom", "pos", "call").join(smoothed.select("chrom", "pos", "smoothed"), ["chrom", "pos"])
    return joined.select("cell_id", "chrom", "pos", "call", (F.col("call") - F.col("smoothed")).alias("residual"))


def shrunken_residuals(residuals: DataFrame, regions: DataFrame) -> DataFrame:
    """Per (cell, region): methylated and total sites, fraction, and ``sum(residual) / (n + 1)``."""
    hits = join_sites_to_regions(own_residuals(residuals), regions.select("chrom", "start", "end", "feature_id"))
    sums = hits.groupBy("cell_id", "feature_id").agg(
        F.sum("call").alias("methylated_sites"), F.count("*").alias("total_sites"), F.sum("residual").alias("__r")
    )
    return sums.select(
        "cell_id", "feature_id", "methylated_sites", "total_sites",
        safe_ratio("methylated_sites", "total_sites").alias("methylation_fraction"),
        (F.col("__r") / (F.col("total_sites") + 1)).alias("shrunken_residual"),
    )


def _tiled_windows(residuals: DataFrame, bandwidth: int, step: int, extra: tuple[str, ...], tile: int) -> DataFrame:
    """:func:`_cell_windows` of rows that lie by (chromosome, tile); a window belongs to the tile it starts in."""
    if tile % step:
        raise ValueError("the tile must be a multiple of step")
    span = bandwidth // step
    pane = int_div(F.col("pos") - 1, step).alias("pane")
    panes = residuals.groupBy("cell_id", *extra, "chrom", "tile", pane).agg(
        F.count("*").alias("n"), F.sum("call").alias("meth"), F.sum("residual").alias("r"))
    first = F.greatest(F.col("pane") - (span - 1), F.lit(0).cast("long"))
    windows = panes.withColumn("window", F.explode(F.sequence(first, F.col("pane")))).where(int_div(F.col("window") * step, tile) == F.col("tile"))
    return windows.groupBy("cell_id", *extra, "chrom", "tile", "window").agg(
        F.sum("n").alias("n"), F.sum("meth").alias("meth"), F.sum("r").alias("r")).withColumn("value", F.col("r") / (F.col("n") + 1))


def _cell_windows(residuals: DataFrame, bandwidth: int, step: int, extra: tuple[str, ...] = (), tile: int = SITE_TILE) -> DataFrame:
    """Per (cell, sliding window): calls, methylated calls and shrunken residual.

    Sites are summed into panes of one step; each pane then feeds the ``bandwidth / step`` windows
    that cover it. Rows are placed once by (cell, chromosome, tile of panes), with the few panes
    before a tile edge placed in both tiles; pane and window sums are then local, so the repeated
    pane rows are never shuffled.
    """
    if bandwidth % step:
        raise ValueError("bandwidth must be a multiple of step")
    span = bandwidth // step
    if "tile" in residuals.columns:
        return _tiled_windows(residuals, bandwidth, step, extra, tile)
    tile = max(256, 8 * span)
    rows = residuals.select("cell_id", *extra, "chrom", "call", "residual", int_div(F.col("pos") - 1, step).alias("pane"))
    first = F.greatest(F.col("pane") - (span - 1), F.lit(0).cast("long"))
    placed = rows.withColumn("tile", F.explode(F.sequence(int_div(first, tile), int_div("pane", tile)))).repartition("cell_id", "chrom", "tile")
    panes = placed.groupBy("cell_id", *extra, "chrom", "tile", "pane").agg(
        F.count("*").alias("n"), F.sum("call").alias("meth"), F.sum("residual").alias("r")
    )
    windows = panes.withColumn("window", F.explode(F.sequence(first, F.col("pane")))).where(int_div("window", tile) == F.col("tile"))
    return (
        windows.groupBy("cell_id", *extra, "chrom", "tile", "window")
        .agg(F.sum("n").alias("n"), F.sum("meth").alias("meth"), F.sum("r").alias("r"))
        .withColumn("value", F.col("r") / (F.col("n") + 1))
    )


def window_variance(residuals: DataFrame, *, bandwidth: int = 2000, step: int = 100, min_cells: int = 6, tile: int = SITE_TILE) -> DataFrame:
    """Population variance over cells of the windows' shrunken residuals, for windows with enough cells.

    ``tile`` is that of :func:`tile_calls`, where the residuals lie by tile.
    """
    per_cell = _cell_windows(residuals, bandwidth, step, (), tile)
    # a window has one tile, whose name keeps the rows where they are
    out = per_cell.groupBy("chrom", "tile", "window").agg(
        F.var_pop("value").alias("variance"), F.count("*").alias("n_cells")
    ).where(F.col("n_cells") >= min_cells)
    return out.select(
        "chrom", (F.col("window") * step).alias("start"), (F.col("window") * step + bandwidth).alias("end"), "variance", "n_cells"
    )


def scan_variable_regions(
    residuals: DataFrame, *, bandwidth: int = 2000, step: int = 100, top: float = 0.02, min_cells: int = 6,
    calls: DataFrame | None = None, tile: int = SITE_TILE,
) -> DataFrame:
    """Variable regions: windows at or above the ``1 - top`` variance quantile, overlaps merged.

    With ``calls``, which ``residuals`` were made from, the residuals are derived once; without, the recount reads them again. Output ``chrom, start, end, peak_var, n_cpg, n_obs_cells``; the site and cell numbers are
    recounted over the merged region.
    """
    if not 0 < top <= 1:
        raise ValueError("top must be in (0, 1]")
    # genome / step rows, read for the cutoff and for the merge
    windows = cut_lineage(
        window_variance(residuals, bandwidth=bandwidth, step=step, min_cells=min_cells, tile=tile).withColumn(
            "variance", F.round("variance", 9)
        )
    )
    cutoff = exact_quantiles(windows, [], "variance", [1.0 - top]).select(F.round("quantile", 9)).scalar()
    merged = merge_overlapping(windows.where(F.col("variance") >= cutoff), max_of=["variance"])
    regions = merged.withColumn("feature_id", F.concat_ws("_", "chrom", "start", "end"))
    hits = join_sites_to_regions((own_residuals(residuals) if calls is None else calls).select("cell_id", "chrom", "pos"), regions.select("chrom", "start", "end", "feature_id"))
    # distinct counts copy rows, but only those inside the few merged regions
    seen = hits.groupBy("feature_id").agg(F.count_distinct("pos").alias("n_cpg"), F.count_distinct("cell_id").alias("n_obs_cells"))
    return regions.join(seen, "feature_id").select("chrom", "start", "end", F.col("variance").alias("peak_var"), "n_cpg", "n_obs_cells")


def label_windows(
    residuals: DataFrame, cells: DataFrame, *, bandwidth: int = 2000, step: int = 1000, permute_seed: int | None = None
) -> DataFrame:
    """Per (sample, label, window): cells, sums and squares of cell values, and call totals.

    With ``permute_seed``, each cell's windows count once under its own label and once under its
    permuted one (:func:`permute_labels`), told apart by ``is_real``; sites are summed only once.
    """
    labels = cells.select("cell_id", "sample_id", "cell_type")
    groups = ["sample_id", "cell_type"]
    if permute_seed is not None:
        dealt = permute_labels(labels, permute_seed).withColumnRenamed("cell_type", "permuted_type")
        labels = labels.join(dealt, ["sample_id", "cell_id"])
    extra = tuple(c for c in labels.columns if c != "cell_id")
    tagged = residuals.join(broadcast_if_small(labels, materialize=permute_seed is not None), "cell_id")
    per_cell = _cell_windows(tagged, bandwidth, step, extra)
    if permute_seed is not None:
        either = F.array(
            F.struct(F.lit(True).alias("is_real"), F.col("cell_type")), F.struct(F.lit(False).alias("is_real"), F.col("permuted_type").alias("cell_type"))
        )
        per_cell = per_cell.withColumn("__l", F.explode(either)).drop("cell_type", "permuted_type").select("*", "__l.*")
        groups.append("is_real")
    return per_cell.groupBy(*groups, "chrom", "tile", "window").agg(
        F.count("*").alias("cells"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"),
        F.sum("meth").alias("meth"), F.sum("n").alias("n_sites"),
    )


def compare_windows(windows: DataFrame, *, bandwidth: int = 2000, step: int = 1000, min_cells: int = 6) -> DataFrame:
    """Welch contrast of every label pair in every window both cover with enough cells.

    All comparisons come from one equi-join of the label sums on (sample, chromosome, window), and on
    ``is_real`` where permuted labels are present; the pair test is the residual condition.
    """
    enough = windows.where(F.col("cells") >= min_cells)
    kind = [c for c in ("is_real",) if c in windows.columns]
    side = lambda x: enough.select(
        "sample_id", *kind, "chrom", "window", F.col("cell_type").alias(f"cell_type_{x}"), F.col("cells").alias(f"n_{x}"),
        F.col("s").alias(f"s_{x}"), F.col("q").alias(f"q_{x}"), F.col("meth").alias(f"k_{x}"), F.col("n_sites").alias(f"c_{x}"),
    )
    both = side("a").join(side("b"), ["sample_id", *kind, "chrom", "window"]).where(F.col("cell_type_a") < F.col("cell_type_b"))
    t, df = welch_t(*[F.col(c) for c in ("n_a", "s_a", "q_a", "n_b", "s_b", "q_b")])
    out = both.withColumn("t_stat", t).withColumn("__df", df).where("t_stat is not null and __df > 0")
    return out.select(
        "sample_id", "cell_type_a", "cell_type_b", *kind, "chrom",
        (F.col("window") * step).alias("start"), (F.col("window") * step + bandwidth).alias("end"),
        "t_stat", (F.col("c_a") + F.col("c_b")).alias("n_sites"), "n_a", "n_b",
        safe_ratio("k_a", "c_a").alias("meth_a"), safe_ratio("k_b", "c_b").alias("meth_b"),
        F.when(F.col("t_stat") < 0, "group_A").otherwise("group_B").alias("low_group"),
        student_two_sided(F.col("t_stat"), F.col("__df")).alias("raw_p"),
    )


def diff_methylation(
    contrasts: DataFrame, *, threshold: float = 0.02, bridge_gaps: int = 0
) -> DataFrame:
    """Differential regions: the most extreme windows of each comparison, same-sign neighbours merged.

    A window qualifies when ``|t|`` reaches the ``1 - threshold`` quantile of its comparison. A merged
    region carries the numbers of its most extreme window.

    Where ``contrasts`` holds permuted labels too (``is_real``), their windows must reach the cut of the
    real ones, and ``adj_p`` of a real region is its :func:`empirical_fdr` against the permuted regions
    of the comparison: null when there is none. A comparison with permuted windows only is an error.
    Without permuted labels ``adj_p`` is null.
    """
    keys = ["sample_id", "cell_type_a", "cell_type_b"]
    kind = [c for c in ("is_real",) if c in contrasts.columns]
    w = cut_lineage(contrasts.withColumn("abs_t", F.round(F.abs(F.col("t_stat")), 9)))
    if kind:
        require_empty(comparisons_without_real(w, tuple(keys)), "comparisons without a real window")
    real = w.where("is_real") if kind else w
    cut = exact_quantiles(real, keys, "abs_t", [1.0 - threshold]).select(*keys, F.round("quantile", 9).alias("__cut"))
    hits = w.join(broadcast_if_small(cut, materialize=True), keys).where(F.col("abs_t") >= F.col("__cut"))
    peak = F.struct("abs_t", -F.col("start"), "t_stat", "n_sites", "n_a", "n_b", "meth_a", "meth_b", "raw_p").alias("peak")
    merged = merge_overlapping(
        hits.select(*keys, *kind, "low_group", "chrom", "start", "end", peak), [*keys, *kind, "low_group"], max_of=["peak"], bridge_gaps=bridge_gaps
    ).select(
        *keys, *kind, "chrom", "start", "end", "peak.t_stat", "peak.n_sites", "peak.n_a", "peak.n_b",
        "peak.meth_a", "peak.meth_b", "low_group", "peak.raw_p", "peak.abs_t",
    )
    if kind:
        judged = empirical_fdr(cut_lineage(merged), tuple(keys)).drop("n_real", "n_permuted")
    else:
        judged = merged.withColumn("adj_p", F.lit(None).cast("double"))
    return judged.select(*[c for c in merged.columns if c not in ("is_real", "abs_t")], "adj_p")


def comparison_status(pairs: DataFrame, dmr: DataFrame, min_cells: int = 6) -> DataFrame:
    """Status per label pair: ``ineligible`` (0 rows) when a group is too small, else ``complete``."""
    keys = ["sample_id", "cell_type_a", "cell_type_b"]
    rows = dmr.groupBy(*keys).agg(F.count("*").alias("__rows"))
    small = (F.col("group_a_cells") < min_cells) | (F.col("group_b_cells") < min_cells)
    return pairs.join(rows, keys, "left").select(
        *keys, "comparison", "group_a_cells", "group_b_cells", F.when(small, "ineligible").otherwise("complete").alias("status"),
        F.when(small, F.lit(0)).otherwise(F.coalesce("__rows", F.lit(0))).cast("long").alias("dmr_rows"),
    )


def permute_labels(cells: DataFrame, seed: int = 0) -> DataFrame:
    """Labels dealt out again within each sample, in an order fixed by a hash of cell id and seed."""
    by_id = global_row_number(cells.select("sample_id", "cell_id", "cell_type"), [F.col("cell_id")], "__k", ["sample_id"])
    shuffled = cells.select("sample_id", F.col("cell_id").alias("__donor"), F.md5(F.concat_ws("|", "cell_id", F.lit(str(seed)))).alias("__h"))
    dealt = global_row_number(shuffled, [F.col("__h"), F.col("__donor")], "__k", ["sample_id"])
    return (
        dealt.join(by_id.select("sample_id", "__k", "cell_type"), ["sample_id", "__k"])
        .select(F.col("__donor").alias("cell_id"), "sample_id", "cell_type")
    )


def empirical_fdr(windows: DataFrame, keys: tuple[str, ...] = ("comparison",), score: str = "abs_t") -> DataFrame:
    """``adj_p`` of real windows against permuted ones.

    ``adj_p = min(1, (permuted >= score / permuted) / (real >= score / real))`` per ``keys``. No
    permuted window leaves ``adj_p`` null. ``windows`` carries ``is_real``; no real window at all is
    an error for the caller (:func:`comparisons_without_real`).
    """
    keys_ = list(keys)
    ties = windows.groupBy(*keys_, F.col(score).alias("__s")).agg(
        F.count_if("is_real").cast("long").alias("__real"), F.count_if(~F.col("is_real")).cast("long").alias("__perm")
    )
    blocks = ordered_blocks(ties, [*(F.col(k) for k in keys_), F.desc("__s")])
    order = [F.desc("__s")]
    cum = prefix_sum(blocks, order, "__real", "__r0", keys_)
    cum = prefix_sum(cum, order, "__perm", "__p0", keys_)
    totals = ties.groupBy(*keys_).agg(F.sum("__real").alias("n_real"), F.sum("__perm").alias("n_permuted"))
    tail = cum.join(totals, keys_).select(
        *keys_, F.col("__s").alias(score), "n_real", "n_permuted",
        F.least(F.lit(1.0), F.try_divide(
            F.try_divide((F.col("__p0") + F.col("__perm")).cast("double"), F.col("n_permuted").cast("double")),
            F.try_divide((F.col("__r0") + F.col("__real")).cast("double"), F.col("n_real").cast("double")),
        )).alias("__q"),
    )
    adj = F.when(F.col("n_permuted") > 0, F.col("__q"))
    return windows.where("is_real").join(tail, [*keys_, score]).withColumn("adj_p", adj).drop("__q", "is_real")


def comparisons_without_real(windows: DataFrame, keys: tuple[str, ...] = ("comparison",)) -> DataFrame:
    """Comparisons that have permuted windows only: adjusted values cannot be formed."""
    return windows.groupBy(*keys).agg(F.bool_or("is_real").alias("any_real")).where(~F.col("any_real")).select(*keys)


def hypo_score(counts: DataFrame, *, keep: float = 0.9) -> DataFrame:
    """Hypomethylation score per (cell, bin): ``P(X > mc)``, X ~ Binomial(cov, cell rate).

    The cell rate is its total methylated over total reads in the same bins. Scores below ``keep``
    are dropped.
    """
    # read for the cells' rates and for the scores
    counts = stored(counts)
    rate = counts.groupBy("cell_id").agg(safe_ratio(F.sum("mc"), F.sum("cov")).alias("__rate"))
    rated = counts.join(broadcast_if_small(rate, materialize=True), "cell_id")
    if keep > 0.5:
        # the median of a binomial is its mean rounded up or down: from there on the tail is a half at most
        rated = rated.where(F.col("mc") < F.ceil(F.col("cov") * F.col("__rate")))
    score = binomial_upper_tail(F.col("mc"), F.col("cov"), F.col("__rate"))
    # a filter on the column would be evaluated below it and repeat the tail; a generator keeps both in one place
    return rated.withColumn("score", F.explode(F.filter(F.array(score), lambda x: x >= keep))).drop("__rate")


def hypo_prevalence(scores: DataFrame, cutoff: float = 0.95) -> DataFrame:
    """Cells in which a bin is hypomethylated; bins without any are absent."""
    return scores.where(F.col("score") >= cutoff).groupBy("feature_id").agg(F.count("*").alias("hypo_cells"))

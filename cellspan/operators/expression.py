"""RNA count operators on long tables ``(cell_id, sample_id, gene, count)``.

Zeros are absent rows. Every mean, variance, fraction and rank below brings the zero mass back from
the number of cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspan.functions.columns import has_any_prefix, safe_percent, safe_ratio
from cellspan.plans.bounded import bounded_rows
from cellspan.plans.prefix import ordered_blocks, prefix_sum
from cellspan.plans.quantiles import exact_quantiles
from cellspan.plans.sizes import broadcast_if_small
from cellspan.plans.storage import cut_lineage, stored

MAX_DENSE_GENES = 20_000
TARGET = 1e4


def cell_metrics(counts: DataFrame, mito: Sequence[str] = ("MT-",), ribo: Sequence[str] = ("RPL", "RPS")) -> DataFrame:
    """Genes, total counts, and mitochondrial and ribosomal percentages per cell."""
    share = lambda test: F.sum(F.when(test, F.col("count")).otherwise(0))
    sums = counts.where(F.col("count") > 0).groupBy("cell_id", "sample_id").agg(
        F.count("*").alias("n_genes_by_counts"), F.sum("count").alias("total_counts"),
        share(has_any_prefix("gene", mito)).alias("__mt"), share(has_any_prefix("gene", ribo)).alias("__ribo"),
    )
    return sums.select(
        "cell_id", "sample_id", "n_genes_by_counts", "total_counts",
        safe_percent("__mt", "total_counts").alias("pct_counts_mt"), safe_percent("__ribo", "total_counts").alias("pct_counts_ribo"),
    )


def passes_cell_qc(*, min_genes: int = 200, max_genes: int = 6000, min_counts: int = 500, max_mt: float = 5.0) -> Column:
    g = F.col("n_genes_by_counts")
    return (g >= min_genes) & (g < max_genes) & (F.col("total_counts") >= min_counts) & (F.col("pct_counts_mt") < max_mt)


def cell_qc(metrics: DataFrame, **limits) -> DataFrame:
    return metrics.where(passes_cell_qc(**limits))


def gene_min_cells(counts: DataFrame, min_cells: int = 3) -> DataFrame:
    """Counts of genes seen in at least ``min_cells`` cells of the same sample."""
    seen = counts.where(F.col("count") > 0).groupBy("sample_id", "gene").agg(F.count("*").alias("__n")).where(F.col("__n") >= min_cells)
    seen = broadcast_if_small(seen.select("sample_id", "gene"), materialize=True)
    return counts.join(seen, ["sample_id", "gene"], "left_semi")


def drop_doublets(cells: DataFrame) -> DataFrame:
    return cells.where(~F.col("predicted_doublet"))


def highest_expressed_genes(counts: DataFrame, k: int = 20) -> DataFrame:
    """Top ``k`` genes per sample by the mean over cells of their share (percent) of a cell's counts."""
    per_cell = Window.partitionBy("cell_id")  # one row per gene: bounded
    shares = counts.withColumn("__share", safe_percent("count", F.sum("count").over(per_cell)))
    cells = counts.groupBy("sample_id").agg(F.count_distinct("cell_id").alias("__cells"))
    means = shares.groupBy("sample_id", "gene").agg(F.sum("__share").alias("__s")).join(cells, "sample_id")
    means = means.select("sample_id", "gene", F.round(F.col("__s") / F.col("__cells"), 9).alias("mean_percent"))
    rank = F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("mean_percent"), "gene"))
    return means.withColumn("gene_rank", rank.cast("long")).where(F.col("gene_rank") <= k)


def normalize_log1p(counts: DataFrame, target: float = TARGET) -> DataFrame:
    """``value = ln(1 + count * target / cell total)``; the raw count stays.

    The total is a window over one cell's genes (bounded by the gene number), so one shuffle does it.
    """
    total = F.sum("count").over(Window.partitionBy("cell_id"))
    return counts.withColumn("value", F.log1p(F.col("count") * F.lit(float(target)) / total))


def highly_variable_genes(values: DataFrame, n: int = 2000, *, bins: int = 20) -> DataFrame:
    """Genes by normalised dispersion per sample, combined over samples.

    On ``y = exp(value) - 1`` with all cells counted: dispersion ``ln(var / mean)``, mean ``ln(1 + mean)``
    cut into ``bins`` right-closed equal bins per sample, z-scored within the bin (a single-gene bin
    scores 1). A gene counts for a sample when it is among its best ``n``; genes are ordered by that
    number of samples, then by the mean score over all samples (absent ones add 0), then by name.
    """
    y = F.expm1("value")
    cells = values.groupBy("sample_id").agg(F.count_distinct("cell_id").cast("double").alias("__n"))
    sums = values.groupBy("sample_id", "gene").agg(F.sum(y).alias("__s"), F.sum(y * y).alias("__q")).join(cells, "sample_id")
    mean = F.col("__s") / F.col("__n")
    var = F.greatest((F.col("__q") - F.col("__s") * mean) / (F.col("__n") - 1), F.lit(0.0))
    genes = sums.select("sample_id", "gene", F.log1p(mean).alias("__m"), F.log(F.nullif(var / mean, F.lit(0.0))).alias("__d"))
    per_sample = Window.partitionBy("sample_id")  # one row per gene
    lo, hi = F.min("__m").over(per_sample), F.max("__m").over(per_sample)
    place = F.ceil(F.round((F.col("__m") - lo) / (hi - lo) * bins, 9))
    genes = genes.withColumn("__bin", F.coalesce(F.greatest(F.lit(1), F.least(F.lit(bins), place)), F.lit(1)))
    in_bin = Window.partitionBy("sample_id", "__bin")
    score = F.when(F.count("__d").over(in_bin) == 1, F.when(F.col("__d").isNotNull(), F.lit(1.0))).otherwise(
        F.try_divide(F.col("__d") - F.avg("__d").over(in_bin), F.stddev_samp("__d").over(in_bin))
    )
    scored = genes.withColumn("__z", F.round(score, 9))
    rank = F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc_nulls_last("__z"), "gene"))
    marked = scored.withColumn("__top", (rank <= n) & F.col("__z").isNotNull())
    n_samples = values.agg(F.count_distinct("sample_id")).scalar()
    combined = marked.groupBy("gene").agg(
        F.count_if("__top").alias("n_samples"), F.coalesce(F.sum("__z"), F.lit(0.0)).alias("__sum")
    ).withColumn("score", F.round(F.col("__sum") / n_samples, 6))
    keys = [F.desc("n_samples"), F.desc("score"), F.asc("gene")]
    top = combined.orderBy(*keys).limit(n)
    return top.select("gene", "n_samples", "score", F.row_number().over(Window.orderBy(*keys)).cast("long").alias("gene_rank"))


def gene_moments(values: DataFrame, cells: DataFrame) -> DataFrame:
    """Mean and sample deviation of every gene over all ``cells``, zeros included."""
    n = cells.agg(F.count_distinct("cell_id").cast("double")).scalar()
    sums = values.groupBy("gene").agg(F.sum("value").alias("__s"), F.sum(F.col("value") * F.col("value")).alias("__q"))
    sums = sums.withColumn("__n", n)
    mean = F.col("__s") / F.col("__n")
    return sums.select("gene", mean.alias("mean"), F.sqrt(F.greatest((F.col("__q") - F.col("__s") * mean) / (F.col("__n") - 1), F.lit(0.0))).alias("sd"))


def _sparse_rows(values: DataFrame, cells: DataFrame, names: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Per cell: positions and values of its non-zero genes among ``names`` (which are few and sorted)."""
    index = values.sparkSession.createDataFrame([(g, i) for i, g in enumerate(names)], "gene string, __i int")
    rows = values.join(index, "gene").groupBy("cell_id").agg(F.collect_list(F.struct("__i", "value")).alias("__e"))
    base = cells.select("cell_id", *carry)
    return base.join(rows, "cell_id", "left").select("cell_id", *carry, F.col("__e.__i").alias("__at"), F.col("__e.value").alias("__v"))


def scale_genes(values: DataFrame, cells: DataFrame, genes: DataFrame, *, max_value: float = 10.0) -> DataFrame:
    """Dense scaled vector per cell over ``genes`` in name order: centred, unit variance, capped above.

    The gene list is the selected set (bounded); only its moments reach the driver.
    """
    # the chosen rows are read for the moments and again for the vectors
    kept = cut_lineage(values.join(broadcast_if_small(genes.select("gene"), materialize=True), "gene", "left_semi").select("cell_id", "gene", "value"))
    stats = sorted(bounded_rows(gene_moments(kept, cells), MAX_DENSE_GENES, "genes to scale"), key=lambda r: r["gene"])
    names = [r["gene"] for r in stats]
    mean = np.array([r["mean"] for r in stats])
    sd = np.array([r["sd"] or 1.0 for r in stats])

    def dense(batches):
        for pdf in batches:
            out = []
            for at, v in zip(pdf["__at"], pdf["__v"]):
                x = np.zeros(len(mean))
                if at is not None:
                    x[np.asarray(at)] = v
                out.append(np.minimum((x - mean) / sd, max_value))
            yield pd.DataFrame({"cell_id": pdf["cell_id"], "vec": out})

    return _sparse_rows(kept, cells, names).mapInPandas(dense, "cell_id string, vec array<double>")


def packed_cells(counts: DataFrame) -> DataFrame:
    """One stored row per cell, its counts in ``genes``: what follows about single cells needs no exchange and little disk."""
    return stored(counts.groupBy("cell_id", "sample_id").agg(F.collect_list(F.struct("gene", "count")).alias("genes")))


def unpacked(packed: DataFrame, *carry: str) -> DataFrame:
    """The long rows of :func:`packed_cells`."""
    return packed.select("cell_id", "sample_id", *carry, F.explode("genes").alias("__g")).select("cell_id", "sample_id", *carry, "__g.gene", "__g.count")


def packed_totals(packed: DataFrame) -> DataFrame:
    return packed.withColumn("total", F.aggregate("genes", F.lit(0.0), lambda a, g: a + g["count"]))


def packed_values(packed: DataFrame) -> DataFrame:
    """:func:`normalize_log1p` of packed cells with their ``total``, as long rows."""
    return unpacked(packed, "total").withColumn("value", F.log1p(F.col("count") * F.lit(TARGET) / F.col("total"))).drop("total")


def packed_gene_min_cells(packed: DataFrame, min_cells: int = 3) -> DataFrame:
    """:func:`gene_min_cells` of packed cells. Only cells that hold a rare gene are looked at; cells without any gene left go."""
    lines = unpacked(packed)
    rare = lines.groupBy("sample_id", "gene").agg(F.count_if(F.col("count") > 0).alias("__n")).where(F.col("__n") < min_cells).select("sample_id", "gene")
    rare = cut_lineage(rare)
    if rare.isEmpty():
        return packed
    lost = lines.join(broadcast_if_small(rare), ["sample_id", "gene"], "left_semi").groupBy("cell_id", "sample_id").agg(F.collect_set("gene").alias("__lost"))
    left = F.filter("genes", lambda g: ~F.array_contains("__lost", g["gene"]))
    kept = packed.join(broadcast_if_small(lost, materialize=True), ["cell_id", "sample_id"], "left")
    return kept.withColumn("genes", F.when(F.col("__lost").isNull(), F.col("genes")).otherwise(left)).drop("__lost").where(F.size("genes") > 0)


def chosen_counts(packed: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(cell_id, sample_id, total, at array<int>, n array<double>)``: each cell's counts of ``names``, by their place there."""
    names = list(names)

    def pick(batches):
        for batch in batches:
            genes = batch.column("genes")
            flat, sizes = genes.flatten(), pc.fill_null(pc.list_value_length(genes), 0).to_numpy(zero_copy_only=False)
            gene = pc.struct_field(flat, "gene")
            at = pc.fill_null(pc.index_in(gene, value_set=pa.array(names, gene.type)), -1).to_numpy(zero_copy_only=False)
            n = pc.struct_field(flat, "count").to_numpy(zero_copy_only=False).astype(float)
            starts = np.append(0, np.cumsum(np.bincount(np.repeat(np.arange(len(sizes)), sizes)[at >= 0], minlength=len(sizes)))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(starts), pa.array(x[at >= 0])) for x in (at.astype(np.int32), n)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cell_id", "sample_id", "total")), *lists], ["cell_id", "sample_id", "total", "at", "n"])

    types = dict(packed.dtypes)
    return packed.select("cell_id", "sample_id", "total", "genes").mapInArrow(
        pick, f"cell_id {types['cell_id']}, sample_id {types['sample_id']}, total double, at array<int>, n array<double>")


def scale_rows(rows: DataFrame, width: int, *, max_value: float = 10.0) -> DataFrame:
    """:func:`scale_genes` of sparse ``rows`` ``(cell_id, ..., total, at, n)``, which should be stored: ``vec`` in the place of the counts."""
    rows = rows.withColumn("v", F.transform("n", lambda x: F.log1p(x * F.lit(TARGET) / F.col("total")))).drop("n", "total")
    cells = rows.count()
    entries = rows.select(F.explode(F.arrays_zip("at", "v")).alias("e"))
    sums = entries.groupBy("e.at").agg(F.sum("e.v").alias("s"), F.sum(F.col("e.v") * F.col("e.v")).alias("q"))
    mean, sd = np.zeros(width), np.ones(width)
    for r in bounded_rows(sums, width, "genes to scale"):
        mean[r["at"]] = r["s"] / cells
        sd[r["at"]] = np.sqrt(max((r["q"] - r["s"] * mean[r["at"]]) / (cells - 1), 0.0)) or 1.0 if cells > 1 else 1.0
    others = [c for c in rows.columns if c not in ("at", "v")]
    types = dict(rows.dtypes)

    def dense(batches):
        for pdf in batches:
            if len(pdf):
                x = np.zeros((len(pdf), width))
                x[np.repeat(np.arange(len(pdf)), [len(a) for a in pdf["at"]]), np.concatenate(pdf["at"].to_list())] = np.concatenate(pdf["v"].to_list())
                yield pdf[others].assign(vec=list(np.minimum((x - mean) / sd, max_value)))

    return rows.mapInPandas(dense, ", ".join([f"{c} {types[c]}" for c in others] + ["vec array<double>"]))


def regression_coefficients(values: DataFrame, cells: DataFrame, covariates: Sequence[str] = ("total_counts", "pct_counts_mt")) -> DataFrame:
    """Least squares of every gene on two centred covariates, from cross products only.

    Zero values add nothing to the gene sums, so only non-zero rows are read; the covariate moments
    come from all cells. A singular pair falls back to the first covariate alone.
    """
    a, b = covariates
    x = cells.select("cell_id", F.col(a).cast("double").alias("__a"), F.col(b).cast("double").alias("__b"))
    moments = x.agg(
        F.count("*").cast("double").alias("n"), F.avg("__a").alias("ma"), F.avg("__b").alias("mb"),
        F.sum(F.col("__a") * F.col("__a")).alias("aa"), F.sum(F.col("__b") * F.col("__b")).alias("bb"), F.sum(F.col("__a") * F.col("__b")).alias("ab"),
    )
    m = bounded_rows(moments, 1, "covariate moments")[0]
    n, ma, mb = m["n"], m["ma"], m["mb"]
    saa, sbb, sab = m["aa"] - n * ma * ma, m["bb"] - n * mb * mb, m["ab"] - n * ma * mb
    det = saa * sbb - sab * sab
    sums = values.join(broadcast_if_small(x), "cell_id").groupBy("gene").agg(
        F.sum("value").alias("__y"), F.sum(F.col("value") * (F.col("__a") - ma)).alias("__ya"), F.sum(F.col("value") * (F.col("__b") - mb)).alias("__yb")
    )
    if det > 1e-9 * max(saa * sbb, 1e-300):
        beta_a = (F.lit(sbb) * F.col("__ya") - F.lit(sab) * F.col("__yb")) / F.lit(det)
        beta_b = (F.lit(saa) * F.col("__yb") - F.lit(sab) * F.col("__ya")) / F.lit(det)
    else:
        beta_a = F.col("__ya") / F.lit(saa) if saa > 0 else F.lit(0.0)
        beta_b = F.lit(0.0)
    return sums.select("gene", (F.col("__y") / n).alias("mean"), beta_a.alias("beta_a"), beta_b.alias("beta_b"), F.lit(ma).alias("mean_a"), F.lit(mb).alias("mean_b"))


def regress_out(values: DataFrame, cells: DataFrame, genes: DataFrame, covariates: Sequence[str] = ("total_counts", "pct_counts_mt")) -> DataFrame:
    """Dense residual vector per cell over ``genes`` in name order."""
    a, b = covariates
    kept = cut_lineage(values.join(broadcast_if_small(genes.select("gene"), materialize=True), "gene", "left_semi").select("cell_id", "gene", "value"))
    fits = sorted(bounded_rows(regression_coefficients(kept, cells, covariates), MAX_DENSE_GENES, "genes to regress"), key=lambda r: r["gene"])
    names = [r["gene"] for r in fits]
    mean, ba, bb = (np.array([r[c] for r in fits]) for c in ("mean", "beta_a", "beta_b"))
    ma, mb = (fits[0]["mean_a"], fits[0]["mean_b"]) if fits else (0.0, 0.0)

    def residual(batches):
        for pdf in batches:
            out = []
            for at, v, xa, xb in zip(pdf["__at"], pdf["__v"], pdf[a], pdf[b]):
                y = np.zeros(len(mean))
                if at is not None:
                    y[np.asarray(at)] = v
                out.append(y - mean - ba * (xa - ma) - bb * (xb - mb))
            yield pd.DataFrame({"cell_id": pdf["cell_id"], "vec": out})

    return _sparse_rows(kept, cells, names, carry=covariates).mapInPandas(residual, "cell_id string, vec array<double>")


def cluster_qc(cells: DataFrame, cluster: str, metrics: Sequence[str]) -> DataFrame:
    """Cells and the exact median of each metric per cluster."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    long = cells.select(cluster, F.explode(pairs).alias("m")).select(cluster, "m.*")
    med = exact_quantiles(long, [cluster, "metric"], "value", [0.5]).groupBy(cluster).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("quantile"))).alias(f"median_{m}") for m in metrics]
    )
    return cells.groupBy(cluster).agg(F.count("*").alias("cells")).join(med, cluster)


def _panel_frame(spark, panels: Mapping[str, Sequence[str]]) -> DataFrame:
    return spark.createDataFrame([(p, g) for p, genes in panels.items() for g in dict.fromkeys(genes)], "panel string, gene string")


def group_gene_means(values: DataFrame, groups: DataFrame, genes: DataFrame, group: str = "cluster") -> DataFrame:
    """Every (group, gene): fraction of cells above zero and mean over all cells of the group.

    ``groups`` maps ``cell_id`` to ``group``. Genes without any value are dropped; a gene silent in
    one group still gets its zero row there.
    """
    kept = values.join(broadcast_if_small(genes.select("gene").distinct()), "gene", "left_semi")
    sizes = groups.groupBy(group).agg(F.count("*").alias("__size"))
    sums = kept.join(broadcast_if_small(groups.select("cell_id", group)), "cell_id").groupBy(group, "gene").agg(
        F.sum("value").alias("__s"), F.count_if(F.col("value") > 0).alias("__k")
    )
    all_groups = sizes.agg(F.collect_list(F.struct(group, "__size"))).scalar()
    grid = kept.select("gene").distinct().withColumn("__g", F.explode(all_groups)).select("gene", f"__g.{group}", "__g.__size")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return grid.join(sums, ["gene", group], "left").select(
        group, "gene", (zero("__k") / F.col("__size")).alias("fraction"), (zero("__s") / F.col("__size")).alias("mean_value")
    )


def dotplot_stats(values: DataFrame, groups: DataFrame, genes: DataFrame, group: str = "cluster", only: Sequence[str] | None = None) -> DataFrame:
    """:func:`group_gene_means` restricted to some groups (rare or lineage panels)."""
    kept = groups if only is None else groups.where(F.col(group).isin(*only))
    return group_gene_means(values, kept, genes, group)


def rank_genes_wilcoxon(values: DataFrame, groups: DataFrame, group: str = "cluster") -> DataFrame:
    """One-versus-rest rank-sum z per (group, gene) on the values of all cells, no tie correction.

    Only non-zero values are ranked: all zeros of a gene share the mean rank ``(z + 1) / 2`` and lift
    every other rank by ``z``. Equal values collapse to one row and ranks come from a blocked prefix
    sum, so a gene seen in every cell does not fall into one task.
    """
    sizes = groups.groupBy(group).agg(F.count("*").cast("double").alias("__size"))
    total = groups.agg(F.count("*").cast("double")).scalar()
    seen = values.where(F.col("value") > 0).join(broadcast_if_small(groups.select("cell_id", group)), "cell_id").groupBy("gene", "value", group).agg(F.count("*").alias("__c"))
    by_value = seen.groupBy("gene", "value").agg(F.sum("__c").alias("__n"), F.collect_list(F.struct(group, "__c")).alias("__who"))
    blocks = ordered_blocks(by_value, [F.col("gene"), F.col("value")])
    ranked = prefix_sum(blocks, [F.col("value")], "__n", "__before", ["gene"])
    nonzero = blocks.groupBy("gene").agg(F.sum("__n").alias("__nz"))
    mid = F.col("__before") + (F.col("__n") + 1) / 2
    sums = ranked.withColumn("__mid", mid).select("gene", "__mid", F.explode("__who").alias("w")).groupBy("gene", F.col(f"w.{group}").alias(group)).agg(
        F.sum(F.col("__mid") * F.col("w.__c")).alias("__r"), F.sum("w.__c").alias("__k")
    )
    all_groups = sizes.agg(F.collect_list(F.struct(group, "__size"))).scalar()
    grid = nonzero.withColumn("__t", total).withColumn("__g", F.explode(all_groups)).select("gene", "__nz", "__t", f"__g.{group}", "__g.__size")
    zeros = F.col("__t") - F.col("__nz")
    k = F.coalesce(F.col("__k"), F.lit(0))
    rank_sum = F.coalesce(F.col("__r"), F.lit(0.0)) + k * zeros + (F.col("__size") - k) * (zeros + 1) / 2
    n1, n = F.col("__size"), F.col("__t")
    z = F.try_divide(rank_sum - n1 * (n + 1) / 2, F.sqrt(n1 * (n - n1) * (n + 1) / 12))
    return grid.join(sums, ["gene", group], "left").select(group, "gene", rank_sum.alias("rank_sum"), z.alias("score"))


def top_markers(ranked: DataFrame, k: int, group: str = "cluster") -> DataFrame:
    """First ``k`` genes per group by score (ties by name)."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), "gene"))
    return ranked.withColumn("marker_rank", rank.cast("long")).where(F.col("marker_rank") <= k)


def panel_scores(values: DataFrame, groups: DataFrame, panels: Mapping[str, Sequence[str]], group: str = "cluster") -> DataFrame:
    """Mean over a panel's genes of the group mean's z across groups (population deviation; no spread gives 0)."""
    panel = _panel_frame(values.sparkSession, panels)
    means = group_gene_means(values, groups, panel, group)
    across = Window.partitionBy("gene")  # one row per group
    sd = F.stddev_pop("mean_value").over(across)
    z = F.when(sd > 1e-12, (F.col("mean_value") - F.avg("mean_value").over(across)) / sd).otherwise(0.0)
    return means.withColumn("__z", z).join(panel, "gene").groupBy(group, "panel").agg(F.avg("__z").alias("score"))


def top_two_margin(scores: DataFrame, min_margin: float = 0.2, group: str = "cluster", digits: int = 9) -> DataFrame:
    """Best and second panel per group; ``proposed`` when the margin is large enough, else ``Unassigned``."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(F.round("score", digits)), "panel"))
    two = scores.withColumn("__k", rank).where("__k <= 2")
    at = lambda c, k: F.max(F.when(F.col("__k") == k, F.col(c)))
    out = two.groupBy(group).agg(
        at("panel", 1).alias("top_candidate"), at("panel", 2).alias("second_candidate"),
        at("score", 1).alias("top_score"), at("score", 2).alias("second_score"),
    )
    out = out.withColumn("score_margin", F.col("top_score") - F.col("second_score"))
    good = F.round("score_margin", digits) >= min_margin
    return out.withColumn("status", F.when(good, "proposed").otherwise("ambiguous")).withColumn(
        "proposed_cell_type", F.when(good, F.col("top_candidate")).otherwise("Unassigned")
    )


def annotation_audit(groups: DataFrame, markers: DataFrame, margins: DataFrame | None = None, group: str = "cluster") -> DataFrame:
    """Per cluster: cells, proposal and status, candidates with scores, and its top markers as text.

    Without panels every cluster is ``Unassigned`` / ``pending_annotation_review``.
    """
    sizes = groups.groupBy(group).agg(F.count("*").alias("cells"))
    text = markers.groupBy(group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("marker_rank", "gene"))), lambda x: x["gene"]), ",").alias("top_markers")
    )
    out = sizes.join(text, group, "left")
    if margins is None:
        return out.withColumn("proposed_cell_type", F.lit("Unassigned")).withColumn("status", F.lit("pending_annotation_review"))
    return out.join(margins, group, "left")


def expected_doublet_rate(cells: DataFrame, rate_per_1000: float = 0.004, min_cells: int = 100) -> DataFrame:
    """Expected doublet share per sample: ``rate * cells / 1000``; too few cells is an error."""
    n = cells.groupBy("sample_id").agg(F.count("*").alias("cells"))
    error = F.raise_error(F.concat(F.lit("too few cells after QC in sample "), F.col("sample_id"))).cast("double")
    return n.withColumn("expected_doublet_rate", F.when(F.col("cells") < min_cells, error).otherwise(safe_ratio(F.lit(rate_per_1000) * F.col("cells"), F.lit(1000.0))))

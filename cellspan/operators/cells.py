"""Cell tables: selection, annotation, QC, funnels and label rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspan.functions.columns import (
    STRICT_PLACEHOLDERS, is_placeholder, is_truthy, safe_ratio, sanitize_label,
)
from cellspan.plans.guards import Guard, ListedIds
from cellspan.plans.sizes import broadcast_if_small


def split_cell_id(cells: DataFrame, column: str = "cell_id") -> DataFrame:
    """``sample_id`` and ``barcode`` around the first ``_``; without one the sample is ``NA``."""
    c = F.col(column)
    has = F.contains(c, F.lit("_"))
    parts = F.split(c, "_", 2)
    return cells.withColumn("sample_id", F.when(has, parts[0]).otherwise("NA")).withColumn(
        "barcode", F.when(has, parts[1]).otherwise(c)
    )


def drop_placeholder_labels(cells: DataFrame, column: str = "cell_type", mode: str = "canonical") -> DataFrame:
    return cells.where(F.col(column).isNotNull() & ~is_placeholder(column, mode))


def included_samples(samples: DataFrame, root: str = "allc_root") -> DataFrame:
    """Samples whose include flag is set and that name an input root."""
    return samples.where(is_truthy("include") & (F.length(F.trim(F.coalesce(F.col(root), F.lit("")))) > 0))


def select_cells(
    cells: DataFrame, annotation: DataFrame, *, approved: bool, exclude: str = "NA"
) -> DataFrame:
    """Left join to the annotation with a ``reason`` for every cell that is not selected.

    Not approved: every cell is kept as ``Unassigned``. The excluded-label reason carries the
    configured label, whichever placeholder matched.
    """
    extra = [c for c in ("leiden", "cohort", "sample") if c in annotation.columns]
    base = cells.select("cell_id", "sample_id")
    if not approved:
        joined = base.withColumn("rna_cell_type", F.lit("Unassigned")).withColumn("reason", F.lit(None).cast("string"))
        for c in ("leiden", "cohort", "sample"):
            joined = joined.withColumn(f"rna_{c}", F.lit(""))
        return joined
    notes = annotation.select(
        "cell_id", F.trim(F.coalesce("cell_type", F.lit(""))).alias("rna_cell_type"),
        *[F.coalesce(F.col(c), F.lit("")).alias(f"rna_{c}") for c in extra], F.lit(True).alias("__seen"),
    )
    for c in ("leiden", "cohort", "sample"):
        if c not in extra:
            notes = notes.withColumn(f"rna_{c}", F.lit(""))
    barred = {exclude, *STRICT_PLACEHOLDERS}
    # The reason texts.
    reason = (
        F.when(F.col("__seen").isNull(), "not_in_scanpy")
        .when(F.col("rna_cell_type") == "", "missing_scanpy_cell_type")
        .when(F.col("rna_cell_type").isin(*sorted(barred)), f"excluded_scanpy_cell_type_{exclude}")
    )
    return base.join(notes, "cell_id", "left").withColumn("reason", reason).drop("__seen")


def selected(selection: DataFrame) -> DataFrame:
    return selection.where(F.col("reason").isNull()).drop("reason")


def excluded(selection: DataFrame) -> DataFrame:
    return selection.where(F.col("reason").isNotNull()).select("cell_id", "sample_id", "reason")


def selection_summary(selection: DataFrame) -> DataFrame:
    """Per sample: discovered, selected and excluded cells; ``selected_cells = 0`` is an error upstream."""
    return selection.groupBy("sample_id").agg(
        F.count("*").alias("discovered_cells"),
        F.count_if(F.col("reason").isNull()).alias("selected_cells"),
        F.count_if(F.col("reason").isNotNull()).alias("excluded_cells"),
    )


def guarded_summary(selection: DataFrame) -> Guard:
    """:func:`selection_summary`; a sample without a selected cell is an error."""
    return Guard(selection_summary(selection), "cell selection", {"no cell selected": F.col("selected_cells") == 0}, ["sample_id", "discovered_cells"])


def exclusion_counts(selection: DataFrame) -> DataFrame:
    return excluded(selection).groupBy("reason").agg(F.count("*").alias("cells"))


def restrict_to_cells(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose cell is listed in ``ids``."""
    return df.join(broadcast_if_small(ids.select("cell_id").distinct()), "cell_id", "left_semi")


def guarded_restriction(df: DataFrame, ids: DataFrame) -> tuple[DataFrame, ListedIds]:
    """:func:`restrict_to_cells` and the guard that listed cells are unique and all occur in ``df``."""
    listed = ListedIds(df, ids.select("cell_id"), "cell_id", "cell list")
    kept = df.join(broadcast_if_small(listed.ids.select("cell_id", "__number")), "cell_id")
    return listed.watch(kept), listed


def restriction_problems(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Listed cells that are repeated in the list or absent from ``df``."""
    counted = ids.groupBy("cell_id").agg(F.count("*").alias("copies"))
    seen = df.select("cell_id").distinct().withColumn("__seen", F.lit(True))
    return (
        counted.join(seen, "cell_id", "left")
        .withColumn("problem", F.when(F.col("copies") > 1, "duplicate").when(F.col("__seen").isNull(), "missing"))
        .where(F.col("problem").isNotNull())
        .select("cell_id", "problem")
    )


def annotate_obs(cells: DataFrame, annotation: DataFrame) -> DataFrame:
    """Cell metadata with the fallback chain: label ``Unknown``, sample from the id prefix, cohort from sample."""
    label = "cell_type" if "cell_type" in annotation.columns else "manual_celltype"
    text = lambda c: F.col(c) if c in annotation.columns else F.lit(None).cast("string")
    notes = annotation.select(
        "cell_id", F.col(label).alias("__label"), text("sample").alias("__sample"), text("cohort").alias("__cohort")
    )
    prefix = F.split("cell_id", "_", 2)[0]
    out = cells.select("cell_id").join(notes, "cell_id", "left")
    out = out.withColumn("cell_type", F.coalesce("__label", F.lit("Unknown")))
    out = out.withColumn("manual_celltype", F.col("cell_type"))
    out = out.withColumn("sample_id", F.coalesce("__sample", prefix))
    out = out.withColumn("condition", F.coalesce("__cohort", "sample_id")).withColumn("cohort", F.col("condition"))
    return out.drop("__label", "__sample", "__cohort")


def meth_cell_filter(qc: DataFrame, *, min_sites: int = 300_000, min_pct: float = 50.0, max_pct: float = 100.0) -> DataFrame:
    """Cells with enough covered sites and a mean methylation percentage in the closed range."""
    pct = F.col("mean_pct")
    return qc.where((F.col("n_sites") >= min_sites) & (pct >= min_pct) & (pct <= max_pct))


def meth_cell_stats(calls: DataFrame) -> DataFrame:
    """Per cell: called sites and mean methylation percentage over binary calls."""
    return calls.groupBy("cell_id").agg(
        F.count("*").alias("n_sites"), (F.lit(100.0) * F.sum("call") / F.count("*")).alias("mean_pct")
    )


def label_pairs(cells: DataFrame, pool_as: str | None = None, label: str = "cell_type") -> DataFrame:
    """All unordered label pairs ``a < b`` within a sample (or one pooled label), with cell counts."""
    sample = F.lit(pool_as) if pool_as else F.col("sample_id")
    usable = cells.where(F.col(label).isNotNull() & ~is_placeholder(F.trim(F.col(label)), "strict") & (F.trim(label) != ""))
    counts = (
        usable.select(sample.alias("sample_id"), F.trim(label).alias("label"), "cell_id").distinct()
        .groupBy("sample_id", "label").agg(F.count("*").alias("n"))
    )
    return _paired(counts)


def _paired(counts: DataFrame) -> DataFrame:
    a = counts.select("sample_id", F.col("label").alias("cell_type_a"), F.col("n").alias("group_a_cells"))
    b = counts.select("sample_id", F.col("label").alias("cell_type_b"), F.col("n").alias("group_b_cells"))
    # the grouped label table is tiny: one row per (sample, cell type)
    return (
        a.join(b, "sample_id").where(F.col("cell_type_a") < F.col("cell_type_b"))
        .withColumn("comparison", F.concat(sanitize_label("cell_type_a"), F.lit("_vs_"), sanitize_label("cell_type_b")))
    )


def guarded_pairs(cells: DataFrame, pool_as: str | None = None, label: str = "cell_type") -> tuple[DataFrame, Guard]:
    """:func:`label_pairs`, and the guard that every sample has two labels or more to compare.

    Cells without a usable label still count as their sample, so a sample that lost all its labels is told as well.
    """
    sample = F.lit(pool_as) if pool_as else F.col("sample_id")
    usable = F.col(label).isNotNull() & ~is_placeholder(F.trim(F.col(label)), "strict") & (F.trim(label) != "")
    # one grouping of the cells serves the guard and both sides of the pairs
    counts = (
        cells.select(sample.alias("sample_id"), F.when(usable, F.trim(label)).alias("label"), "cell_id").distinct()
        .groupBy("sample_id", "label").agg(F.count("*").alias("n"))
    )
    samples = counts.groupBy("sample_id").agg(F.count("label").alias("labels"))
    guard = Guard(samples, "label pairs", {"fewer than two labels": F.col("labels") < 2}, ["sample_id", "labels"])
    # an outer join: the guard's side is never skipped, even when no pair is left
    pairs = guard.watched.select("sample_id").join(_paired(counts.where("label is not null")), "sample_id", "left").where("comparison is not null")
    return pairs, guard


def samples_with_one_label(cells: DataFrame, label: str = "cell_type") -> DataFrame:
    """Samples that cannot be compared: fewer than two usable labels."""
    usable = cells.where(F.col(label).isNotNull() & ~is_placeholder(F.trim(F.col(label)), "strict"))
    return usable.groupBy("sample_id").agg(F.countDistinct(F.trim(label)).alias("labels")).where("labels < 2")


def sanitize_collisions(cells: DataFrame, label: str = "cell_type") -> DataFrame:
    """Sanitized labels that more than one original label maps to, per sample."""
    return (
        cells.select("sample_id", label).distinct()
        .groupBy("sample_id", sanitize_label(label).alias("safe_label"))
        .agg(F.count("*").alias("labels")).where("labels > 1")
    )


def reconcile_ids(a: DataFrame, b: DataFrame, key: str = "cell_id") -> DataFrame:
    """Ids on one side only: ``missing`` from ``b`` or ``extra`` in ``b``."""
    left = a.select(key).distinct().withColumn("__a", F.lit(True))
    right = b.select(key).distinct().withColumn("__b", F.lit(True))
    return (
        left.join(right, key, "full_outer")
        .withColumn("status", F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "extra"))
        .where(F.col("status").isNotNull()).select(key, "status")
    )


def modality_overlap(annotation: DataFrame, meth_cells: DataFrame) -> DataFrame:
    """Annotated labels counted over cells that also have methylation input."""
    shared = annotation.join(meth_cells.select("cell_id").distinct(), "cell_id", "left_semi")
    label = F.trim("cell_type")
    return shared.where(F.length(label) > 0).groupBy(label.alias("cell_type")).agg(F.count("*").alias("cells"))


def eligible_labels(label_counts: DataFrame, min_cells: int = 6) -> DataFrame:
    return label_counts.where(F.col("cells") >= min_cells)


def labels_ready(label_counts: DataFrame, min_cells: int = 6) -> DataFrame:
    """One row: eligible labels, placeholder labels, and whether a comparison may start."""
    return label_counts.agg(
        F.count_if(F.col("cells") >= min_cells).alias("eligible_labels"),
        F.count_if(is_placeholder("cell_type", "strict")).alias("placeholder_labels"),
    ).withColumn("ready", (F.col("eligible_labels") >= 2) & (F.col("placeholder_labels") == 0))


def stage_funnel(stages: Sequence[tuple[str, DataFrame]], sample: str = "sample_id") -> DataFrame:
    """Cells per (sample, stage), with the retained share of the first and of the previous stage."""
    names = [name for name, _ in stages]
    stacked = None
    for i, (name, cells) in enumerate(stages):
        one = cells.groupBy(sample).agg(F.count("*").alias("cells")).withColumn("step", F.lit(i)).withColumn("stage", F.lit(name))
        stacked = one if stacked is None else stacked.unionByName(one)
    # pivot over the declared stage names keeps zero counts visible
    wide = stacked.groupBy(sample).agg(
        *[F.coalesce(F.sum(F.when(F.col("step") == i, F.col("cells"))), F.lit(0)).alias(f"__s{i}") for i in range(len(names))]
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(f"__s{i}").alias("cells"),
            safe_ratio(f"__s{i}", "__s0").alias("fraction_of_first"),
            safe_ratio(f"__s{i}", f"__s{max(i - 1, 0)}").alias("fraction_of_previous"),
        )
        for i, name in enumerate(names)
    ])
    return wide.select(sample, F.explode(rows).alias("r")).select(sample, "r.*")


def crosstab(df: DataFrame, rows: str, columns: str, *, normalize: bool = False) -> DataFrame:
    """Long cross-table; ``fraction`` is the share of the row total when normalised."""
    counts = df.groupBy(rows, columns).agg(F.count("*").alias("cells"))
    if not normalize:
        return counts
    totals = counts.groupBy(rows).agg(F.sum("cells").alias("__total"))
    return counts.join(totals, rows).withColumn("fraction", safe_ratio("cells", "__total")).drop("__total")


def majority_label(df: DataFrame, cluster: str, label: str = "cell_type") -> DataFrame:
    """Most frequent label per cluster (ties by name), cluster size and number of labels."""
    counts = df.groupBy(cluster, label).agg(F.count("*").alias("n"))
    return counts.groupBy(cluster).agg(
        F.sum("n").alias("cells"),
        F.count("*").alias("n_labels"),
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("proposed_cell_type"),
    )


def label_codes(df: DataFrame, label: str = "cell_type") -> DataFrame:
    """Codes 0..n-1 by label name; placeholders get -1; fewer than two labels gives -1 throughout."""
    clean = F.trim(F.coalesce(F.col(label), F.lit("Unknown")))
    base = df.withColumn("__label", clean)
    real = base.where(~is_placeholder("__label")).select("__label").distinct()
    numbered = real.withColumn("code", (F.dense_rank().over(Window.orderBy("__label")) - 1).cast("long"))
    usable = numbered.where(numbered.agg(F.count("*")).scalar() >= 2)
    return base.join(usable, "__label", "left").withColumn("code", F.coalesce("code", F.lit(-1).cast("long"))).drop("__label")


def balanced_sample(cells: DataFrame, n: int, cohort: str = "sample_id", key: str = "cell_id") -> DataFrame:
    """Round-robin over cohorts in name order, first-come by ``key`` inside a cohort, cut at ``n``."""
    turn = F.row_number().over(Window.partitionBy(cohort).orderBy(key))
    # only the first n turns of a cohort can be used: the rank limit is pushed below the shuffle
    return cells.withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", cohort).limit(n)


def first_n_cells(cells: DataFrame, n: int, key: str = "cell_id") -> DataFrame:
    """Bounded trial subset in id order."""
    return cells.orderBy(key).limit(n)


def union_samples(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack long tables; absent columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def guarded_union(frames: Sequence[DataFrame], summarise: Callable[[DataFrame], DataFrame]) -> Guard:
    """``summarise`` of the stacked frames, one row per ``cell_id``; a cell that two frames bring is an error.

    The frame of a row rides along in the grouping that ``summarise`` makes, a struct key, so the frames are read once: a
    cell of two frames comes out of it twice.
    """
    stacked = union_samples([f.withColumn("cell_id", F.struct(F.col("cell_id").alias("id"), F.lit(i).alias("frame"))) for i, f in enumerate(frames)])
    per_frame = summarise(stacked)
    others = [c for c in per_frame.columns if c != "cell_id"]
    copies = F.count(F.lit(1)).over(Window.partitionBy("cell_id.id"))
    rows = per_frame.withColumn("__frames", copies).select(F.col("cell_id.id").alias("cell_id"), *others, "__frames")
    guard = Guard(rows, "stacked samples", {"a cell of several samples": F.col("__frames") > 1}, ["cell_id"])
    guard.watched = guard.watched.drop("__frames")
    return guard

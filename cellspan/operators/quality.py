"""Checks. Each returns the offending rows (or a one-row report); empty means pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspan.operators.cells import labels_ready


def require_empty(problems: DataFrame, message: str) -> None:
    """Raise with a few example rows when ``problems`` has any. This is an action."""
    examples = problems.limit(5).collect()
    if examples:
        raise ValueError(f"{message}; first: {[r.asDict() for r in examples]}")


def expect_unique(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def expect_subset(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """Ids of ``inner`` that ``outer`` lacks."""
    return inner.select(key).distinct().join(outer.select(key).distinct(), key, "left_anti")


def expect_nonempty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank or null values per column."""
    blank = lambda c: F.count_if(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "")
    wide = df.agg(F.count("*").alias("n_rows"), *[blank(c).alias(f"__{c}") for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{c}").alias("blank_rows")) for c in columns])
    return wide.select("n_rows", F.explode(rows).alias("r")).select("r.*", "n_rows")


def missing_and_extra(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Both set differences: ``missing`` from and ``extra`` in ``observed``."""
    missing = expected.select(key).subtract(observed.select(key)).select(F.lit("missing").alias("side"), key)
    extra = observed.select(key).subtract(expected.select(key)).select(F.lit("extra").alias("side"), key)
    return missing.unionByName(extra)


def route_readiness(rna: DataFrame, sites: DataFrame, label_counts: DataFrame, *, approved: bool, min_cells: int = 6) -> DataFrame:
    """One row: which analyses the inputs allow."""
    ready = labels_ready(label_counts, min_cells)
    # one row decides presence; the tables are not counted
    has = lambda df: df.limit(1).agg(F.count("*") > 0).scalar()
    return ready.select(
        has(rna).alias("rna_present"), has(sites).alias("methylation_present"),
        (F.col("ready") & F.lit(approved)).alias("dmr_ready"),
    )


def id_mismatches(cells: DataFrame) -> DataFrame:
    """Cells whose id is not ``sample_id + '_' + barcode``."""
    built = F.concat("sample_id", F.lit("_"), "barcode")
    return cells.where(~F.coalesce(built == F.col("cell_id"), F.lit(False))).select("cell_id", F.lit("id_mismatch").alias("problem"))


def conflicting_labels(cells: DataFrame) -> DataFrame:
    """Cells that carry more than one (sample, label)."""
    return (
        cells.select("cell_id", "sample_id", "cell_type").distinct().groupBy("cell_id").agg(F.count("*").alias("n"))
        .where("n > 1").select("cell_id", F.lit("conflicting_labels").alias("problem"))
    )


def expected_count(df: DataFrame, expected: int) -> DataFrame:
    """One row when ``df`` does not have ``expected`` rows, else none."""
    return df.agg(F.count("*").alias("rows")).where(F.col("rows") != expected).withColumn("expected", F.lit(expected))


def panel_consistency(order: DataFrame, panels: DataFrame, mapping: DataFrame, key: str = "label") -> DataFrame:
    """Labels that are not in all three of display order, marker panels and mapping."""
    tagged = None
    for i, df in enumerate((order, panels, mapping)):
        one = df.select(key).distinct().withColumn("__s", F.lit(i))
        tagged = one if tagged is None else tagged.unionByName(one)
    seen = tagged.groupBy(key).agg(*[F.bool_or(F.col("__s") == i).alias(n) for i, n in enumerate(("in_order", "in_panels", "in_mapping"))])
    return seen.where(~(F.col("in_order") & F.col("in_panels") & F.col("in_mapping")))


def branch_consistency(matrix_cells: DataFrame, filtered: DataFrame, retained: DataFrame) -> DataFrame:
    """Per threshold: matrix cells must equal the filtered cells, retained ones must be among them.

    ``matrix_cells`` and ``retained`` carry ``(threshold, cell_id)``; ``filtered`` carries ``cell_id``.
    """
    base = filtered.select("cell_id").distinct().withColumn("__f", F.lit(True))
    n_filtered = base.agg(F.count("*")).scalar()
    m = matrix_cells.select("threshold", "cell_id").distinct().join(base, "cell_id", "left").groupBy("threshold").agg(
        F.count("*").alias("matrix_cells"), F.count("__f").alias("__matched"))
    r = retained.select("threshold", "cell_id").distinct().join(base, "cell_id", "left").groupBy("threshold").agg(
        F.count("*").alias("retained_cells"), F.count_if(F.col("__f").isNull()).alias("retained_outside"))
    out = m.join(r, "threshold", "full_outer").withColumn("filtered_cells", n_filtered)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = out.select("threshold", "filtered_cells", *[zero(c) for c in ("matrix_cells", "__matched", "retained_cells", "retained_outside")])
    same = (F.col("matrix_cells") == F.col("filtered_cells")) & (F.col("__matched") == F.col("filtered_cells"))
    return out.withColumn("ids_equal", same).withColumn("retained_subset", F.col("retained_outside") == 0).drop("__matched")


def drift_check(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Rows only in the stored or only in the current table; any row means the inputs drifted."""
    cols = stored.columns
    gone = stored.select(*cols).exceptAll(current.select(*cols)).withColumn("drift", F.lit("stored_only"))
    new = current.select(*cols).exceptAll(stored.select(*cols)).withColumn("drift", F.lit("current_only"))
    return gone.unionByName(new)

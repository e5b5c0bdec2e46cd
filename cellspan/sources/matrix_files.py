"""Count matrices: the three-file 10x layout, and the parquet matrix store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellspan.plans.sizes import broadcast_if_small
from cellspan.sources.text import first_lines, read_lines, with_line_numbers


def read_10x_mtx(spark: SparkSession, folder: str, label: str, suffix: str = "") -> DataFrame:
    """``cell_id, sample_id, gene, count`` of ``matrix.mtx``, ``barcodes.tsv``, ``features.tsv``.

    Indices are 1-based line numbers. Repeated gene symbols get ``-1``, ``-2``, ... from the second
    on; the cell id is ``label_barcode``. ``suffix`` is ``.gz`` for compressed files. Each name may also be
    a folder of parts, read as one file in name order; only a part with the format banner has a size line.
    Sizes that differ from the declared ones raise here; an index beyond its table, or an entry that is not three
    integers, stops the job.
    """
    tab = F.split("line", "\t")
    barcodes = with_line_numbers(read_lines(spark, f"{folder}/barcodes.tsv{suffix}"), "cell_no", across_files=True).select("cell_no", tab[0].alias("barcode"))
    features = with_line_numbers(read_lines(spark, f"{folder}/features.tsv{suffix}"), "gene_no", across_files=True).select("gene_no", F.coalesce(F.get(tab, F.lit(1)), tab[0]).alias("symbol"))
    repeat = F.row_number().over(Window.partitionBy("symbol").orderBy("gene_no")) - 1
    genes = features.withColumn("__r", repeat).select("gene_no", F.when(F.col("__r") == 0, F.col("symbol")).otherwise(F.concat_ws("-", "symbol", "__r")).alias("gene"))
    lines = read_lines(spark, f"{folder}/matrix.mtx{suffix}")
    body = lines.where(~F.col("line").startswith("%") & (F.length(F.trim("line")) > 0))
    banner = lines.where(F.col("line").startswith("%%MatrixMarket")).select("path").distinct()
    word = F.split(F.trim("line"), r"\s+")
    # the first line after the comments holds the sizes
    sizes = first_lines(body.join(banner, "path", "left_semi"))
    entries = body.join(sizes, "path", "left").where(F.col("__first").isNull() | (F.struct("__block", "__seq") != F.col("__first")))
    entries = entries.select(*[F.get(word, F.lit(i)).try_cast("bigint").alias(c) for i, c in enumerate(("gene_no", "cell_no", "count"))])
    declared = body.join(sizes, "path").where(F.struct("__block", "__seq") == F.col("__first"))
    _check_sizes(declared.select(*[word[i].try_cast("bigint").alias(c) for i, c in enumerate(_SIZES)]), genes, barcodes, entries)
    named = entries.join(broadcast_if_small(genes), "gene_no", "left").join(broadcast_if_small(barcodes), "cell_no", "left")
    stray = F.raise_error(F.concat_ws(" ", F.lit(f"{folder}: no feature or barcode for entry"), "gene_no", "cell_no"))
    known = F.col("gene").isNotNull() & F.col("barcode").isNotNull() & F.col("count").isNotNull()
    return named.where(F.when(known, F.lit(True)).otherwise(stray.cast("boolean"))).select(
        F.concat_ws("_", F.lit(label), "barcode").alias("cell_id"), F.lit(label).alias("sample_id"), "gene", "count"
    )


_SIZES = ("features", "barcodes", "entries")


def _check_sizes(declared: DataFrame, genes: DataFrame, barcodes: DataFrame, entries: DataFrame) -> None:
    """Raise unless one size line is there and says what the three files hold."""
    rows = declared.take(2)
    if len(rows) != 1:
        raise ValueError(f"one size line is needed, {len(rows)} or more found")
    held = {c: df.count() for c, df in zip(_SIZES, (genes, barcodes, entries), strict=True)}
    if held != rows[0].asDict():
        raise ValueError(f"the matrix declares {rows[0].asDict()} and holds {held}")


def save_matrix(counts: DataFrame, obs: DataFrame, var: DataFrame, path: str) -> None:
    """Write counts, cells and features as three parquet tables, then re-read and check them.

    An existing target is refused. Ids must be unique and every count must name a known cell and feature.
    """
    for name, df in (("counts", counts), ("obs", obs), ("var", var)):
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
    counts, obs, var = load_matrix(counts.sparkSession, path)
    checks = {
        "duplicate cells": obs.groupBy("cell_id").count().where("count > 1"),
        "duplicate features": var.groupBy("feature_id").count().where("count > 1"),
        "duplicate values": counts.groupBy("cell_id", "feature_id").count().where("count > 1"),
        "unknown cells": counts.join(obs, "cell_id", "left_anti"),
        "unknown features": counts.join(var, "feature_id", "left_anti"),
        "mc above cov": counts.where("mc > cov"),
    }
    for what, bad in checks.items():
        if not bad.isEmpty():
            raise ValueError(f"matrix at {path} failed verification: {what}")


def load_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{path}/{name}") for name in ("counts", "obs", "var"))


def matrix_shape(spark: SparkSession, path: str) -> DataFrame:
    counts, obs, var = load_matrix(spark, path)
    return counts.agg(F.count("*").alias("values")).withColumn("cells", obs.agg(F.count("*")).scalar()).withColumn("features", var.agg(F.count("*")).scalar())

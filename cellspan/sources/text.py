"""Line-level reading: file order, line numbers and the first line of each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.plans.prefix import global_row_number


def read_lines(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """``path, line, __block, __seq``: text lines with a key that sorts them in file order.

    ``__seq`` grows inside a split and ``__block`` is the split's byte offset, so the pair orders the
    lines of a file however its splits were scheduled.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__seq"),
    )


def with_line_numbers(lines: DataFrame, out: str = "line_no", *, across_files: bool = False) -> DataFrame:
    """Contiguous 1-based number of each remaining line within its file, or through all files by name."""
    order = [F.col("__block"), F.col("__seq")]
    if across_files:
        return global_row_number(lines, [F.col("path"), *order], out)
    return global_row_number(lines, order, out, ["path"])


def first_lines(lines: DataFrame) -> DataFrame:
    """``path, __first``: the order key of the first line of every file (combinable minimum)."""
    return lines.groupBy("path").agg(F.min(F.struct("__block", "__seq")).alias("__first"))


def is_content():
    """Neither blank nor a ``#`` comment."""
    return (F.length(F.trim("line")) > 0) & ~F.col("line").startswith("#")

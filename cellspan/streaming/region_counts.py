"""Incremental region counts: cells arrive as files, finished cells are never recounted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from cellspan.operators.intervals import count_over_regions, index_regions
from cellspan.operators.matrices import dataset_fingerprint
from cellspan.operators.quality import require_empty
from cellspan.operators.sites import context_filter, guarded_sites
from cellspan.plans.guards import checked
from cellspan.plans.storage import cut_lineage
from cellspan.sources.site_files import allc_errors, cell_name, parse_allc, prefixed_cell_id


def stream_allc(spark: SparkSession, folder: str, prefix: str, glob: str = "*.gz", files_per_batch: int = 1000) -> DataFrame:
    """Streaming ALLC lines of the files that appear below ``folder``; one file is one cell.

    ``cell_id, path, line, __block``: lines are parsed with their file at hand, batch by batch, by :func:`stream_region_counts`.
    """
    lines = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").format("text").load(folder)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("line"),
                F.col("_metadata.file_block_start").alias("__block"))
    )
    return lines.withColumn("cell_id", prefixed_cell_id(cell_name("name"), F.lit(prefix))).drop("name")


def _parsed(batch: DataFrame) -> DataFrame:
    """Site rows of a batch of lines, each file's first line excused; stored once, malformed lines are errors that are named."""
    lines = cut_lineage(batch.withColumn("__seq", F.monotonically_increasing_id()))
    require_empty(allc_errors(lines), "malformed lines in arriving files")
    return parse_allc(lines).select("cell_id", "path", "chrom", "pos", "context", "mc", "cov")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as absent:
        # anything else is a fault of the store, not a first start
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _check_definition(spark: SparkSession, regions: DataFrame, context: str, path: str) -> None:
    """Store the fingerprint of regions and context on first start; refuse a different one later."""
    now = dataset_fingerprint(regions.select("chrom", "start", "end", "feature_id")).withColumn("context", F.lit(context))
    stored = _read_or_none(spark, path)
    if stored is None:
        now.coalesce(1).write.parquet(path)
    elif not now.select(*stored.columns).exceptAll(stored).isEmpty():
        raise ValueError(f"the region definition differs from the one stored at {path}; use a new output folder")


def stream_region_counts(sites: DataFrame, regions: DataFrame, output: str, *, context: str = "CGN", available_now: bool = True):
    """Start the query that appends ``(cell_id, feature_id, mc, cov)`` below ``output/counts``.

    Each micro-batch overwrites its own ``batch_id`` folder, so a replayed batch leaves no duplicate.
    A cell comes from one file: the same file seen again changes nothing, and a second file with a cell id that
    another file has brought, in the same batch or an earlier one, stops the query. The file is ``path`` where the
    sites have it, else the file that Spark reads. ``sites`` are lines of :func:`stream_allc` or parsed rows; a malformed line
    and an invalid count stop the query before their batch is written. Needs a shared file system for ``output``.
    """
    spark = sites.sparkSession
    _check_definition(spark, regions, context, f"{output}/definition")
    index = index_regions(regions.select("chrom", "start", "end", "feature_id"))
    if "path" not in sites.columns:
        sites = sites.withColumn("path", F.col("_metadata.file_path"))
    raw = "line" in sites.columns
    incoming = sites if raw else context_filter(sites, context, "dinucleotide").select("cell_id", "path", "chrom", "pos", "mc", "cov")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        done = _read_or_none(session, f"{output}/cells")
        rows = context_filter(_parsed(batch), context, "dinucleotide").drop("context") if raw else batch
        valid = guarded_sites(rows, "count")
        rows = checked(valid.watched, valid)
        fresh, origins = rows, rows.select("cell_id", "path")
        if done is not None:
            earlier = done.where(F.col("batch_id") < batch_id).select("cell_id", "path")
            fresh = rows.join(earlier, ["cell_id", "path"], "left_anti")
            origins = origins.unionByName(earlier.join(origins.select("cell_id").distinct(), "cell_id", "left_semi"))
        twice = origins.groupBy("cell_id").agg(F.min("path").alias("a"), F.max("path").alias("b")).where("a <> b").first()
        if twice is not None:
            raise ValueError(f"cell {twice['cell_id']} comes from more than one file: {twice['a']}, {twice['b']}")
        count_over_regions(fresh, index).write.mode("overwrite").parquet(f"{output}/counts/batch_id={batch_id}")
        # the cell list is written last: it marks the batch as finished
        fresh.select("cell_id", "path").distinct().write.mode("overwrite").parquet(f"{output}/cells/batch_id={batch_id}")

    writer = incoming.writeStream.foreachBatch(write).option("checkpointLocation", f"{output}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_region_counts(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/counts").select("cell_id", "feature_id", "mc", "cov")

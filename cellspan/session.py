"""Session settings this package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits skewed partitions, merges small ones and re-plans joins from measured sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpointed tables go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def configure(builder: SparkSession.Builder, *, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Apply :data:`SETTINGS`; leave ``shuffle_partitions`` unset on a cluster sized by its own config."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder

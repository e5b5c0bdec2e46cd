"""Reviewed cell labels: worksheets, profiles and the guards on their use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspan.functions.columns import is_placeholder
from cellspan.operators.cells import majority_label


def review_worksheet(annotation: DataFrame, cluster: str = "leiden", label: str = "cell_type") -> DataFrame:
    """One row per cluster, pre-filled with the majority label for a reviewer to correct."""
    return majority_label(annotation, cluster, label).select(
        F.col(cluster).alias("cluster"), "proposed_cell_type", "cells",
        F.col("proposed_cell_type").alias("cell_type"), F.lit("reviewed").alias("confidence"), F.lit("").alias("evidence"),
    )


def mixed_clusters(annotation: DataFrame, cluster: str = "leiden", label: str = "cell_type") -> DataFrame:
    """Clusters whose cells carry more than one label: the ones to review first."""
    return majority_label(annotation, cluster, label).where(F.col("n_labels") > 1)


def worksheet_problems(sheet: DataFrame) -> DataFrame:
    """Rows of a completed worksheet that must be refused, with the first applicable ``problem``."""
    rows = sheet.select(F.trim(F.coalesce("cluster", F.lit(""))).alias("cluster"), F.trim(F.coalesce("cell_type", F.lit(""))).alias("cell_type"))
    copies = rows.groupBy("cluster").agg(F.count("*").alias("__n"))
    problem = (
        F.when(F.col("cluster") == "", "blank cluster")
        .when(F.col("__n") > 1, "duplicate cluster")
        .when(F.col("cell_type") == "", "blank label")
        .when(is_placeholder("cell_type"), "placeholder label")
    )
    return rows.join(copies, "cluster").withColumn("problem", problem).where("problem is not null").drop("__n")


def record_profile(sheet: DataFrame, analysis_signature: str) -> DataFrame:
    """Profile rows from a checked worksheet, bound to the analysis they describe."""
    blank = lambda c, d: F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", d).otherwise(F.trim(c))
    return sheet.select(
        F.trim("cluster").alias("cluster"), F.trim("cell_type").alias("cell_type"),
        blank("confidence", "reviewed").alias("confidence"), blank("evidence", "").alias("evidence"),
        F.lit(analysis_signature).alias("analysis_signature"),
    )


def profile_verdict(cells: DataFrame, profile: DataFrame, analysis_signature: str) -> DataFrame:
    """One row ``(status, reason)``: reviewed only if signature, cluster set and labels all agree."""
    clusters = cells.select(F.col("cluster").cast("string").alias("cluster")).distinct().withColumn("__seen", F.lit(1))
    recorded = profile.select(F.col("cluster").cast("string").alias("cluster"), "cell_type", "analysis_signature", F.lit(1).alias("__known"))
    both = clusters.join(recorded, "cluster", "full_outer")
    facts = both.agg(
        F.count("__known").alias("known"),
        F.count_if(F.col("__known").isNotNull() & (F.coalesce("analysis_signature", F.lit("")) != analysis_signature)).alias("foreign"),
        F.count_if(F.col("__known").isNull() | F.col("__seen").isNull()).alias("unmatched"),
        F.count_if(F.col("__known").isNotNull() & (F.coalesce("cell_type", F.lit("")) == "")).alias("unlabelled"),
    )
    # The verdict texts.
    reason = (
        F.when(F.col("known") == 0, "annotation_profile_absent")
        .when(F.col("foreign") > 0, "analysis_signature_mismatch")
        .when(F.col("unmatched") > 0, "cluster_set_mismatch")
        .when(F.col("unlabelled") > 0, "annotation_mapping_incomplete")
        .otherwise("reviewed")
    )
    return facts.select(F.when(reason == "reviewed", "reviewed").otherwise("requires_review").alias("status"), reason.alias("reason"))


def apply_reviewed_labels(cells: DataFrame, profile: DataFrame, analysis_signature: str, unassigned: str = "Unassigned") -> DataFrame:
    """Cells with reviewed labels, or all ``unassigned`` when the verdict is not ``reviewed``."""
    verdict = profile_verdict(cells, profile, analysis_signature)
    reason = verdict.select("reason").scalar()
    labels = profile.select("cluster", F.col("cell_type").alias("__label"))
    out = cells.join(labels, "cluster", "left").withColumn("reason", reason)
    ok = F.col("reason") == "reviewed"
    return (
        out.withColumn("status", F.when(ok, "reviewed").otherwise("requires_review"))
        .withColumn("cell_type", F.when(ok, F.col("__label")).otherwise(unassigned))
        .drop("__label")
    )

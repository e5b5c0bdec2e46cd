"""Operators on site records ``(cell_id, chrom, pos, context, mc, cov)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspan.functions.columns import safe_percent, safe_ratio
from cellspan.plans.guards import Guard

# Which counts each stage accepts.
SITE_RULES = {
    "convert": "pos >= 1 and mc >= 0 and cov > 0 and mc <= cov",
    "preflight": "pos >= 1 and mc >= 0 and cov >= 0 and mc <= cov",
    "count": "pos >= 1 and mc >= 0 and cov >= mc",
}


def matches_context(configured: str, mode: str = "wildcard", column: str = "context") -> Column:
    """Predicate for a configured methylation context.

    ``wildcard``: a trailing ``N`` means "starts with the rest", otherwise equality.
    ``dinucleotide``: only the first two configured letters count and they must name a cytosine.
    """
    wanted = configured.strip().upper()
    observed = F.upper(F.col(column))
    if mode == "wildcard":
        return observed.startswith(wanted[:-1]) if wanted.endswith("N") else observed == wanted
    if mode == "dinucleotide":
        if len(wanted) < 2 or not wanted[:2].isalpha() or wanted[0] != "C":
            raise ValueError(f"not a cytosine context: {configured!r}")
        return observed.startswith(wanted[:2])
    raise ValueError(f"unknown context mode {mode!r}")


def context_filter(sites: DataFrame, configured: str = "CGN", mode: str = "wildcard") -> DataFrame:
    return sites.where(matches_context(configured, mode))


def valid_sites(sites: DataFrame, rule: str = "convert") -> DataFrame:
    """Rows that satisfy ``rule``; nulls fail."""
    return sites.where(F.expr(SITE_RULES[rule]))


def invalid_sites(sites: DataFrame, rule: str = "convert") -> DataFrame:
    """The complement of :func:`valid_sites`, for error reports."""
    return sites.where(~F.coalesce(F.expr(SITE_RULES[rule]), F.lit(False)))


def rule_counts(sites: DataFrame, rules: Sequence[str] = tuple(SITE_RULES)) -> DataFrame:
    """``rule, valid, invalid``: the rows that :func:`valid_sites` and :func:`invalid_sites` give for each rule, from one reading."""
    ok = [F.coalesce(F.expr(SITE_RULES[rule]), F.lit(False)) for rule in rules]
    counts = F.array(*[F.struct(F.lit(rule).alias("rule"), F.count_if(good).alias("valid"), F.count_if(~good).alias("invalid")) for rule, good in zip(rules, ok)])
    return sites.agg(counts.alias("c")).select(F.inline("c"))


def guarded_sites(sites: DataFrame, rule: str = "convert") -> Guard:
    """``sites`` under the contract of ``rule``: a row that breaks it stops the run at the sink and is named."""
    shown = [c for c in ("cell_id", "path", "chrom", "pos", "mc", "cov") if c in sites.columns]
    return Guard(sites, f"sites ({rule})", {"an invalid position or count": ~F.coalesce(F.expr(SITE_RULES[rule]), F.lit(False))}, shown)


def coverage_projection(sites: DataFrame) -> DataFrame:
    """Add ``uc`` (unmethylated reads) and ``pct`` (methylation percentage)."""
    return sites.withColumn("uc", F.col("cov") - F.col("mc")).withColumn("pct", safe_percent("mc", "cov"))


def binary_calls(sites: DataFrame, round_sites: bool = False) -> DataFrame:
    """One 0/1 ``call`` per site: mixed sites are dropped, or rounded to the majority on request."""
    if round_sites:
        return sites.withColumn("call", F.when(F.col("mc") * 2 >= F.col("cov"), 1).otherwise(0).cast("long"))
    unmixed = sites.where((F.col("mc") == 0) | (F.col("mc") == F.col("cov")))
    return unmixed.withColumn("call", F.when(F.col("mc") > 0, 1).otherwise(0).cast("long"))


def cell_site_qc(sites: DataFrame) -> DataFrame:
    """Per-cell coverage totals, global methylation and unmixed-call counts."""
    unmixed = (F.col("mc") == 0) | (F.col("mc") == F.col("cov"))
    sums = sites.groupBy("cell_id").agg(
        F.count("*").alias("covered_sites"),
        F.sum("mc").alias("methylated_reads"),
        F.sum("cov").alias("total_reads"),
        F.count_if(unmixed).alias("unmixed_sites"),
        F.count_if(unmixed & (F.col("mc") > 0)).alias("unmixed_methylated"),
    )
    return sums.withColumn("mcg", safe_ratio("methylated_reads", "total_reads")).withColumn(
        "unmixed_fraction", safe_ratio("unmixed_methylated", "unmixed_sites")
    )


def guarded_cell_site_qc(sites: DataFrame, cells: DataFrame) -> Guard:
    """:func:`cell_site_qc` for every cell of ``cells``; a cell without a covered site is an error."""
    qc = cells.select("cell_id").distinct().join(cell_site_qc(sites), "cell_id", "left")
    return Guard(qc, "cell site counts", {"no covered site": F.col("covered_sites").isNull()}, ["cell_id"])


def cells_without_sites(cells: DataFrame, sites: DataFrame) -> DataFrame:
    """Cells of ``cells`` with no covered site: an error for the conversion stage."""
    return cells.join(sites.select("cell_id").distinct(), "cell_id", "left_anti")

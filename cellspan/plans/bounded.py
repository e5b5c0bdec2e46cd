"""Bring a table with a known size bound to the driver, and refuse when the bound is broken."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row


def bounded_rows(df: DataFrame, limit: int, what: str) -> list[Row]:
    """All rows of ``df``, which must not be more than ``limit``; never truncates."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows, which this step cannot hold on the driver")
    return rows

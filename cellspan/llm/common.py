"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.plans.storage import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Space and the control characters from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written below the shared folder and read again: the lineage ends in files all executors see."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, inside one expression."""
    return F.transform(F.array(value), body)[0]


def text_slices(frames: Iterator[pd.DataFrame], column: str = "text", budget: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Consecutive slices of the batches with about ``budget`` characters of text each; null text becomes empty."""
    for frame in frames:
        frame[column] = frame[column].fillna("")
        sizes = frame[column].str.len().cumsum()
        first = 0
        while first < len(frame):
            done = sizes.iloc[first - 1] if first else 0
            last = max(first + 1, int(sizes.searchsorted(done + budget, side="right")))
            yield frame.iloc[first:last]
            first = last


def with_document_columns(df: DataFrame) -> DataFrame:
    """Only the columns of ``documents``, in their order."""
    return df.select(*DOCUMENT_COLUMNS)


def join_by_counted_key(rows: DataFrame, looked_up: DataFrame, key: str, count: str, share: int = 64) -> DataFrame:
    """Inner join of ``rows`` with the one row per ``key`` of ``looked_up``, which counts the rows of its key in ``count``.

    Keys with more than one in ``share`` of all rows, fewer than ``share`` by arithmetic, are broadcast; the others are
    joined by a shuffle in which no key is hot. Both inputs are read twice, so they should be stored.
    """
    total = looked_up.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * share > total
    few = looked_up.where(hot)
    common = rows.join(F.broadcast(few), key)
    rest = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(looked_up.where(~hot), key)
    return common.unionByName(rest)

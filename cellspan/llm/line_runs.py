"""Line deduplication over levelled sorted runs of line hashes.

Lines become 128-bit hashes of their keys. Documents come in batches of descending ``doc_id``. A batch sums its
hashes, merge-anti-joins the runs that exist, and adds its own run: hashes no run knows name their keeper (the
largest document that holds them), known ones add only their count. A level with ``fanout`` runs is compacted
into one run of the next level. Runs are tables bucketed and sorted by the hash, so neither joins nor compaction
shuffle them again. Everything here is DataFrame operations.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.llm.common import stored
from cellspan.plans.storage import scratch_path

# The characters stripped from a line's ends, and the letters that are lower-cased.
_BLANK = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_HASH = ("__h1", "__h2")


def line_key(line: Column) -> Column:
    """``line`` without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _UPPER.lower())


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, __row, __pos, __h1, __h2) of every line whose key has ``min_chars`` code points or more.

    ``__row`` tells rows with equal ``doc_id`` apart by their text.
    """
    keys = F.transform(_lines(F.col("text")), lambda x: line_key(x))
    return (
        docs.select(F.col("doc_id"), F.xxhash64("text").alias("__row"), F.posexplode(keys).alias("__pos", "__key"))
        .where(F.char_length("__key") >= min_chars)
        .select("doc_id", "__row", "__pos", F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(1), "__key").alias("__h2"))
    )


class HashRuns:
    """Runs of (hash, number of documents, keeper) by level."""

    def __init__(self, spark: SparkSession, *, fanout: int = 4, buckets: int | None = None) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.select(*_HASH, "__docs", "__keeper").repartition(self.buckets, "__h1")
            .write.option("path", scratch_path(self.spark, "line-run"))
            .bucketBy(self.buckets, "__h1").sortBy("__h1", "__h2").saveAsTable(name)
        )
        return name

    def _all(self, names: list[str]) -> DataFrame:
        out = self.spark.table(names[0])
        for name in names[1:]:
            out = out.unionByName(self.spark.table(name))
        return out

    def _merged(self, names: list[str]) -> DataFrame:
        # the keeper is named once, by the first run that held the hash
        return self._all(names).groupBy(*_HASH).agg(F.sum("__docs").alias("__docs"), F.max("__keeper").alias("__keeper"))

    def add(self, lines: DataFrame) -> None:
        """One batch of (doc_id, __h1, __h2), all of whose ids are at most those of earlier batches."""
        batch = lines.groupBy(*_HASH).agg(
            F.count(F.lit(1)).alias("__docs"), F.max(F.struct(F.lit(1).alias("held"), F.col("doc_id"))).alias("__keeper")
        )
        known = [name for level in self.levels for name in level]
        for name in known:
            # a hash that any run knows already has its keeper
            seen = self.spark.table(name).where(F.col("__keeper").isNotNull()).select(*_HASH, F.lit(True).alias("__known"))
            batch = batch.join(seen, list(_HASH), "left").select(
                *_HASH, "__docs", F.when(F.col("__known").isNull(), F.col("__keeper")).alias("__keeper")
            )
        self._place(0, self._write(batch))

    def _place(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(names))
            for old in names:
                self.spark.sql(f"drop table {old}")
            self._place(level + 1, merged)

    def totals(self) -> DataFrame | None:
        """(hash, __docs, __keeper) over all runs; None when nothing was added."""
        names = [name for level in self.levels for name in level]
        return self._merged(names) if names else None


def dedup_lines(
    docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 3, out: str = "kept_text"
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and the kept text as ``out``.

    A key of at least ``min_chars`` code points held by at least ``min_docs`` documents loses its lines in every
    document but the one with the largest ``doc_id``. Null or empty text is one empty line. A null ``doc_id``
    counts as smaller than any other. Rows are documents: rows with equal ``doc_id`` and different text count
    separately, and if they hold the largest id all of them keep the line; equal rows count once.
    Other columns pass through; columns named as an output are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped", *([out] if out != "text" else []))
    shares = [i / batches for i in range(1, batches)]
    # a bounded number of cut points of one narrow column
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("c")).first()["c"] or []
    ids = F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("bigint"))
    batch = sum((F.when(ids > F.lit(int(c)), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    lines = stored(line_hashes(docs, min_chars).withColumn("__batch", batch), "line-hashes", ["__batch"])
    runs = HashRuns(spark, fanout=fanout)
    for number in range(len(set(cuts)), -1, -1):
        held = lines.where(F.col("__batch") == number).select("doc_id", "__row", *_HASH).distinct()
        runs.add(held.select("doc_id", *_HASH))
    frequent = runs.totals().where(F.col("__docs") >= min_docs).select(*_HASH, F.col("__keeper.doc_id").alias("__keep"))
    dropped = (
        lines.join(frequent, list(_HASH))
        .where(~F.col("doc_id").eqNullSafe(F.col("__keep")))
        .groupBy("doc_id", "__row").agg(F.sort_array(F.collect_set("__pos")).alias("__drop"))
        .select(F.col("doc_id").alias("__id"), F.col("__row").alias("__text_row"), "__drop")
    )
    joined = docs.withColumn("__row", F.xxhash64("text")).join(
        dropped, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__text_row")), "left"
    )
    all_lines = _lines(F.col("text"))
    cut = F.coalesce("__drop", F.array().cast("array<int>"))
    # the kept lines are the stretches between dropped positions, so the work grows with the lines only
    kept = F.when(F.col("__drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(
            F.flatten(F.zip_with(
                F.concat(F.array(F.lit(-1)), "__drop"), F.concat("__drop", F.array(F.col("n_lines").cast("int"))),
                lambda a, b: F.slice(F.col("__lines"), a + 2, b - a - 1),
            )), "\n",
        )
    )
    return (
        joined.withColumn("__lines", all_lines)
        .withColumn("n_lines", F.size("__lines").cast("bigint"))
        .withColumn("n_dropped", F.size(cut).cast("bigint"))
        .withColumn(out, kept)
        .drop("__row", "__id", "__text_row", "__drop", "__lines")
    )

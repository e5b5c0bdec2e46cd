"""The corpus pipeline: documents that pass each stage, packed into sequences at the end.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes each as Parquet in the shared
folder and gives what it reads back to the next, so a stage never runs twice and lost executors cost one stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.llm import best_fit, line_runs, near_copies, neighbour_quality, temperature_mix
from cellspan.llm.common import table, with_document_columns
from cellspan.plans.storage import scratch_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return with_document_columns(neighbour_quality.keep_good(docs, table(spark, sf_dir, "labels"), docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that other documents keep; ``n_chars`` follows the text."""
    kept = line_runs.dedup_lines(docs, out="text")
    return with_document_columns(kept.withColumn("n_chars", F.char_length("text").cast("bigint")))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    found = near_copies.near_copy_components(docs).where("not kept").select("doc_id").distinct()
    return with_document_columns(docs.join(found, "doc_id", "left_anti"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; smaller sources come up to four times, by the exponent that reaches 0.97 of the
    largest entropy or comes nearest to it. A repeated document is repeated rows; an empty table stays empty.
    """
    return with_document_columns(temperature_mix.mix(docs, entropy_share=0.97, max_repeats=4.0, epochs=None))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return best_fit.pack_documents(docs)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Quality rules with thresholds learned from mergeable quantile sketches per language and source.

A sketch counts the values of one measure in buckets of relative width (quantiles are within 1 %). Sketches of
equal buckets merge by adding counts, so they are built by partial aggregation, merged upwards from (language,
source) to language to corpus, and read back as quantiles. A group's sketch has its own documents and, as so many more,
the distribution of the next wider group, so that small groups lean on wider ones without a switch. Fences lie beyond
the outer tenths by a multiple of their distance from the median; the thresholds reach the documents by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cellspan.llm.common import stored, text_slices
from cellspan.plans.sizes import broadcast_if_small

#: Per measure: the least distance of a tail from the median, and whether low values fail. It decides where nine tenths
#: of a group have next to none of what is measured, as is usual of all but the first and ``upper_rate``.
MEASURES = {
    "mean_word": (0.1, True),
    "symbol_rate": (0.06, False),
    "mark_rate": (0.06, False),
    "upper_rate": (0.004, False),
    "dup_line_rate": (0.16, False),
    "repeat_rate": (0.14, False),
}
GAMMA = 1.02
_ZERO = -100_000  # the bucket of values too small for a logarithm

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_COUNT_SCHEMA = "doc_id bigint, lang string, source string, " + ", ".join(
    f"{c} bigint" for c in (*_COUNTS, "n_lines", "n_marks", "n_upper")
)

# Fixed values.
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _count(octets: bytes, chars: bytes) -> int:
    return len(octets) - len(octets.translate(None, chars))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    u = len(known)
    pairs = ids[:-1] * u + ids[1:]
    if u > 2_000_000:  # three numbers no longer fit in one
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * u + ids[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    marked = np.zeros(n, dtype=bool)
    for i in range(3):
        marked[i : n - 2 + i] |= again
    return int(marked.sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of the schema."""
    octets = text.encode("utf-8", "surrogatepass")
    words = octets.split()
    lines = [x for x in octets.split(b"\n") if x.strip()]
    return (
        len(words), len(text) - _count(octets, _BLANKS), _count(octets, _SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), octets.count(b"!"), _count(octets, _UPPER),
    )


def _count_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _COUNT_SCHEMA.split(", ")]
    for part in text_slices(frames):
        counts = np.array([text_counts(t) for t in part["text"]], dtype=np.int64).reshape(-1, 8)
        yield pd.concat([part[["doc_id", "lang", "source"]].reset_index(drop=True), pd.DataFrame(counts, columns=names[3:])], axis=1)


def counted(docs: DataFrame) -> DataFrame:
    """Counts and measures of every whole text; null text has none of anything."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "lang", "source", "text").mapInPandas(_count_rows, _COUNT_SCHEMA)
    words = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns({
        "mean_word": F.col("word_chars") / words,
        "symbol_rate": F.col("n_symbols") / words,
        "mark_rate": F.col("n_marks") / words,
        "upper_rate": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "base_failed": (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
    })


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bucket, n): the sketches of all measures, one row per filled bucket."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES)))
    bucket = F.when(F.col("e.value") < 1e-6, _ZERO).otherwise(F.ceil(F.log(F.col("e.value")) / math.log(GAMMA))).cast("int")
    return (
        rows.select(*keys, each.alias("e")).select(*keys, "e.measure", bucket.alias("bucket"))
        .groupBy(*keys, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups added up to ``keys``."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], **at: float) -> DataFrame:
    """(keys, measure, docs, one column per quantile) read from sketches; a group has at most a few thousand buckets."""
    group = Window.partitionBy(*keys, "measure")
    ranked = sketches.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("docs", F.sum("n").over(group))
    value = F.when(F.col("bucket") == _ZERO, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))
    first = lambda q: F.min(F.when(F.col("upto") >= F.col("docs") * (q - 1e-9), F.col("value")))
    return ranked.withColumn("value", value).groupBy(*keys, "measure").agg(
        F.max("docs").alias("docs"), *(first(q).alias(name) for name, q in at.items())
    )


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, docs, q1, q3)."""
    return quantiles(sketches, keys, q1=0.25, q3=0.75)


def shrunk(own: DataFrame, wider: DataFrame, groups: DataFrame, keys: list[str], wider_keys: list[str], weight: float) -> DataFrame:
    """Sketches of all ``groups``: their own counts and the wider group's distribution, counted as ``weight`` documents."""
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*wider_keys, "measure"))
    prior = wider.select(*(F.col(k).alias(f"__{k}") for k in wider_keys), "measure", "bucket", (share * weight).alias("n"))
    prior = broadcast_if_small(prior, materialize=True)
    joined = groups.crossJoin(prior)
    for k in wider_keys:
        joined = joined.where(F.col(k).eqNullSafe(F.col(f"__{k}")))
    return merge(own.withColumn("n", F.col("n").cast("double")).unionByName(joined.select(*keys, "measure", "bucket", "n")), keys)


def _fences(sketches: DataFrame, keys: list[str], fence: float) -> DataFrame:
    """One row per group: an array of (low, high) per measure, in the order of :data:`MEASURES`."""
    table = quantiles(sketches, keys, low=0.1, mid=0.5, high=0.9)
    columns = []
    for m, (slack, two_sided) in MEASURES.items():
        beyond = lambda distance, slack=slack: fence * F.greatest(distance, F.lit(slack))
        low = F.col("low") - beyond(F.col("mid") - F.col("low")) if two_sided else F.lit(-1.0)
        high = F.col("high") + beyond(F.col("high") - F.col("mid"))
        columns.append(F.max(F.when(F.col("measure") == m, F.struct(low.alias("low"), high.alias("high")))).alias(m))
    return table.groupBy(*keys).agg(*columns).select(*keys, F.struct(*MEASURES).alias("fences"))


def thresholds(rows: DataFrame, *, min_docs: int = 200, fence: float = 2.5) -> DataFrame:
    """(lang, source, fences) for every group in ``rows``; rows that fail the base rules don't count.

    The wider group counts as ``min_docs`` documents, at least one.
    """
    fine = stored(sketch(rows.where(~F.col("base_failed")), ["lang", "source"]), "sketches")
    by_lang = stored(merge(fine, ["lang"]), "language-sketches")
    groups = stored(rows.select("lang", "source").distinct(), "quality-groups")
    weight = float(max(1, min_docs))
    languages = shrunk(by_lang, merge(by_lang, []), groups.select("lang").distinct(), ["lang"], [], weight)
    return _fences(shrunk(fine, languages, groups, ["lang", "source"], ["lang"], weight), ["lang", "source"], fence)


def _inside(m: str) -> Column:
    return (F.col(m) >= F.col("fences")[m]["low"]) & (F.col(m) <= F.col("fences")[m]["high"])


def judge(docs: DataFrame, *, min_docs: int = 200, fence: float = 2.5) -> DataFrame:
    """Counts, measures, ``base_failed``, ``failed_rules`` and ``kept`` of every row of ``docs``.

    Needs doc_id, text, lang, source; other columns are not read. Null text is empty and fails the base rules;
    null language or source is a group of its own; a small group's thresholds lean on its language's, and those on the
    corpus's. Equal rows count each. Where every document fails the base rules, none is kept.
    """
    rows = stored(counted(docs), "quality-counts")
    limits = broadcast_if_small(thresholds(rows, min_docs=min_docs, fence=fence), materialize=True)
    limits = limits.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), "fences")
    judged = rows.join(limits, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left").drop("__lang", "__source")
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(_inside(m), F.lit(True)), F.lit(m)) for m in MEASURES)))
    return judged.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("fences")


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is kept, all columns unchanged."""
    verdict = judge(docs.select("doc_id", "text", "lang", "source"), **options)
    good = verdict.where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(good, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")), "left_semi")

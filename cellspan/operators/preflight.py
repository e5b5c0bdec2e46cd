"""Checks on site lines in file order: ``(path, line_no, chrom, pos, context, mc, cov)``.

``line_no`` is contiguous per file. Neighbours are found by an equi-join on the next line number, so
a huge file is never one window group. :func:`order_summaries` needs no numbers: it reads lines as the splits of files give
them, keeps a few rows per split, and :func:`stitched_site_check` joins those at the splits' edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspan.operators.sites import SITE_RULES, matches_context


def _with_previous(lines: DataFrame) -> DataFrame:
    before = lines.select("path", (F.col("line_no") + 1).alias("line_no"), F.col("chrom").alias("__chrom"), F.col("pos").alias("__pos"))
    return lines.join(before, ["path", "line_no"], "left")


def sorted_site_check(lines: DataFrame) -> DataFrame:
    """``path, chrom, unsorted, blocks`` for every chromosome of a file that breaks the order.

    ``unsorted`` counts positions below their predecessor in the block; ``blocks > 1`` means the
    chromosome reappears after another one.
    """
    linked = _with_previous(lines)
    opens = F.col("__chrom").isNull() | (F.col("chrom") != F.col("__chrom"))
    back = (F.col("chrom") == F.col("__chrom")) & (F.col("pos") < F.col("__pos"))
    return linked.groupBy("path", "chrom").agg(F.count_if(back).alias("unsorted"), F.count_if(opens).alias("blocks")).where(
        (F.col("unsorted") > 0) | (F.col("blocks") > 1)
    )


_SUMMARY = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("chrom", pa.string()), ("unsorted", pa.int64()), ("blocks", pa.int64()),
    ("first_chrom", pa.string()), ("first_pos", pa.int64()), ("last_chrom", pa.string()), ("last_pos", pa.int64()),
])


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chromosome of each split, from lines in the order of the split."""
    split = first = last = None
    seen: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        out = [(*split, chrom, *counts, *first, *last) for chrom, counts in seen.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SUMMARY.types, strict=True)], schema=_SUMMARY)

    for batch in batches:
        for path, block, chrom, pos in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (path, block) != split:
                if seen:
                    yield rows()
                split, first, last, seen = (path, block), (chrom, pos), None, {}
            counts = seen.setdefault(chrom, [0, 0])
            if last is None or last[0] != chrom:
                counts[1] += 1
            elif pos is not None and last[1] is not None and pos < last[1]:
                counts[0] += 1
            last = (chrom, pos)
    if seen:
        yield rows()


def order_summaries(lines: DataFrame) -> DataFrame:
    """Per split and chromosome: descents, runs, and the split's first and last line, of ``(path, __block, chrom, pos)``.

    ``lines`` come straight from ``text.read_lines``, filtered and parsed but neither shuffled nor sorted. One pass, no exchange.
    """
    return lines.select("path", "__block", "chrom", "pos").mapInArrow(
        _summarised, "path string, block bigint, chrom string, unsorted bigint, blocks bigint, first_chrom string, first_pos bigint, last_chrom string, last_pos bigint")


def stitched_site_check(summaries: DataFrame) -> DataFrame:
    """The rows of :func:`sorted_site_check` from split summaries, of which a file has a few.

    A run that goes on over a split's edge is one run, and a descent over the edge counts.
    """
    edges = summaries.groupBy("path", "block").agg(*[F.first(c).alias(c) for c in ("first_chrom", "first_pos", "last_chrom", "last_pos")])
    before = Window.partitionBy("path").orderBy("block")
    joined = edges.withColumn("__chrom", F.lag("last_chrom").over(before)).withColumn("__pos", F.lag("last_pos").over(before)).where("__chrom = first_chrom")
    goes_on = joined.select("path", F.col("first_chrom").alias("chrom"), (F.col("first_pos") < F.col("__pos")).cast("long").alias("unsorted"), F.lit(-1).cast("long").alias("blocks"))
    return summaries.select("path", "chrom", "unsorted", "blocks").unionByName(goes_on).groupBy("path", "chrom").agg(
        F.sum("unsorted").alias("unsorted"), F.sum("blocks").alias("blocks")).where("unsorted > 0 or blocks > 1")


def preflight_sites(lines: DataFrame, context: str = "CGN", mode: str = "full", quick_records: int = 100) -> DataFrame:
    """One row per file: records checked, invalid ones, whether the context was seen, order breaks.

    ``quick`` reads on to record ``quick_records`` or to the first matching context, whichever is
    later; ``full`` checks every record and the order. ``problem`` is null for a good file.
    """
    if mode not in ("quick", "full"):
        raise ValueError("mode is quick or full")
    match = matches_context(context)
    seen = lines.groupBy("path").agg(F.min(F.when(match, F.col("line_no"))).alias("__first"))
    checked = lines.join(seen, "path")
    if mode == "quick":
        checked = checked.where(F.col("__first").isNull() | (F.col("line_no") <= F.greatest(F.col("__first"), F.lit(quick_records))))
    ok = F.coalesce(F.expr(SITE_RULES["preflight"]), F.lit(False))
    out = checked.groupBy("path").agg(
        F.count("*").alias("records_checked"), F.count_if(~ok).alias("invalid_records"), F.bool_or(match).alias("saw_context")
    )
    broken = F.lit(0).cast("long")
    if mode == "full":
        order = sorted_site_check(lines).groupBy("path").agg(F.sum("unsorted").alias("__u"), F.sum(F.col("blocks") - 1).alias("__b"))
        out = out.join(order, "path", "left")
        broken = F.coalesce("__u", F.lit(0).cast("long")) + F.coalesce("__b", F.lit(0).cast("long"))
    problem = (
        F.when(F.col("invalid_records") > 0, "invalid counts").when(F.col("order_breaks") > 0, "not coordinate sorted")
        .when(~F.col("saw_context"), "no matching context")
    )
    return out.withColumn("order_breaks", broken).withColumn("mode", F.lit(mode)).withColumn("problem", problem).drop("__u", "__b")

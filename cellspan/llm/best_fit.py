"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

Pieces of equal length are interchangeable, and so are gaps of equal size. The rounds therefore work on ranges:
a document range is (length, ranks), a gap range is (size, sequences). Each round takes the longest open
document range, sweeps the sorted gap ranges from its successor upwards, matches documents to gaps by rank,
puts what is left of the gaps back in order, and opens new sequences for documents without a gap. The state is
at most one row per length and size, whatever the corpus holds; ranks are dealt to the single documents by
per-partition counters, so that no length, however common, meets in one task.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspan.llm.common import stored, text_slices
from cellspan.llm.tokens import byte_bpe_path, encoder

_PIECE_SCHEMA = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, part int, local_rank bigint"
)
_PLAN_SCHEMA = "length bigint, rank_from bigint, rank_to bigint, per_sequence bigint, sequence_from bigint, offset bigint"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: full ones, after a shorter first one if ``n`` is no multiple."""
    rest = n % capacity
    return [rest] * (rest > 0) + [capacity] * (n // capacity)


def token_pieces(
    docs: DataFrame, *, capacity: int = 1024, vocabulary: str | None = None, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, ids, part, local_rank).

    Null text is empty; each document ends with ``end_id``, so every row has at least one piece. ``local_rank``
    counts the pieces of one length within one partition. ``ids`` is null unless asked for.
    """
    path = vocabulary or byte_bpe_path()

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        encode, end = encoder(path).encode_many, end_id.to_bytes(4, "little")
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for frame in text_slices(frames):
            rows = []
            keys = [None if pd.isna(k) else int(k) for k in frame["doc_id"].tolist()]
            for key, ids in zip(keys, encode(frame["text"].tolist()), strict=True):
                ids += end
                at = 0
                for number, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    block = ids[4 * at : 4 * (at + length)]
                    rows.append((key, number, at, length, zlib.crc32(block), block if with_ids else None, part, seen[length]))
                    seen[length] += 1
                    at += length
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in _PIECE_SCHEMA.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(pieces, _PIECE_SCHEMA)


def match_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """The rounds over document and gap ranges; rows of :data:`_PLAN_SCHEMA`.

    ``counts`` has the documents of each length, at most ``capacity`` entries.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # size -> ranges (first sequence, sequences)
    sizes: list[int] = []  # ascending
    plan, opened = [], 0

    def put(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in gaps:
                gaps[size] = []
                bisect.insort(sizes, size)
            ranges = gaps[size]
            if ranges and ranges[-1][0] + ranges[-1][1] == first:
                ranges[-1] = (ranges[-1][0], ranges[-1][1] + n)
            else:
                ranges.append((first, n))

    def fill(length: int, rank: int, left: int, size: int, first: int, n: int) -> int:
        """Match documents to ``n`` gaps by rank, as many as fit in each; the number matched."""
        each = size // length
        matched = min(left, n * each)
        whole, rest = divmod(matched, each)
        plan.append((length, rank, rank + matched, each, first, capacity - size))
        put(size - each * length, first, whole)
        if rest:
            put(size - rest * length, first + whole, 1)
        put(size, first + whole + (rest > 0), n - whole - (rest > 0))
        return matched

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            at = bisect.bisect_left(sizes, length)  # the successor
            if at == len(sizes):
                need = -(-(total - rank) // (capacity // length))
                rank += fill(length, rank, total - rank, capacity, opened, need)
                opened += need
                continue
            size = sizes[at]
            first, n = gaps[size].pop()
            if not gaps[size]:
                del gaps[size]
                sizes.pop(at)
            rank += fill(length, rank, total - rank, size, first, n)
    return plan


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: no sequence is longer than ``capacity``, offsets are gapless.

    ``pieces`` must be stored (its ``part`` and ``local_rank`` are read twice). Equal rows are packed one by one.
    An empty table gives an empty result.
    """
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (length, partition)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("length", "part", "base")

    def rounds(frame: pd.DataFrame) -> pd.DataFrame:
        plan = match_rounds(dict(zip(frame["length"].tolist(), frame["n"].tolist(), strict=True)), capacity)
        return pd.DataFrame(np.array(plan, dtype=np.int64).reshape(-1, 6), columns=[x.split()[0] for x in _PLAN_SCHEMA.split(", ")])

    # at most one row per length: the capacity bounds it
    plan = counts.groupBy("length").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(rounds, _PLAN_SCHEMA)
    plan = stored(plan, "packing-plan").withColumnRenamed("length", "__length")
    ranked = pieces.join(base, ["length", "part"]).withColumn("__rank", F.col("base") + F.col("local_rank"))
    placed = ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("rank_from")) & (F.col("__rank") < F.col("rank_to")),
    )
    k = F.col("__rank") - F.col("rank_from")
    return placed.withColumns({
        "sequence_id": F.expr("sequence_from + (__rank - rank_from) div per_sequence"),
        "offset": F.col("offset") + (k % F.col("per_sequence")) * F.col("length"),
    }).drop("__length", "__rank", "base", "rank_from", "rank_to", "per_sequence", "sequence_from", "part", "local_rank")


def packed_sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of :func:`pack` over pieces with ids: the sequences themselves."""
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    ).select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, *, capacity: int = 1024, vocabulary: str | None = None, end_id: int = 2) -> DataFrame:
    """Cut, rank and pack ``documents``: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    pieces = stored(token_pieces(docs, capacity=capacity, vocabulary=vocabulary, end_id=end_id).drop("ids"), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

"""Token-id files as compressed bit or byte planes.

Documents are range-partitioned by ``doc_id``; one partition becomes one shard, a stream of ids cut into chunks
of ``chunk_ids``. A chunk's ids are transposed into planes (plane *p* holds bit or byte *p* of every id) and each
plane is compressed with zstandard on its own, so that the empty high planes cost a few bytes. A chunk row also
lists the documents that touch it, which makes every chunk readable alone. ``<path>/chunks`` holds the chunks,
``<path>/index`` the chunk index: shard, chunk, its first id in the whole corpus, its ids and stored bytes.
Both are Parquet written by Spark's committer, so a lost executor leaves neither gaps nor halves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellspan.llm.common import text_slices
from cellspan.llm.tokens import byte_bpe_path, encoder

_CHUNK_SCHEMA = (
    "shard int, chunk int, chunk_start bigint, n_ids int, unit string, planes array<binary>, "
    "doc_ids array<bigint>, doc_starts array<bigint>, doc_lengths array<bigint>"
)


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of unsigned 32-bit ids, lowest first: 32 bit planes or 4 byte planes."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [octets[:, p].tobytes() for p in range(4)]
    planes = []
    for p in range(4):
        column = octets[:, p]
        planes += [np.packbits((column >> bit) & 1, bitorder="little").tobytes() for bit in range(8)]
    return planes


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    octets = np.zeros((n, 4), dtype=np.uint8)
    if unit == "byte":
        for p, plane in enumerate(planes):
            octets[:, p] = np.frombuffer(plane, dtype=np.uint8)
    else:
        for p, plane in enumerate(planes):
            bits = np.unpackbits(np.frombuffer(plane, dtype=np.uint8), count=n, bitorder="little")
            octets[:, p // 8] |= bits << (p % 8)
    return octets.reshape(-1).view("<u4")


def _chunk_writer(vocabulary: str, end_id: int, chunk_ids: int, unit: str, level: int):
    def chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        encode = encoder(vocabulary).encode_many
        press = zstandard.ZstdCompressor(level=level).compress
        shard, end = TaskContext.get().partitionId(), end_id.to_bytes(4, "little")
        width = 4 * chunk_ids
        waiting, number, total = bytearray(), 0, 0  # ids not in a chunk yet; the next chunk; ids so far
        touching: list[tuple[int | None, int, int]] = []  # documents that touch the next chunk

        def row(block: bytes) -> tuple:
            ids = np.frombuffer(block, dtype="<u4")
            doc_ids, starts, lengths = (list(x) for x in zip(*touching, strict=True))
            return shard, number, number * chunk_ids, len(ids), unit, [press(p) for p in to_planes(ids, unit)], doc_ids, starts, lengths

        names = [x.split()[0] for x in _CHUNK_SCHEMA.split(", ")]
        for part in text_slices(frames):
            rows = []
            keys = [None if pd.isna(k) else int(k) for k in part["doc_id"].tolist()]
            for key, ids in zip(keys, encode(part["text"].tolist()), strict=True):
                length = len(ids) // 4 + 1
                touching.append((key, total, length))
                total += length
                waiting += ids + end
                while len(waiting) >= width:
                    rows.append(row(bytes(waiting[:width])))
                    del waiting[:width]
                    number += 1
                    # only the last document can reach into the next chunk
                    touching = touching[-1:] if total > number * chunk_ids else []
            if rows:
                yield pd.DataFrame(rows, columns=names)
        if waiting:
            yield pd.DataFrame([row(bytes(waiting))], columns=names)

    return chunks


def write_planes(
    docs: DataFrame,
    path: str,
    *,
    vocabulary: str | None = None,
    end_id: int = 0,
    chunk_ids: int = 65_536,
    unit: str = "byte",
    level: int = 3,
) -> None:
    """Encode whole texts, append ``end_id`` to each, and write the ids in ascending ``doc_id`` order.

    Null text is empty text (one id, the end). A null ``doc_id`` sorts before all others and is kept. Rows with
    equal ``doc_id`` are separate documents, ordered by text. An empty table gives empty files. Other columns are
    not read. ``unit`` is ``byte`` or ``bit``.
    """
    if unit not in ("byte", "bit"):
        raise ValueError(f"unit is byte or bit, not {unit}")
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    writer = _chunk_writer(vocabulary or byte_bpe_path(), end_id, chunk_ids, unit, level)
    # the planes are compressed already
    ordered.mapInPandas(writer, _CHUNK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    chunks = spark.read.parquet(f"{path}/chunks")
    sizes = chunks.select(
        "shard", "chunk", "n_ids", F.aggregate("planes", F.lit(0).cast("bigint"), lambda a, p: a + F.octet_length(p)).alias("stored_bytes")
    )
    in_shard = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    (
        sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)))
        .join(F.broadcast(_shard_starts(chunks)), "shard")
        .select("shard", "chunk", (F.col("shard_start") + F.col("before")).alias("first_id"), "n_ids", "stored_bytes")
        .write.parquet(f"{path}/index")
    )


def _shard_starts(chunks: DataFrame) -> DataFrame:
    """The ids before each shard. One row per written partition, so the window and a broadcast of it are small."""
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
        .select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("bigint").alias("shard_start"))
    )


def _piece_reader(always: bool):
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        for frame in frames:
            for chunk in frame.itertuples(index=False):
                planes = [unpress(p) for p in chunk.planes]
                ids = from_planes(planes, chunk.n_ids, chunk.unit)
                first = chunk.chunk_start
                out = []
                for key, start, length in zip(chunk.doc_ids, chunk.doc_starts, chunk.doc_lengths, strict=True):
                    a, b = max(start, first) - first, min(start + length, first + chunk.n_ids) - first
                    block = ids[a:b].tobytes()
                    whole = b - a == length
                    out.append((None if pd.isna(key) else int(key), start, length, first + a, zlib.crc32(block) if whole else None, block if always or not whole else None))
                got = pd.DataFrame(out, columns=["doc_id", "doc_start", "n_tokens", "at", "crc", "ids"])
                got["doc_id"], got["crc"] = got["doc_id"].astype("Int64"), got["crc"].astype("Int64")
                yield got.assign(shard=chunk.shard)

    return pieces


def _pieces(spark: SparkSession, path: str, always: bool) -> DataFrame:
    chunks = spark.read.parquet(f"{path}/chunks")
    starts = F.broadcast(_shard_starts(spark.read.parquet(f"{path}/index")))
    schema = "doc_id bigint, doc_start bigint, n_tokens bigint, at bigint, crc bigint, ids binary, shard int"
    return chunks.mapInPandas(_piece_reader(always), schema).join(starts, "shard")


def _joined(found: DataFrame) -> DataFrame:
    """One row per document; the pieces of a document that spans chunks are set together in order."""
    return found.groupBy("shard", "doc_start").agg(
        F.first("doc_id").alias("doc_id"),
        F.first(F.col("shard_start") + F.col("doc_start")).alias("start"),
        F.first("n_tokens").alias("n_tokens"),
        F.max("crc").alias("crc"),
        F.sort_array(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("at", "ids")))).alias("pieces"),
    ).withColumn("bytes", F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"])))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document as (doc_id, start, n_tokens, ids): ``ids`` is little-endian unsigned 32-bit binary."""
    return _joined(_pieces(spark, path, True)).select("doc_id", "start", "n_tokens", F.col("bytes").alias("ids"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files; ids travel only for documents that span chunks."""
    return _joined(_pieces(spark, path, False)).select(
        "doc_id", "start", "n_tokens", F.coalesce("crc", F.crc32("bytes")).cast("bigint").alias("ids_crc32")
    )

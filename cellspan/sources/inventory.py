"""Input inventories and file checksums."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.operators.quality import drift_check
from cellspan.plans.storage import scratch_path

# most bytes of large files that one task reads
PIECE = 1 << 28

_TURN = "path string, size bigint, at bigint, state binary, digest string"

# the public contexts of OpenSSL's SHA256_ and MD5_ functions: their name, 32-bit words and bytes of the digest
_CONTEXTS = {"sha256": ("SHA256", 28, 32), "md5": ("MD5", 23, 16)}


def source_inventory(cells: DataFrame) -> DataFrame:
    """``cell_id, path, size, modified`` of discovered cells: what a later run is compared with."""
    return cells.select("cell_id", "path", "size", "modified")


def inventory_changes(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Entries that differ between two inventories; any row means the inputs changed."""
    return drift_check(stored, current)


class _Digest:
    """A digest that is put down as bytes and taken up by another task, which ``hashlib`` has no way for."""

    def __init__(self, library, algorithm: str, state: bytes | None):
        name, words, self.size = _CONTEXTS[algorithm]
        self._update, self._final = (getattr(library, f"{name}_{step}") for step in ("Update", "Final"))
        self._update.argtypes = ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t
        self._context = (ctypes.c_uint32 * words).from_buffer_copy(state or bytes(4 * words))
        if state is None and not getattr(library, f"{name}_Init")(ctypes.byref(self._context)):
            raise OSError(f"{name}_Init was refused")

    def update(self, data: bytes) -> None:
        self._update(ctypes.byref(self._context), data, len(data))

    def state(self) -> bytes:
        return bytes(self._context)

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(self.size)
        self._final(out, ctypes.byref(self._context))
        return out.raw.hex()


@cache
def _library(algorithm: str):
    """The OpenSSL library that ``hashlib`` is linked with, or None where its digests can't be taken up again."""
    try:
        import _hashlib

        library, text = ctypes.CDLL(_hashlib.__file__), bytes(range(200))
        first = _Digest(library, algorithm, None)
        first.update(text[:99])
        second = _Digest(library, algorithm, first.state())
        second.update(text[99:])
        return library if second.hexdigest() == hashlib.new(algorithm, text).hexdigest() else None
    except (ImportError, AttributeError, OSError):
        return None


def _read_on(algorithm: str, piece: int):
    """Takes files on from where the last turn left them, by ``piece`` bytes a task, however many files it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = piece
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                if not left:
                    break
                with open(row["path"].removeprefix("file:"), "rb") as file:
                    library = _library(algorithm)
                    if library is None:
                        row["digest"] = hashlib.file_digest(file, algorithm).hexdigest()
                        continue
                    running = _Digest(library, algorithm, row["state"])
                    file.seek(row["at"])
                    while todo := min(left, row["size"] - row["at"], 1 << 22):
                        data = file.read(todo)
                        if not data:
                            raise OSError(f"{row['path']} ended at {row['at']} of {row['size']} bytes")
                        running.update(data)
                        row["at"] += len(data)
                        left -= len(data)
                row["state"] = running.state()
                if row["at"] == row["size"]:
                    row["digest"] = running.hexdigest()
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return run


def _in_turns(files: DataFrame, algorithm: str, piece: int) -> DataFrame:
    """Digests of large local files: each turn is a job that reads the next piece of every file and stores the states."""
    spark = files.sparkSession
    folder = scratch_path(spark, "digests")
    rows = files.select("path", F.col("length").alias("size"), F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("binary").alias("state"), F.lit(None).cast("string").alias("digest"))
    turn = 0
    while left := rows.count():
        # a file a task
        rows.repartitionByRange(left, "path").mapInArrow(_read_on(algorithm, piece), _TURN).write.parquet(f"{folder}/turn={turn}")
        rows = spark.read.schema(_TURN).parquet(f"{folder}/turn={turn}").where("digest is null")
        turn += 1
    return spark.read.schema(_TURN).parquet(f"{folder}/turn=*").where("digest is not null").select("path", "size", "digest")


def file_checksums(spark: SparkSession, paths, algorithm: str = "sha256", *, piece: int = PIECE) -> DataFrame:
    """``path, size, digest`` of each file, of any size.

    Files above ``piece`` bytes are read when this is called, in turns: no task reads more than ``piece`` bytes of them, and the
    digest's state goes from turn to turn. A digest runs through its file in order, so there are as many turns as the largest file has
    pieces. That needs files that tasks can open (``file:``) and a Python whose ``hashlib`` is linked with OpenSSL; without the latter a
    file streams through one task. On other file systems files pass whole through a task and must be below 2 GB (binary column limit).
    """
    if piece < 1:
        raise ValueError("piece must be positive")
    files = spark.read.format("binaryFile").load(paths)
    # by the listing's columns, so that content is never read of files that a filter drops
    in_turns = (F.col("_metadata.file_size") > piece) & F.col("_metadata.file_path").startswith("file:")
    digest = {"sha256": F.sha2("content", 256), "md5": F.md5("content")}[algorithm]
    whole = files.where(~in_turns).select("path", F.col("length").alias("size"), digest.alias("digest"))
    large = files.where(in_turns).select("path", "length")
    return whole if large.isEmpty() else whole.unionByName(_in_turns(large, algorithm, piece))


def checksum_mismatches(observed: DataFrame, declared: DataFrame) -> DataFrame:
    """Declared digests (``path, digest``) that a file lacks or contradicts, ignoring case."""
    want = declared.select("path", F.lower(F.trim("digest")).alias("declared"))
    got = observed.select("path", F.lower("digest").alias("observed"))
    return want.join(got, "path", "left").where(~F.col("declared").eqNullSafe(F.col("observed")))

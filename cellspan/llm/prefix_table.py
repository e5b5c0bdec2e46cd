"""The prefix trie of conversations in sharded node tables addressed by minimal perfect hashes.

Every prefix of a conversation is a node, named by a chained 128-bit digest of its turns. A first, linear aggregation
counts for every node the turns at and below it. Nodes with more than ``limit`` of them are the top of the trie; what
hangs below the top are whole subtrees of at most ``limit`` nodes, which are dealt to shards by the digest of their root.

A shard enumerates its digests, gives each a slot by a minimal perfect hash (levels of bit arrays: a key stays on the first
level where it meets no other), checks every slot against the digest stored there, scatters counts into flat arrays, and
adds each depth to its parents' slots, deepest first. The top is one more such table; its size is bounded by arithmetic,
since the counts of all nodes together are the sum of (length + 1)(length + 2) / 2 over the conversations.

Turns are hashed before they are moved, and conversations are read as streams: no text, conversation or list of members
is ever held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspan.llm.common import stored

#: Nodes of a subtree that a shard may hold, at least; rises only where the top would have more than TOP_NODES.
LIMIT = 32_768
#: Nodes of the top at most, which one task holds and which are broadcast.
TOP_NODES = 1_000_000

ROOT = bytes(16)


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of 128-bit keys (two columns) for one level."""
    salt = np.uint64((level + 1) * 0xD6E8FEB86659FD93 % 2**64)
    x = words[:, 0] ^ (words[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ salt
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class SlotTable:
    """A minimal perfect hash of distinct 128-bit digests, with the digests at their slots to verify a look-up.

    Level by level a bit array of twice the remaining keys is filled; keys alone at their position stay, the others go
    down. A key's slot is the number of set bits before its own.
    """

    def __init__(self, digests: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, base = digests, 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("digests to be enumerated are not distinct")
            at = (_mixed(left, len(self.levels)) % np.uint64(2 * len(left))).astype(np.int64)
            alone = np.bincount(at, minlength=2 * len(left)) == 1
            self.levels.append((alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            left = left[~alone[at]]
        self.digests = np.zeros((base, 2), dtype=np.uint64)
        slots = self._probe(digests)
        self.digests[slots] = digests
        if len(digests) != base or not np.array_equal(self.digests[slots], digests):
            raise ValueError("two digests share a slot")

    def _probe(self, digests: np.ndarray) -> np.ndarray:
        slots = np.full(len(digests), -1, dtype=np.int64)
        open_rows = np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            at = (_mixed(digests[open_rows], level) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[at]
            slots[open_rows[hit]] = rank[at[hit]]
            open_rows = open_rows[~hit]
        return slots

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for a digest that was not enumerated."""
        if not len(self.digests):
            return np.full(len(digests), -1, dtype=np.int64)
        slots = self._probe(digests)
        known = slots >= 0
        known[known] = (self.digests[slots[known]] == digests[known]).all(axis=1)
        return np.where(known, slots, -1)


def _words(column: pd.Series) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 2), dtype=np.uint64)
    return np.frombuffer(b"".join(column), dtype="<u8").reshape(-1, 2).astype(np.uint64)


def _accumulated(frame: pd.DataFrame) -> pd.DataFrame:
    """Node rows with parent's member, children, and leaves and saved tokens summed over subtrees.

    ``under_children``, ``under_leaves`` and ``under_saved`` are what subtrees outside this table add to a node.
    """
    digests = _words(frame["node"])
    table = SlotTable(digests)
    at, n = table.slots(digests), len(frame)
    parent = np.full(n, -1, dtype=np.int64)
    has = frame["parent"].notna().to_numpy()
    parent[at[has]] = table.slots(_words(frame["parent"][has]))
    depth, members, smallest, size, children, leaves, saved = (np.zeros(n, dtype=np.int64) for _ in range(7))
    for array, name in ((depth, "depth"), (members, "n_convs"), (smallest, "conv_id"), (size, "text_bytes"), (children, "under_children"),
                        (leaves, "under_leaves"), (saved, "under_saved")):
        array[at] = frame[name].to_numpy(dtype=np.int64)
    saved += (members - 1) * size
    held = parent >= 0
    np.add.at(children, parent[held], 1)
    leaves[children == 0] = 1
    by_depth = np.argsort(-depth, kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    above = pd.array(np.where(held, smallest[np.maximum(parent, 0)], 0), dtype="Int64")
    above[~held] = pd.NA
    return frame.assign(parent_conv_id=above[at], n_children=children[at], n_leaves=leaves[at], saved_tokens=saved[at])[_NODE_COLUMNS]


_NODE_COLUMNS = ["node", "parent", "depth", "conv_id", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"]
_NODE_SCHEMA = ("node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, parent_conv_id bigint, n_children bigint, "
                "n_leaves bigint, saved_tokens bigint")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn_digest, text_bytes): turns in order, hashed; null role or text is empty, null turns come first.

    Turns that share a number are ordered by digest. Rows without ``conv_id`` are left out. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint").alias("turn"), said.alias("turn_digest"),
        F.octet_length(text).cast("bigint").alias("text_bytes"),
    )
    along = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_digest")
    return rows.withColumn("position", F.row_number().over(along).cast("bigint")).drop("turn")


def rebuilt(turns: DataFrame, *, every: int = 5, longest: int = 8) -> DataFrame:
    """``turns`` of conversations rebuilt to share beginnings, as :func:`turn_rows` gives them.

    Conversation c takes the first h turns of c - c % ``every`` (fewer or none if it has no more), and its own after
    its first h; h is the CRC-32 of the decimal c modulo ``longest`` + 1.
    """
    head = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % (longest + 1)
    ids = turns.select("conv_id").distinct()
    own = turns.where(F.col("position") > head("conv_id"))
    wanted = ids.withColumn("first", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", head("conv_id"))
    # a conversation lends its first turns to fewer than 2 * every others: no key of this join is hot
    lent = turns.where(F.col("position") <= longest).withColumnRenamed("conv_id", "first").join(wanted, "first").where("position <= h")
    # a marker keeps conversations that end up without turns
    marks = ids.select("conv_id", F.lit(0).cast("bigint").alias("position"), F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("bigint").alias("text_bytes"))
    return own.unionByName(lent.select(*own.columns)).unionByName(marks.select(*own.columns))


_PATHS = pa.schema([("conv_id", pa.int64()), ("nodes", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64()))])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    rows, conv, held = [], None, 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PATHS.types, strict=True)], schema=_PATHS)

    for part in batches:
        for key, digest, size in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            if key != conv:
                if held > 50_000:
                    yield batch()
                    rows, held = [], 0
                rows.append((key, [ROOT], [0]))
                conv, node = key, ROOT
            if digest is not None:
                node = xxhash.xxh3_128_digest(node + digest)
                rows[-1][1].append(node)
                rows[-1][2].append(size)
                held += 1
    if rows:
        yield batch()


def node_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, nodes, sizes): the digests of each conversation's prefixes, the root first, and bytes of their last texts."""
    narrow = turns.select("conv_id", "turn_digest", "text_bytes", "position")
    return narrow.repartition("conv_id").sortWithinPartitions("conv_id", "position").drop("position").mapInArrow(
        _paths, "conv_id bigint, nodes array<binary>, sizes array<bigint>")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the members of each node, which come sorted."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    done, node, running = [], None, None
    for batch in batches:
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = key, hashlib.sha256(str(conv).encode())
            else:
                running.update(f",{conv}".encode())
        if len(done) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)
            done = []
    if node is not None:
        done.append((node, running.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)


def prefix_nodes(turns: DataFrame, *, limit: int = LIMIT, top_nodes: int = TOP_NODES) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (as :func:`turn_rows` or :func:`rebuilt` give them).

    (node, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): ``conv_id`` is the smallest
    member, ``n_leaves`` counts childless nodes of the subtree, ``saved_tokens`` sums (members - 1) times the bytes of the last
    text over it, ``ends_sha256`` digests the ascending ids of the members that end here. Copies of a conversation are
    members of the same nodes. An empty table has no node, not even the root.
    """
    paths = stored(node_paths(turns), "prefix-paths")
    length = F.size("nodes").cast("double")
    mass = paths.agg(F.sum(length * (length + 1) / 2)).first()[0] or 0
    limit = max(limit, int(mass // top_nodes) + 1)
    parents = F.concat(F.array(F.lit(None).cast("binary")), F.slice("nodes", 1, F.size("nodes") - 1))
    steps = F.posexplode(F.arrays_zip("nodes", parents.alias("parents"), "sizes")).alias("depth", "step")

    def along(df: DataFrame, *more: str) -> DataFrame:
        return df.select("conv_id", *more, F.size("nodes").alias("n"), steps).select(
            "conv_id", *more, F.col("depth").cast("bigint"), F.col("step.nodes").alias("node"), F.col("step.parents").alias("parent"),
            F.col("step.sizes").alias("text_bytes"), (F.col("n") - F.col("depth")).alias("below"))

    # all these counts sum to mass, and each is above limit: fewer than top_nodes rows
    top = stored(along(paths).groupBy("node").agg(F.sum("below").alias("below")).where(F.col("below") > limit).select("node"), "prefix-top")
    # the top part of a conversation is a beginning of its path: its length tells where a subtree starts
    crossed = along(paths).join(F.broadcast(top), "node").groupBy("conv_id").agg(F.count(F.lit(1)).alias("k"))
    cut = paths.join(crossed, "conv_id", "left").withColumn("k", F.coalesce("k", F.lit(0)).cast("int")).withColumn("subtree", F.get("nodes", F.col("k")))
    same = (F.min("parent").eqNullSafe(F.max("parent"))) & (F.min("text_bytes") == F.max("text_bytes")) & (F.min("depth") == F.max("depth"))
    nodes = stored(
        along(cut, "subtree", "k").groupBy("node").agg(
            F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("text_bytes").alias("text_bytes"), F.min("conv_id").alias("conv_id"),
            F.when(same, F.count(F.lit(1))).otherwise(F.raise_error("two prefixes share a digest").cast("bigint")).alias("n_convs"),
            F.min(F.when(F.col("depth") >= F.col("k"), F.col("subtree"))).alias("subtree"),
        ), "prefix-nodes",
    )
    nothing = [F.lit(0).cast("bigint").alias(f"under_{x}") for x in ("children", "leaves", "saved")]
    shards = max(1, -(-nodes.count() // limit))
    lower = stored(
        nodes.where("subtree is not null").withColumn("shard", F.pmod(F.xxhash64("subtree"), F.lit(shards))).select("*", *nothing)
        .groupBy("shard").applyInPandas(_accumulated, _NODE_SCHEMA), "prefix-subtrees",
    )
    hanging = lower.where("parent is not null and parent_conv_id is null").groupBy("parent").agg(
        F.count(F.lit(1)).alias("under_children"), F.sum("n_leaves").alias("under_leaves"), F.sum("saved_tokens").alias("under_saved"))
    upper = stored(
        nodes.where("subtree is null").join(hanging.withColumnRenamed("parent", "node"), "node", "left").fillna(0, ["under_children", "under_leaves", "under_saved"])
        .groupBy(F.lit(0).alias("all")).applyInPandas(_accumulated, _NODE_SCHEMA), "prefix-top-nodes",
    )
    above = F.broadcast(upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("__above")))
    whole = upper.unionByName(lower.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "__above")).drop("__above"))
    ends = paths.select(F.element_at("nodes", -1).alias("node"), "conv_id").repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(
        _ends, "node binary, ends_sha256 string")
    return whole.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))).select(
        "node", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

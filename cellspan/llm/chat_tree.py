"""Conversations as a prefix tree of formatted turns.

A turn becomes ``<turn role>``, its escaped text and ``</turn>``. Conversations with equal first turns share those
nodes: a node is named by the hash of its path. Conversations are ranked by their path of hashes; a node belongs
to the first conversation that holds it, so that (rank, depth) is a depth-first order, and blocked prefix sums give
each node its place in the token stream. Every node's ids are written once, with the position ids of its path
and the token intervals of its ancestors, which are all that it may attend to besides itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellspan.llm.common import stored
from cellspan.llm.tokens import byte_bpe_path, encoder
from cellspan.plans.prefix import BLOCK, ordered_blocks, prefix_sum

_TURN_SCHEMA = "conv_id bigint, position int, n_turns int, path binary, node binary, parent binary, role string, text string"
_TO = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_FROM = {"\\": "\\", "l": "<", "g": ">"}
_CONTROL = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_SEGMENT = re.compile(r"<turn ([^>]*)>\n([^<]*)\n</turn>\n")


def escape(text: str) -> str:
    """``text`` without any character that a control string needs."""
    return _CONTROL.sub(lambda m: _TO[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _FROM[m[1]], text)


def segment(role: str, text: str) -> tuple[str, str, str]:
    """Opening, body and closing of a formatted turn."""
    return f"<turn {escape(role)}>\n", escape(text), "\n</turn>\n"


def _paths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import xxhash

    names = [x.split()[0] for x in _TURN_SCHEMA.split(", ")]
    for frame in frames:
        rows = []
        for conv, roles, texts in zip(frame["conv_id"].tolist(), frame["roles"], frame["texts"], strict=True):
            node, nodes, digest = b"", [], xxhash.xxh3_128()
            for role, text in zip(roles, texts, strict=True):
                for x in (role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")):
                    digest.update(len(x).to_bytes(8, "little") + x)
                nodes.append(digest.digest())
            path = b"".join(n[:8] for n in nodes)
            for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
                rows.append((conv, i, len(nodes), path if i == 0 else None, nodes[i], node, role, text))
                node = nodes[i]
        out = pd.DataFrame(rows, columns=names)
        out["conv_id"] = out["conv_id"].astype("Int64")
        yield out


def _node_tokens(vocabulary: str, loss_role: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode_many
        for frame in frames:
            parts = [segment(r, t) for r, t in zip(frame["role"], frame["text"], strict=True)]
            ids = [encode([p[i] for p in parts]) for i in range(3)]
            sizes = [[len(x) // 4 for x in part] for part in ids]
            loss = (frame["role"] == loss_role).to_numpy()
            first = np.array(sizes[0], dtype=np.int64)
            body = np.array(sizes[1], dtype=np.int64)
            yield frame.drop(columns=["text"]).assign(
                ids=[b"".join(x) for x in zip(*ids, strict=True)], n_tokens=first + body + np.array(sizes[2], dtype=np.int64),
                loss_from=np.where(loss, first, 0), loss_to=np.where(loss, first + body, 0),
            )

    return run


def write_tree(turns: DataFrame, path: str, *, vocabulary: str | None = None, loss_role: str = "assistant") -> None:
    """Write ``<path>/nodes`` (depth-first) and ``<path>/conversations`` (conv_id, position, node).

    Turns of a conversation are ordered by turn, role and text; null text or role is empty, a null turn comes first,
    rows without ``conv_id`` form one conversation, repeated rows are turns of their own. An empty table gives empty
    files. Other columns are not read.

    A node has node, parent, depth, role, n_conversations, start (its first token in the stream), position (the
    position id of that token; the rest count on), n_tokens, ids, loss_from and loss_to (its tokens under the loss
    mask), attends (token intervals of its ancestors, outermost first).
    """
    clean = turns.select(
        F.col("conv_id").cast("bigint"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    whole = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    rows = stored(
        whole.select("conv_id", F.transform("t", lambda x: x["role"]).alias("roles"), F.transform("t", lambda x: x["text"]).alias("texts"))
        .mapInPandas(_paths, _TURN_SCHEMA), "turns",
    )
    order = [F.col("path"), F.col("conv_id")]
    ranked = prefix_sum(
        ordered_blocks(rows.where("position = 0").select("conv_id", "path", F.lit(1).cast("bigint").alias("one")), order), order, "one", "rank"
    ).select(F.col("conv_id").alias("__conv"), "rank")
    narrow = stored(
        rows.select("conv_id", "position", "n_turns", "node").join(ranked, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv"), "ranked-turns"
    )
    first = narrow.groupBy("node").agg(F.min("rank").alias("first_rank"), F.count(F.lit(1)).alias("n_conversations"))
    distinct = rows.groupBy("node").agg(F.first("parent").alias("parent"), F.first("position").alias("depth"), F.first("role").alias("role"), F.first("text").alias("text"))
    schema = "node binary, parent binary, depth int, role string, ids binary, n_tokens bigint, loss_from bigint, loss_to bigint"
    nodes = stored(distinct.mapInPandas(_node_tokens(vocabulary or byte_bpe_path(), loss_role), schema), "nodes")
    depth_first = [F.col("first_rank"), F.col("depth")]
    layout = stored(
        prefix_sum(ordered_blocks(nodes.select("node", "depth", "n_tokens").join(first, "node"), depth_first), depth_first, "n_tokens", "start")
        .drop(BLOCK), "layout",
    )
    along = Window.partitionBy("rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    interval = F.struct(F.col("start").alias("from"), (F.col("start") + F.col("n_tokens")).alias("to"))
    placed = (
        narrow.select("rank", "node").join(layout, "node")
        .withColumn("position", F.coalesce(F.sum("n_tokens").over(along), F.lit(0)))
        .withColumn("attends", F.collect_list(interval).over(along))
        .where("rank = first_rank").select("node", "n_conversations", "start", "position", "attends")
    )
    nodes.join(placed, "node").repartitionByRange("start").sortWithinPartitions("start").write.parquet(f"{path}/nodes")
    narrow.select("conv_id", "position", "n_turns", "node").write.parquet(f"{path}/conversations")


def _decoded(vocabulary: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Tokenizer

        decode = Tokenizer.from_file(vocabulary).decode
        for frame in frames:
            rows = []
            for node, ids, a, b in zip(frame["node"], frame["ids"], frame["loss_from"], frame["loss_to"], strict=True):
                numbers = np.frombuffer(ids, dtype="<u4").tolist()
                formatted = decode(numbers, skip_special_tokens=False)
                role, body = _SEGMENT.fullmatch(formatted).groups()
                masked = unescape(decode(numbers[a:b], skip_special_tokens=False)) if b > a else ""
                rows.append((node, unescape(role), unescape(body), len(formatted), masked))
            yield pd.DataFrame(rows, columns=["node", "role", "text", "formatted_chars", "loss_text"])

    return run


def read_conversations(spark: SparkSession, path: str, *, vocabulary: str | None = None) -> DataFrame:
    """(conv_id, n_turns, turns, loss_text, formatted_chars) from the files: ids decoded, texts unescaped.

    ``turns`` has (position, role, text) in order; ``loss_text`` is all text under the loss mask.
    """
    nodes = spark.read.parquet(f"{path}/nodes").select("node", "ids", "loss_from", "loss_to").mapInPandas(
        _decoded(vocabulary or byte_bpe_path()), "node binary, role string, text string, formatted_chars bigint, loss_text string"
    )
    turns = spark.read.parquet(f"{path}/conversations").join(nodes, "node")
    return turns.groupBy("conv_id").agg(
        F.max("n_turns").cast("bigint").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("position", "role", "text", "loss_text"))).alias("turns"),
        F.sum("formatted_chars").alias("formatted_chars"),
    ).withColumn("loss_text", F.array_join(F.transform("turns", lambda t: t["loss_text"]), ""))

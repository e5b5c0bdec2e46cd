"""Near-duplicate vectors by a dual traversal of cover trees: exact threshold pairs, counted but never listed in dense groups.

Unit vectors are compared by chord length, cosine c being sqrt(2 - 2c). Each label has a tree: a node's centre covers its
vectors, its children's centres are vectors of the node more than the child radius apart, and radii halve from level to level;
the node's own centre stays a centre below it. Centres are drawn by hash in bounded batches, vectors that no centre covers form
a rest node that gets the next batch. A node is a leaf once it is small, once all its pairs are surely links, or once a batch
covers too little of it to go on (vectors that are all far from each other have no smaller cover).

Pairs of nodes are then compared from the roots down by their centres' distance and true covering radii: surely apart, they
are dropped; surely together, they are counted for both nodes as a whole; else the wider node is replaced by its children. Only
leaf pairs that stay are compared vector by vector, block against block, and give counts and a spanning forest, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspan.llm.common import join_by_counted_key, stored
from cellspan.llm.near_copies import components

#: Vectors of a block: a leaf that is not all links has at most so many, unless it can't be covered.
BLOCK = 2048
#: Centres drawn for a node at a time, vectors a child must have, and the share a batch must cover to try another.
CENTRES, LEAST_CHILD, WORTH = 128, 16, 0.5
#: Vectors that one group of a task reads against the centres of its node.
CHUNK = 65_536
#: Margin of all radius bounds, above the rounding of chord lengths near zero.
SLACK = 1e-6


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    offsets = column.offsets.to_numpy(zero_copy_only=False)
    return column.values.to_numpy(zero_copy_only=False), offsets


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of label and components for each vector that can have links, else null."""
    import xxhash

    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("key", pa.binary()), ("vec", pa.list_(pa.float64()))])
    for batch in batches:
        ids, labels, found = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        keys, dims, vecs = [], [], []
        for vec_id, label, vec in zip(ids.to_pylist(), labels, found, strict=True):
            key = out = None
            if vec_id is not None and label is not None and vec and None not in vec:
                values = np.array(vec, dtype=np.float64) + 0.0
                if np.isfinite(values).all() and values.any():
                    key, out = xxhash.xxh3_128_digest(label.encode() + b"\0" + values.tobytes()), vec
            keys.append(key)
            vecs.append(out)
            dims.append(len(vec) if out is not None else None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(labels, pa.string()), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(vecs, pa.list_(pa.float64()))], schema=schema)


def _thinned(level_radius):
    """Centres of open nodes: the node's own first, then drawn vectors that lie apart."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for node, level, own, drawn in zip(frame["node"], frame["level"], frame["centre"], frame["drawn"], strict=True):
                radius = level_radius(level + 1)
                pids, vectors = [-1], _unit(np.array([own], dtype=np.float64))
                others = np.array([d["vec"] for d in drawn], dtype=np.float64).reshape(len(drawn), -1)
                if len(drawn):
                    others = _unit(others)
                for d, v in zip(drawn, others, strict=True):
                    if (_chords(v[None], vectors) > radius).all():
                        pids.append(d["pid"])
                        vectors = np.vstack([vectors, v])
                rows.append((node, level, pids, vectors.ravel()))
            yield pd.DataFrame(rows, columns=["node", "level", "pids", "centres"])

    return run


def level_radius(level: int) -> float:
    return 2.0 / 2**level


_ASSIGNED = ("pid bigint, weight bigint, vec array<double>, node string, level int, child string, centre array<double>, distance double, "
             "node_distance double")


def _assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every vector's nearest centre within the child radius; each group's centres come before its vectors."""
    centres = pids = level = None
    for batch in batches:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        kinds = col["kind"].to_numpy(zero_copy_only=False)
        nodes = col["node"].to_pylist()
        heads = np.flatnonzero(kinds == 0)
        cuts = sorted({0, len(kinds), *heads.tolist(), *(heads + 1).tolist()})
        for a, b in zip(cuts, cuts[1:], strict=False):
            if kinds[a] == 0:
                pids = col["pids"][a].as_py()
                centres = np.array(col["vec"][a].as_py()).reshape(len(pids), -1)
                level = col["level"][a].as_py()
                continue
            values, offsets = _lists(col["vec"].slice(a, b - a))
            unit = _unit(values[offsets[0] : offsets[-1]].reshape(b - a, -1))
            far = _chords(unit, centres)
            near = far.argmin(axis=1)
            distance = far[np.arange(b - a), near]
            inside = distance <= level_radius(level + 1)
            # the node's own centre stays one below it under a name of its own
            names = [f"{level + 1}:{pids[k]}" if pids[k] >= 0 else f"{level + 1}:{nodes[a]}" for k in near]
            yield pa.RecordBatch.from_arrays(
                [col["pid"].slice(a, b - a), col["weight"].slice(a, b - a), col["vec"].slice(a, b - a), pa.array(nodes[a:b], pa.string()),
                 pa.array([level] * (b - a), pa.int32()), pa.array([n if i else None for n, i in zip(names, inside, strict=True)], pa.string()),
                 pa.array([centres[k] if i else None for k, i in zip(near, inside, strict=True)], pa.list_(pa.float64())),
                 pa.array(distance), pa.array(far[:, 0])],
                names=["pid", "weight", "vec", "node", "level", "child", "centre", "distance", "node_distance"],
            )


def grow(points: DataFrame, *, threshold: float, block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """Cover trees of ``points`` (pid, root, vec, weight): the node table and the vectors with their leaves, in parts."""
    reach = math.sqrt(2 - 2 * threshold)
    roots = points.groupBy("root").agg(F.min_by("vec", F.xxhash64("pid")).alias("centre"), F.count(F.lit(1)).alias("n"), F.sum("weight").alias("mass"),
                                       F.min("pid").alias("member"))
    nodes = stored(roots.select(F.col("root").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("level"), "centre",
                                F.lit(level_radius(0)).alias("radius"), "n", "mass", "member", (F.col("n") <= block).alias("leaf")), "tree-nodes")
    placed = join_by_counted_key(points.withColumnRenamed("root", "node"), nodes.select("node", "n", "leaf"), "node", "n")
    table, leaves = [nodes], [placed.where("leaf").select("pid", "weight", "vec", "node")]
    opened, waiting = nodes.where("not leaf"), placed.where("not leaf")
    turn = 0
    while not opened.isEmpty():
        turn += 1
        # some half more than wanted are drawn on average; any drawn set gives a valid tree
        chance = F.pmod(F.xxhash64("pid", F.lit(turn)), F.lit(1 << 40)) < F.lit(float(CENTRES * (1 << 40))) / F.col("n")
        drawn = waiting.where(chance).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("pid", "vec"))).alias("drawn"))
        heads = stored(
            opened.select("node", "level", "centre", "n").join(drawn, "node", "left").withColumn("drawn", F.coalesce("drawn", F.array()))
            .select("node", "level", "centre", "drawn").mapInPandas(_thinned(level_radius), "node string, level int, pids array<bigint>, centres array<double>")
            .join(opened.select("node", "n"), "node"), "centres",
        )
        parts = F.ceil(F.col("n") / CHUNK).cast("int")
        none = lambda kind: F.lit(None).cast(kind)
        first = heads.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(
            "node", "part", F.lit(0).alias("kind"), "level", "pids", none("bigint").alias("pid"), none("bigint").alias("weight"), F.col("centres").alias("vec"))
        rows = waiting.select("node", F.pmod(F.xxhash64("pid"), parts).cast("int").alias("part"), F.lit(1).alias("kind"), none("int").alias("level"),
                              none("array<bigint>").alias("pids"), "pid", "weight", F.col("vec").cast("array<double>").alias("vec"))
        assigned = stored(
            first.unionByName(rows).repartition("node", "part").sortWithinPartitions("node", "part", "kind").mapInArrow(_assigned, _ASSIGNED), "assigned")
        slot = F.coalesce("child", F.concat(F.lit("rest:"), "node"))
        groups = assigned.groupBy("node", "level", slot.alias("slot")).agg(
            F.first("child").alias("child"), F.min_by("centre", "pid").alias("centre"), F.count(F.lit(1)).alias("n"), F.sum("weight").alias("mass"),
            F.max("distance").alias("radius"), F.max("node_distance").alias("rest_radius"), F.min("pid").alias("member"))
        groups = stored(groups.withColumn("own", F.col("child").isNotNull() & (F.col("n") >= LEAST_CHILD)), "tree-groups")
        closed = lambda n, radius: (n <= block) | (2 * radius <= reach - SLACK)
        children = groups.where("own").select(
            F.col("slot").alias("node"), F.col("node").alias("parent"), (F.col("level") + 1).alias("level"), "centre", "radius", "n", "mass", "member",
            closed(F.col("n"), F.col("radius")).alias("leaf"))
        total = groups.groupBy("node").agg(F.sum("n").alias("all"))
        rest = groups.where("not own").groupBy("node", "level").agg(
            F.sum("n").alias("n"), F.sum("mass").alias("mass"), F.max("rest_radius").alias("radius"), F.min("member").alias("member"))
        rest = rest.join(total, "node").join(opened.select("node", "centre"), "node").select(
            F.concat(F.lit(f"{turn}rest:"), "node").alias("node"), F.col("node").alias("parent"), "level", "centre", "radius", "n", "mass", "member",
            (closed(F.col("n"), F.col("radius")) | (F.col("n") > (1 - WORTH) * F.col("all"))).alias("leaf"))
        made = stored(children.unionByName(rest), "tree-nodes")
        table.append(made)
        names = groups.select("slot", F.when(F.col("own"), F.col("slot")).otherwise(F.concat(F.lit(f"{turn}rest:"), "node")).alias("to"), F.col("n").alias("slot_n"))
        lookup = stored(names.join(made.select(F.col("node").alias("to"), "n", "leaf"), "to"), "tree-slots")
        placed = join_by_counted_key(assigned.select("pid", "weight", "vec", slot.alias("slot")), lookup, "slot", "slot_n").select(
            "pid", "weight", "vec", F.col("to").alias("node"), "n", "leaf")
        leaves.append(placed.where("leaf").select("pid", "weight", "vec", "node"))
        opened, waiting = made.where("not leaf"), placed.where("not leaf")
    whole = table[0]
    for part in table[1:]:
        whole = whole.unionByName(part)
    return stored(whole, "cover-trees"), leaves


def _distances(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            distance = np.empty(len(frame))
            dims = frame["centre_a"].str.len().to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                a, b = (_unit(np.stack(frame[c].iloc[rows].to_list()).astype(np.float64)) for c in ("centre_a", "centre_b"))
                distance[rows] = np.sqrt(np.maximum(2 - 2 * (a * b).sum(axis=1), 0))
            yield frame.drop(columns=["centre_a", "centre_b"]).assign(distance=distance)


def traverse(nodes: DataFrame, *, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Leaf pairs (a, b) still to be compared, and pairs of nodes (a, b) that are linked as a whole; a = b is a node with itself."""
    reach = math.sqrt(2 - 2 * threshold)
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("centre").alias(f"centre_{x}"), F.col("radius").alias(f"radius_{x}"), F.col("leaf").alias(f"leaf_{x}"))
    roots = nodes.where("parent is null").select(F.col("node").alias("a"), F.col("node").alias("b"))
    schema = "a string, b string, radius_a double, leaf_a boolean, radius_b double, leaf_b boolean, distance double"
    pairs, compare, linked = roots, [], []
    children = nodes.where("parent is not null").select("parent", F.col("node").alias("child"))
    while True:
        seen = stored(
            pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "radius_a", "leaf_a", "radius_b", "leaf_b", "centre_a", "centre_b")
            .mapInPandas(_distances, schema), "node-pairs",
        )
        both = F.when(F.col("a") == F.col("b"), 2 * F.col("radius_a")).otherwise(F.col("distance") + F.col("radius_a") + F.col("radius_b"))
        gap = F.col("distance") - F.col("radius_a") - F.col("radius_b")
        together, apart = both <= reach - SLACK, (F.col("a") != F.col("b")) & (gap > reach + SLACK)
        linked.append(seen.where(together).select("a", "b"))
        unsure = seen.where(~together & ~apart)
        compare.append(unsure.where("leaf_a and leaf_b").select("a", "b"))
        wide = unsure.where("not (leaf_a and leaf_b)")
        if wide.isEmpty():
            break
        split_a = ~F.col("leaf_a") & (F.col("leaf_b") | (F.col("radius_a") >= F.col("radius_b")))
        one = wide.where("a <> b").select(F.when(split_a, F.col("a")).otherwise(F.col("b")).alias("parent"), F.when(split_a, F.col("b")).otherwise(F.col("a")).alias("other"))
        lower = one.join(children, "parent").select(F.least("child", "other").alias("a"), F.greatest("child", "other").alias("b"))
        selves = wide.where("a = b").select(F.col("a").alias("parent")).join(children, "parent")
        within = selves.alias("x").join(selves.alias("y"), (F.col("x.parent") == F.col("y.parent")) & (F.col("x.child") <= F.col("y.child"))).select(
            F.col("x.child").alias("a"), F.col("y.child").alias("b"))
        pairs = lower.unionByName(within)
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return stored(union(compare), "leaf-pairs"), stored(union(linked), "linked-nodes")


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({
            "leaf": frame["leaf"], "part": frame["part"], "pids": [[r["pid"] for r in rows] for rows in frame["rows"]],
            "weights": [[r["weight"] for r in rows] for rows in frame["rows"]],
            "matrix": [_unit(np.array([r["vec"] for r in rows], dtype=np.float64)).tobytes() for rows in frame["rows"]],
        })


def forest(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """Smallest reachable index of each of ``count`` points under the links (left, right)."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _compared(threshold: float):
    """Link counts and spanning links of block pairs: (pid, root, links), root being a linked vector's pid."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                p, q = np.array(row.pids_a), np.array(row.pids_b)
                a = np.frombuffer(row.matrix_a).reshape(len(p), -1)
                b = np.frombuffer(row.matrix_b).reshape(len(q), -1)
                alone = row.a == row.b and row.part_a == row.part_b
                wa, wb = np.array(row.weights_a, dtype=np.int64), np.array(row.weights_b, dtype=np.int64)
                counts_a, counts_b, lefts, rights = np.zeros(len(p), dtype=np.int64), np.zeros(len(q), dtype=np.int64), [], []
                for at in range(0, len(p), 512):
                    close = a[at : at + 512] @ b.T >= threshold
                    if alone:  # a vector is its own copy, whatever rounding says
                        close[np.arange(len(close)), at + np.arange(len(close))] = True
                    i, j = np.nonzero(close)
                    counts_a[at : at + 512] = np.bincount(i, weights=wb[j], minlength=len(close)).astype(np.int64)
                    np.add.at(counts_b, j, wa[at + i])
                    lefts.append(at + i)
                    rights.append(j)
                left, right = np.concatenate(lefts), np.concatenate(rights)
                if alone:
                    label, ids, counts = forest(left, right, len(p)), p, counts_a
                else:
                    label, ids = forest(left, right + len(p), len(p) + len(q)), np.concatenate([p, q])
                    counts = np.concatenate([counts_a, counts_b])
                hit = counts > 0
                out.append(pd.DataFrame({"pid": ids[hit], "root": ids[label[hit]], "links": counts[hit]}))
            if out:
                yield pd.concat(out)

    return run


def near_vectors(vectors: DataFrame, *, threshold: float = 0.93, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of one label are linked when their cosine, in double precision, is at least ``threshold`` (above 0). ``n_links`` counts the
    other vectors linked directly, copies included; equal rows are one vector. Components are named by their smallest
    ``vec_id`` and ``kept`` marks that vector. A vector that is null, empty, zero or holds a null or a number that is not
    finite has no links, nor has one without label or ``vec_id`` (its component is null and it is kept), nor two of unlike
    length. Vectors that share a ``vec_id`` are one member of their component. Other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    base = stored(rows.mapInArrow(_keyed, "vec_id bigint, label string, dim int, key binary, vec array<double>"), "vectors")
    usable = base.where("key is not null")
    # copies fold before the shuffle; ids of classes are fixed once they are written
    copies = stored(usable.groupBy("key", "vec_id").agg(F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vec").alias("vec")), "distinct-vectors")
    classes = stored(
        copies.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.concat_ws("|", F.lit("0"), F.first("dim"), F.first("label")).alias("root"),
                                  F.first("vec").alias("vec")).withColumn("pid", F.monotonically_increasing_id()), "vector-classes",
    )
    nodes, leaves = grow(classes.select("pid", "root", "vec", "weight"), threshold=threshold, block=block)
    placed = leaves[0]
    for part in leaves[1:]:
        placed = placed.unionByName(part)
    placed = stored(placed.withColumnRenamed("node", "leaf"), "leaf-vectors")
    compare, linked = traverse(nodes, threshold=threshold)

    sizes = nodes.where("leaf").select(F.col("node").alias("leaf"), "n")
    parts = F.ceil(F.col("n") / block).cast("int")
    wanted = compare.select(F.col("a").alias("leaf")).unionByName(compare.select(F.col("b").alias("leaf"))).distinct().join(sizes, "leaf")
    blocks = stored(
        join_by_counted_key(placed, wanted, "leaf", "n").withColumn("part", F.pmod(F.xxhash64("pid"), parts).cast("int"))
        .groupBy("leaf", "part").agg(F.sort_array(F.collect_list(F.struct("pid", "weight", "vec"))).alias("rows"))
        .mapInPandas(_packed, "leaf string, part int, pids array<bigint>, weights array<bigint>, matrix binary"), "vector-blocks",
    )
    cells = compare.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / block).cast("int") - 1))
    cells = cells.withColumn("part_a", spread("na")).withColumn("part_b", spread("nb")).where("a <> b or part_a <= part_b").select("a", "part_a", "b", "part_b")
    half = lambda x: blocks.toDF(x, f"part_{x}", f"pids_{x}", f"weights_{x}", f"matrix_{x}")
    found = stored(
        cells.join(half("a"), ["a", "part_a"]).join(half("b"), ["b", "part_b"]).mapInPandas(_compared(threshold), "pid bigint, root bigint, links bigint"), "block-links")

    # what holds for a node holds for all leaves below it
    credit = linked.select(F.col("a").alias("node"), F.col("b").alias("with")).unionByName(linked.where("a <> b").select(F.col("b").alias("node"), F.col("a").alias("with")))
    credit = stored(credit.join(nodes.select(F.col("node").alias("with"), "mass"), "with").groupBy("node").agg(F.sum("mass").alias("links")), "node-links")
    up = nodes.select("node", "parent")
    reached, chain = [], stored(nodes.where("leaf").select(F.col("node").alias("leaf"), F.col("node").alias("node")), "ancestors")
    while not chain.isEmpty():
        reached.append(chain.join(credit, "node"))
        chain = stored(chain.join(up, "node").where("parent is not null").select("leaf", F.col("parent").alias("node")), "ancestors")
    below = reached[0] if reached else credit.select("node", F.col("node").alias("leaf"), "links").limit(0)
    for part in reached[1:]:
        below = below.unionByName(part)
    below = stored(below.select("leaf", "node", "links"), "leaf-links")

    credited = below.groupBy("leaf").agg(F.sum("links").alias("node_links")).join(sizes, "leaf")
    by_leaf = join_by_counted_key(placed.select("pid", "leaf"), stored(credited, "credited-leaves"), "leaf", "n")
    counts = by_leaf.select("pid", F.col("node_links").alias("links")).unionByName(found.select("pid", "links")).groupBy("pid").agg(F.sum("links").alias("links"))

    member = nodes.select("node", "member")
    star = by_leaf.select("pid", "leaf").join(member.withColumnRenamed("node", "leaf"), "leaf").select(F.col("pid").alias("a"), F.col("member").alias("b"))
    of = lambda name, out: member.select(F.col("node").alias(name), F.col("member").alias(out))
    climbs = below.join(of("leaf", "a_"), "leaf").join(of("node", "b_"), "node").select(F.col("a_").alias("a"), F.col("b_").alias("b"))
    across = linked.join(of("a", "a_"), "a").join(of("b", "b_"), "b").select(F.col("a_").alias("a"), F.col("b_").alias("b"))
    edges = star.unionByName(climbs).unionByName(across).unionByName(found.select(F.col("pid").alias("a"), F.col("root").alias("b"))).where("a <> b").distinct()
    rep = classes.select("pid", "rep")
    named = edges.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    shared = copies.select("vec_id", "key").join(classes.select("key", "rep"), "key").groupBy("vec_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    final = components(named.unionByName(shared), "vector-components")

    answer = stored(
        classes.join(counts, "pid", "left").join(final.withColumnRenamed("id", "rep"), "rep", "left")
        .select("key", "weight", (F.coalesce("links", "weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "vector-answers")
    linked_rows = join_by_counted_key(usable.select("vec_id", "key"), answer, "key", "weight").select("vec_id", "n_links", "component_id")
    others = base.where("key is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

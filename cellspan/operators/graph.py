"""Communities on a neighbour edge table ``(src, dst, weight)``, both directions listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspan.plans.prefix import global_row_number
from cellspan.plans.sizes import BROADCAST_ROWS
from cellspan.plans.storage import cut_lineage

SELF_WEIGHT = 0.5
# Gains below this share of the graph's weight, and rises below it, are rounding.
LEAST_GAIN = 1e-12
# A level ends with a turn that raises the modularity by no more than this.
LEAST_RISE = 1e-5


def _propagate(edges: DataFrame, labels: DataFrame, keys: list[str], iterations: int) -> DataFrame:
    """Synchronous weighted label propagation; every node also votes ``SELF_WEIGHT`` for its own label.

    Highest rounded vote wins, ties take the smallest label, so runs agree.
    """
    # own votes are loops; edges are dealt by node once, so a round's votes are counted where they are
    loops = labels.select(*keys, F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(SELF_WEIGHT).alias("weight"))
    voting = cut_lineage(edges.select(*keys, "src", "dst", "weight").unionByName(loops).repartition("src"))
    small = labels.count() <= BROADCAST_ROWS
    for _ in range(iterations):
        now = labels.select(*keys, F.col("node").alias("dst"), "label")
        votes = voting.join(F.broadcast(now) if small else now, [*keys, "dst"]).select(*keys, F.col("src").alias("node"), "label", "weight")
        tally = (votes if small else votes.repartition("node")).groupBy(*keys, "node", "label").agg(F.round(F.sum("weight"), 6).alias("v"))
        labels = cut_lineage(tally.groupBy(*keys, "node").agg(F.min_by("label", F.struct(-F.col("v"), F.col("label"))).alias("label")))
    return labels


def propagate_labels(edges: DataFrame, nodes: DataFrame, iterations: int = 10) -> DataFrame:
    """``(node, label)`` after a fixed number of rounds; a node starts with its own id."""
    start = nodes.select(F.col("cell_id").alias("node"), F.col("cell_id").alias("label"))
    return _propagate(edges, start, [], iterations)


def number_by_size(labels: DataFrame) -> DataFrame:
    """``cell_id, cluster``: clusters numbered 0.. by size, ties by label."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    ranked = global_row_number(sizes, [F.desc("size"), F.col("label")], "r")
    return labels.join(ranked, "label").select(F.col("node").alias("cell_id"), (F.col("r") - 1).alias("cluster"))


def graph_communities(edges: DataFrame, nodes: DataFrame, iterations: int = 10) -> DataFrame:
    """Deterministic communities of a mutual-neighbour graph."""
    return number_by_size(propagate_labels(edges, nodes, iterations))


def connected_components(edges: DataFrame, nodes: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(node, label)`` with the smallest reachable id as label.

    Each round takes the smallest label among the neighbours and then the label of that label
    (pointer jumping), which shortens long chains; stops when nothing changes.
    """
    labels = cut_lineage(nodes.select(F.col("cell_id").alias("node"), F.col("cell_id").alias("label")))
    for _ in range(max_rounds):
        near = edges.join(labels.select(F.col("node").alias("dst"), F.col("label").alias("l")), "dst").groupBy(F.col("src").alias("node")).agg(F.min("l").alias("l"))
        step = labels.join(near, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = cut_lineage(step.join(jump, "label").select("node", "old", F.least("label", "up").alias("label")))
        if step.where("old <> label").isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")
    raise RuntimeError("connected components did not settle; raise max_rounds")


def consensus_communities(
    edges: DataFrame, nodes: DataFrame, *, repeats: int = 20, keep_edges: float = 0.9, rate: float = 0.5,
    min_size: int = 10, iterations: int = 10, seed: int = 0,
) -> DataFrame:
    """Consensus over repeated propagation on seeded edge subsamples.

    All repeats run as one keyed job. An edge whose ends share a label in at least ``rate`` of the
    repeats is kept; components of kept edges are the clusters, those below ``min_size`` become
    ``outlier``. ``agreement`` is the mean co-assignment over a cell's edges.
    """
    runs = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    pair = [F.least("src", "dst"), F.greatest("src", "dst")]
    drawn = F.pmod(F.xxhash64(*pair, "run", F.lit(seed)), F.lit(1_000_000)) < int(keep_edges * 1_000_000)
    sampled = edges.withColumn("run", runs).where(drawn)
    start = nodes.withColumn("run", runs).select("run", F.col("cell_id").alias("node"), F.col("cell_id").alias("label"))
    labels = _propagate(sampled, start, ["run"], iterations)
    a = labels.select("run", F.col("node").alias("src"), F.col("label").alias("la"))
    b = labels.select("run", F.col("node").alias("dst"), F.col("label").alias("lb"))
    together = edges.withColumn("run", runs).join(a, ["run", "src"]).join(b, ["run", "dst"]).groupBy("src", "dst").agg(
        (F.count_if(F.col("la") == F.col("lb")) / F.lit(float(repeats))).alias("share")
    )
    together = cut_lineage(together)
    components = connected_components(together.where(F.col("share") >= rate), nodes)
    agreement = together.groupBy(F.col("src").alias("node")).agg(F.avg("share").alias("agreement"))
    sizes = components.groupBy("label").agg(F.count("*").alias("size"))
    large = global_row_number(sizes.where(F.col("size") >= min_size), [F.desc("size"), F.col("label")], "r")
    return components.join(large, "label", "left").join(agreement, "node", "left").select(
        F.col("node").alias("cell_id"),
        F.coalesce((F.col("r") - 1).cast("string"), F.lit("outlier")).alias("cluster"),
        F.coalesce("agreement", F.lit(0.0)).alias("agreement"),
    )


def _degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, community, k)``: every node by itself, with its weighted degree (0 without edges)."""
    k = edges.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k"))
    return nodes.join(k, "node", "left").select("node", F.col("node").alias("community"), F.coalesce("k", F.lit(0.0)).alias("k"))


def _links(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Each node's weight towards every community it touches, with its own community, degree and loop."""
    there = labels.select(F.col("node").alias("dst"), "community")
    own = labels.select("node", F.col("community").alias("mine"), "k")
    loop = F.when(F.col("src") == F.col("dst"), F.col("weight")).otherwise(0.0)
    touched = edges.join(there, "dst").groupBy(F.col("src").alias("node"), "community").agg(F.sum("weight").alias("w"), F.sum(loop).alias("loop"))
    return touched.join(own, "node")


def _totals(labels: DataFrame) -> DataFrame:
    return labels.groupBy("community").agg(F.sum("k").alias("total"))


def _quality(links: DataFrame, totals: DataFrame, weight: float, resolution: float) -> float:
    inner = links.where(F.col("community") == F.col("mine")).select((F.col("w") / weight).alias("q"))
    spread = totals.select((-resolution * (F.col("total") / weight) ** 2).alias("q"))
    return inner.unionByName(spread).agg(F.sum("q")).first()[0]


def _moves(links: DataFrame, totals: DataFrame, weight: float, resolution: float) -> DataFrame:
    """``node, mine, goal, gain``: the best community of each node that would raise the modularity by moving alone."""
    sums = totals
    staying = F.sum(F.when(F.col("community") == F.col("mine"), F.col("w") - F.col("loop")).otherwise(0.0))
    going = F.when(F.col("community") != F.col("mine"), F.struct(
        F.round(F.col("w") - resolution * F.col("k") * F.col("total") / weight, 9).alias("pull"), (-F.col("community")).alias("other")))
    best = links.join(sums, "community").groupBy("node", "mine", "k").agg(F.max(going).alias("best"), staying.alias("stay"))
    mine = sums.select(F.col("community").alias("mine"), F.col("total").alias("own"))
    gain = F.col("best.pull") - F.col("stay") + resolution * F.col("k") * (F.col("own") - F.col("k")) / weight
    return best.where("best is not null").join(mine, "mine").select(
        "node", "mine", (-F.col("best.other")).alias("goal"), F.round(gain, 9).alias("gain")
    ).where(F.col("gain") > LEAST_GAIN * weight)


def _one_way(moves: DataFrame, turn: int) -> DataFrame:
    """Moves down an order of the communities that is drawn anew each turn: no two nodes swap places."""
    place = lambda c: F.xxhash64(c, F.lit(turn))
    return moves.where(place("goal") < place("mine"))


def _matched(moves: DataFrame) -> DataFrame:
    """Moves that are the best of both communities they touch.

    Each community loses or gains one node at most, so the gains add up and the modularity surely rises; the best move
    of all is always among them.
    """
    order = F.struct("gain", (-F.col("node")).alias("n"))
    ends = moves.select(F.explode(F.array("mine", "goal")).alias("c"), order.alias("o")).groupBy("c").agg(F.max("o").alias("o"))
    first = ends.select(F.col("c").alias("mine"), F.col("o").alias("a"))
    second = ends.select(F.col("c").alias("goal"), F.col("o").alias("b"))
    return moves.join(first, "mine").join(second, "goal").where((F.col("a.n") == -F.col("node")) & (F.col("b.n") == -F.col("node"))).drop("a", "b")


def _moved(labels: DataFrame, moves: DataFrame) -> DataFrame:
    to = moves.select("node", "goal")
    return cut_lineage(labels.join(to, "node", "left").select("node", F.coalesce("goal", "community").alias("community"), "k"))


def modular_levels(edges: DataFrame, nodes: DataFrame, *, resolution: float = 1.0, rounds: int = 8, levels: int = 6) -> tuple[DataFrame, list[float]]:
    """``(node, label)`` by parallel modularity moves, and the modularity before and after each level.

    ``edges`` list both directions with positive weights. On each level every node starts by itself. All nodes that gain
    by it and move down a drawn order of the communities move at once; if the modularity falls by that, the turn is
    repeated with at most one move per community, whose gains add up. So it never falls. Then each community
    becomes one node of the next level, its inner weight a loop. A higher ``resolution`` gives more and smaller
    communities. Nodes without edges stay alone; equal gains take the smallest label.
    """
    members = nodes.select(F.col("cell_id").alias("node"), F.col("cell_id").alias("label"))
    graph = cut_lineage(edges.groupBy("src", "dst").agg(F.sum(F.col("weight").cast("double")).alias("weight")))
    weight = graph.agg(F.sum("weight")).first()[0]
    if not weight:
        return members, [0.0]
    at_level, history = members.select("node").distinct(), []
    for level in range(levels):
        labels = cut_lineage(_degrees(graph, at_level))
        links = cut_lineage(_links(graph, labels))
        quality = _quality(links, _totals(labels), weight, resolution)
        history = history or [quality]
        before = labels
        for turn in range(rounds):
            moves, start = _moves(links, _totals(labels), weight, resolution), quality
            for choice in (_one_way(moves, level * rounds + turn), _matched(moves)):
                tried = _moved(labels, choice)
                tried_links = cut_lineage(_links(graph, tried))
                reached = _quality(tried_links, _totals(tried), weight, resolution)
                if reached > quality + LEAST_GAIN:
                    labels, links, quality = tried, tried_links, reached
                    break
            if quality - start <= LEAST_RISE:
                break
        if labels is before:
            break
        history.append(quality)
        up = labels.select(F.col("node").alias("label"), "community")
        members = cut_lineage(members.join(up, "label").select("node", F.col("community").alias("label")))
        ends = [labels.select(F.col("node").alias(c), F.col("community").alias(f"{c}_up")) for c in ("src", "dst")]
        graph = cut_lineage(graph.join(ends[0], "src").join(ends[1], "dst").groupBy(F.col("src_up").alias("src"), F.col("dst_up").alias("dst")).agg(F.sum("weight").alias("weight")))
        at_level = labels.select(F.col("community").alias("node")).distinct()
    return members, history


def modular_communities(edges: DataFrame, nodes: DataFrame, *, resolution: float = 1.0, rounds: int = 8, levels: int = 6) -> DataFrame:
    """``cell_id, cluster`` of :func:`modular_levels`, clusters numbered by size."""
    return number_by_size(modular_levels(edges, nodes, resolution=resolution, rounds=rounds, levels=levels)[0])


def modularity(edges: DataFrame, clusters: DataFrame, resolutions: list[float]) -> DataFrame:
    """``resolution, modularity`` of a ``(cell_id, cluster)`` table on a both-ways edge table; null without edges."""
    a = clusters.select(F.col("cell_id").alias("src"), F.col("cluster").alias("ca"))
    b = clusters.select(F.col("cell_id").alias("dst"), F.col("cluster").alias("cb"))
    inner = F.when(F.col("ca") == F.col("cb"), F.col("weight")).otherwise(0.0)
    per = edges.join(a, "src").join(b, "dst").groupBy("ca").agg(F.sum("weight").alias("total"), F.sum(inner).alias("inner"))
    sums = per.agg(F.sum("inner").alias("i"), F.sum("total").alias("w"), F.sum(F.col("total") ** 2).alias("q"))
    at = F.explode(F.array(*map(F.lit, resolutions))).alias("resolution")
    return sums.select(at, "*").select("resolution", (F.col("i") / F.col("w") - F.col("resolution") * F.col("q") / F.col("w") ** 2).alias("modularity"))

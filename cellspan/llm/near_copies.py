"""Near copies: b-bit MinHash signatures in a multi-index Hamming join, confirmed on full shingle sets.

A signature has :data:`CHUNKS` chunks of :data:`WIDTH` symbols of 14 bits. Two signatures that differ in fewer
than ``CHUNKS * (ERRORS + 1)`` symbols have, by pigeonhole, a chunk with at most ``ERRORS`` differing symbols;
enumerating the symbols that may differ gives keys, one of which such a pair must share. At a similarity of 0.8
a pair misses all keys with probability 2e-4, at 0.85 with 6e-6.

Equal sets collapse to one representative first. In each key's bucket every representative is compared with one
pivot. Buckets that still hold several components are joined to clusters, and each cluster takes its best-connected
member P as centre. With D(A) the symmetric difference of A and P, D(A) and D(B) differ in exactly the elements in
which A and B differ. So whoever is similar to P is linked by the size of D alone, and a link between others needs a
least number of elements common to D(A) and D(B): a join of their rarest elements finds all of these. A text that a
group of copies shares is P, so it is in no D, and a bucket is never expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspan.llm.common import join_by_counted_key, stored, text_slices
from cellspan.plans.sizes import broadcast_if_small

CHUNKS, WIDTH, ERRORS = 8, 6, 1
SYMBOLS = CHUNKS * WIDTH

_WORDS: dict[bytes, int] = {}
# Entries of a worker's word cache; a full cache is emptied.
_CACHE_WORDS = 500_000

# Odd multipliers of the symbol hashes, from a fixed seed.
_MULTIPLIERS = np.random.default_rng(20).integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = np.random.default_rng(21).integers(0, 2**63, SYMBOLS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xD6E8FEB86659FD93)


def _word_hashes(text: str) -> np.ndarray:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    known = _WORDS
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    out = np.fromiter([known[w] for w in words], dtype=np.uint64, count=len(words))
    if len(known) > _CACHE_WORDS:
        known.clear()
    return out


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle, a blank one has none."""
    hashes = _word_hashes(text)
    n = len(hashes)
    if not n:
        return hashes
    k = min(n, words)
    rolled = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        rolled = _mix(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - k + 1 + i])
    return np.unique(rolled)


def signature(shingles: np.ndarray) -> np.ndarray:
    """:data:`SYMBOLS` minima, each cut to 14 bits of 16."""
    lowest = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 8192):
        block = shingles[at : at + 8192, None] * _MULTIPLIERS + _ADDENDS
        np.minimum(lowest, (block ^ (block >> np.uint64(29))).min(axis=0), out=lowest)
    return (_mix(lowest) >> np.uint64(50)).astype(np.uint16)


def signature_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of many signatures (one row each): per chunk and allowed error, the other symbols."""
    chunks = signatures.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    keys = []
    for c in range(CHUNKS):
        for j in range(WIDTH):
            h = np.full(len(chunks), c * WIDTH + j, dtype=np.uint64)
            for i in range(WIDTH):
                if i != j:
                    h = _mix(h + chunks[:, c, i])
            keys.append(h)
    return np.stack(keys, axis=1).view(np.int64)


def _summaries(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for part in text_slices(frames):
            rows = []
            for doc_id, text in zip(part["doc_id"].tolist(), part["text"].tolist(), strict=True):
                found = shingle_set(text, words)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                rows.append((doc_id, len(found), *np.frombuffer(digest, dtype="<i8").tolist(), signature(found).view(np.int64)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "d1", "d2", "signature"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def _explode_keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in frames:
        if len(part):
            signatures = np.stack(part["signature"].to_list()).astype(np.int64).view(np.uint16)
            yield pd.DataFrame({"rep": part["rep"], "keys": list(signature_keys(signatures))})


def _sets(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in text_slices(frames, budget=1_000_000):
            yield pd.DataFrame({"id": part["doc_id"], "shingles": [shingle_set(t, words).view(np.int64) for t in part["text"]]})

    return run


def _similar(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return inter * 100 >= (a + b - inter) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose full sets are similar enough."""
    # of the sets under one doc_id the smallest and the largest: a pair goes only if no sizes between them fit
    size = lambda x: sizes.select(F.col("rep").alias(x), F.col("least").alias(f"least_{x}"), F.col("most").alias(f"most_{x}"))
    fit = (
        pairs.join(size("a"), "a").join(size("b"), "b")
        .where((F.col("most_a") * 100 >= F.col("least_b") * percent) & (F.col("most_b") * 100 >= F.col("least_a") * percent))
    )
    # rows that share a doc_id are one document here: any of its sets may give the link
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s_{x}"))
    inter = F.size(F.array_intersect("s_a", "s_b")).cast("bigint")
    return (
        fit.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        .where(_similar(inter, F.size("s_a").cast("bigint"), F.size("s_b").cast("bigint"), percent))
        .select("a", "b").distinct()
    )


def _unlike_centre(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, pairs): members similar to their cluster's centre, and pairs across components that may be similar.

    ``members`` is (rep, component, cluster, weight); the heaviest member of a cluster is its centre. Similar sets
    differ in at most ``(100 - percent) / (100 + percent)`` of the sum of their sizes. A pair across components has
    a side that is unlike the centre, called the outer one here. From that follow the least numbers of elements in
    common, and with them how many of a member's differences to the centre, rarest first, can hold the first common
    one.
    """
    gap, whole = 100 - percent, 100 + percent
    centre = members.groupBy("cluster").agg(F.max_by(F.struct("rep", "component"), F.struct("weight", -F.col("rep"))).alias("c"))
    centre = centre.select("cluster", F.col("c.rep").alias("centre"), F.col("c.component").alias("home"))
    own = sets.groupBy("id").agg(F.min("shingles").alias("p"))
    centre = centre.join(own, F.col("centre") == F.col("id")).drop("id").withColumn("n_p", F.size("p").cast("bigint"))
    rows = members.join(sets, F.col("rep") == F.col("id")).join(centre, "cluster")
    differ = F.concat(F.array_except("shingles", "p"), F.array_except("p", "shingles"))
    rows = rows.select("cluster", "rep", "component", "centre", "home", "n_p", F.size("shingles").cast("bigint").alias("n"), F.xxhash64("shingles").alias("set"), differ.alias("differ"))
    rows = rows.withColumn("d", F.size("differ").cast("bigint")).withColumn("near", F.col("d") * whole <= (F.col("n") + F.col("n_p")) * gap)
    rows = stored(rows.withColumn("group", F.when(F.col("near"), F.col("home")).otherwise(F.col("component"))), "differences")
    links = rows.where("near and rep <> centre").select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()

    outer = F.col("group") != F.col("home")
    # more than half of the differences, but for unequal sizes, are shared with whatever is unlike the centre
    shared = F.greatest(F.lit(1), F.floor((F.col("d") * whole + (F.col("n_p") - F.col("n")) * gap) / (2 * whole)) + 1)
    reach = F.greatest(F.col("d") - shared + 1, F.when(outer, F.floor(F.col("n") * gap / percent) + 1).otherwise(0))
    single = stored(
        rows.where("d > 0").select("rep", "set", "group", "n", "d", outer.alias("outer"), reach.alias("reach"), F.explode("differ").alias("e"), "cluster")
        .withColumn("e", F.xxhash64("cluster", "e")).drop("cluster"), "single-differences",
    )
    often = stored(single.groupBy("e").agg(F.count(F.lit(1)).alias("often")), "difference-counts")
    ranked = join_by_counted_key(single, often, "e", "often").withColumn("r", F.row_number().over(Window.partitionBy("rep", "set").orderBy("often", "e")))
    first = stored(ranked.where("r <= reach and often > 1").select("e", "rep", "group", "n", "d", "r", "outer"), "first-differences")
    a, b = first.where("outer").alias("a"), first.alias("b")
    col = F.col
    common = F.least(col("a.d") - col("a.r"), col("b.d") - col("b.r")) + 1
    pairs = a.join(
        b, (col("a.e") == col("b.e")) & (col("a.group") != col("b.group"))
        & (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)
        & (common * 2 * whole >= (col("a.d") + col("b.d")) * whole - (col("a.n") + col("b.n")) * gap),
    )
    return links, pairs.select(F.least("a.rep", "b.rep").alias("a"), F.greatest("a.rep", "b.rep").alias("b")).where("a <> b").distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id it reaches.

    Rounds of large-star and small-star: every node hands its larger, then its smaller neighbours to the smallest
    id it knows, until nothing moves. A node with very many neighbours is one row per neighbour throughout.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        step = stored(small, name)
        if step.exceptAll(edges).isEmpty() and edges.exceptAll(step).isEmpty():
            break
        edges = step
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def near_copy_components(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents whose sets of distinct word shingles have ``100 * intersection >= percent * union`` are linked, and
    linked documents form components named by their smallest ``doc_id``; ``kept`` marks that document. Null and
    blank texts have no shingles and are linked with nothing. Rows that share a ``doc_id`` are one document. A row
    without ``doc_id`` takes no part: its component is null and it is kept. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    table = stored(docs.mapInPandas(_summaries(shingle_words), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, signature array<bigint>"), "signatures")
    full = table.where("n_shingles > 0 and doc_id is not null")
    # equal sets have equal signatures: partial aggregation folds the copies before the shuffle
    reps = stored(full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")), "representatives")
    sizes = full.groupBy(F.col("doc_id").alias("rep")).agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    keyed = (
        reps.select("rep", "signature").mapInPandas(_explode_keys, "rep bigint, keys array<bigint>")
        .select("rep", F.explode("keys").alias("key"))
    )
    keyed = stored(keyed, "signature-keys")
    # each bucket's pivot is drawn by hash, so that a group that shares many buckets meets many pivots
    keyed = keyed.withColumn("h", F.xxhash64("key", "rep"))
    shared = keyed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.count(F.lit(1)).alias("held"))
    members = stored(keyed.join(shared.where("low < high").select("key", "low", "held"), "key"), "bucket-members")
    pivots = members.where("h = low").select("key", F.col("rep").alias("pivot"))
    met = stored(members.join(pivots, "key").select("key", "rep", "pivot", "held"), "bucket-stars")
    ends = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    stars = stored(met.where("rep <> pivot").select(*ends("rep", "pivot")).distinct(), "stars")
    wanted = met.select(F.col("rep").alias("id")).distinct()
    texts = docs.join(broadcast_if_small(wanted, materialize=True), docs["doc_id"] == F.col("id"), "left_semi")
    sets = stored(texts.select("doc_id", "text").mapInPandas(_sets(shingle_words), "id bigint, shingles array<bigint>"), "candidate-sets")
    links = stored(_confirmed(stars, sets, sizes, percent), "star-links")

    named = components(links, "star-components")
    labelled = met.join(named, met["rep"] == named["id"], "left").select("key", "rep", "pivot", "held", F.coalesce("component", "rep").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    open_rows = stored(labelled.join(mixed, "key", "left_semi"), "open-buckets")
    near_by = components(open_rows.select(*ends("rep", "pivot")), "clusters")
    weighed = open_rows.groupBy("rep").agg(F.min("component").alias("component"), F.sum("held").alias("weight"))
    clustered = weighed.join(near_by.withColumnRenamed("id", "rep"), "rep", "left").select("rep", weighed["component"], "weight", F.coalesce(near_by["component"], "rep").alias("cluster"))
    to_centre, across = _unlike_centre(clustered, sets, percent)
    more = to_centre.unionByName(_confirmed(across.join(stars, ["a", "b"], "left_anti"), sets, sizes, percent))
    copies = full.select("doc_id", "d1", "d2").join(reps.select("d1", "d2", "rep"), ["d1", "d2"]).select("doc_id", "rep").distinct()
    same = copies.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    final = components(links.unionByName(more).unionByName(same), "components")
    out = table.select("doc_id", "n_shingles").join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))

"""Spot signatures: chains of content words that follow common words.

A spot is a common word (anchor) with a content word right after it; its signature is the anchor and the next
:data:`CHAIN` content words. A content word that follows no anchor starts a chain of content words alone, so lists and
tables have signatures too, and no signature depends on anything but the words around it: an edit changes those of the
places it touches and no others. The set of a document's signatures is its fingerprint, likeness is the Jaccard index
of two sets. Everything here is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspan.llm.common import let, stored

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to a in is that it on for was as with be by this are from at an or not have has he "
    "der die das und in zu den von mit ist im für auf ein eine nicht des dem sich "
    "le la les de des et un une du en que qui pour dans sur par au est avec "
    "el los las y del se por con una para al su lo es"
).split()
CHAIN = 3
BITS = 48

_BLANKS = "[\\x20\\x09-\\x0D]+"


def spots(text: Column) -> Column:
    """Sorted distinct signatures (48-bit numbers) of ``text``; none for a text without words."""

    def chains(words: Column) -> Column:
        content = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: ~F.get(words, i).isin(ANCHORS))
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(let(content, lambda at: of(words, at)))

    def of(words: Column, at: Column) -> Column:
        def chain(i: Column, k: Column) -> Column:
            before = F.get(words, i - 1)
            led = F.coalesce(before.isin(ANCHORS), F.lit(False))
            return F.xxhash64(F.when(led, before), *_following(words, at, k))

        return F.when(F.size(at) == 0, F.array(F.xxhash64(F.concat_ws(" ", words)))).otherwise(F.transform(at, chain))

    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _BLANKS), lambda w: w != "")
    found = let(words, chains)
    return F.sort_array(F.array_distinct(F.transform(found, lambda h: h.bitwiseAND(F.lit((1 << BITS) - 1)))))


def _following(words: Column, at: Column, k: Column) -> list[Column]:
    return [F.get(words, F.get(at, k + i)) for i in range(CHAIN)]


def fingerprint(found: Column) -> Column:
    """The signatures as text, 12 hexadecimal digits each."""
    return F.array_join(F.transform(found, lambda h: F.lower(F.lpad(F.hex(h), BITS // 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two signature sets; two empty sets are alike."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def _block_of(bounds: list[int], key: Column) -> Column:
    """How many of the sorted ``bounds`` are below ``key``, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    fine, coarse = F.lit(bounds).cast("array<bigint>"), F.lit(bounds[::step]).cast("array<bigint>")
    below = F.size(F.filter(coarse, lambda b: b < key))
    first = (below - 1) * step
    inside = F.size(F.filter(F.slice(fine, F.greatest(first, F.lit(0)) + 1, F.lit(step)), lambda b: b < key))
    return F.when(key.isNull() | (below == 0), 0).otherwise(first + inside)


def with_next(docs: DataFrame, blocks_per_partition: int = 4) -> DataFrame:
    """(doc_id, text, __spots, next_text, next_spots): each document and the next by ascending ``doc_id``.

    The last document's next is the first. Documents are cut into blocks of ids; a copy of a block's first row
    stands at the end of the block before, so each block finds its successors alone.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    n = max(2, blocks_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # a bounded number of cut points of one narrow column
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("c")).first()["c"] or []
    placed = docs.withColumn("__block", _block_of(sorted({int(c) for c in cuts}), F.col("doc_id")).cast("int"))
    lowest = placed.groupBy("__block").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)).cast("bigint"))).alias("__low"))
    everywhere = Window.partitionBy(F.lit(0)).orderBy("__block")  # one narrow row per block
    before = stored(
        lowest.select("__block", "__low", F.coalesce(
            F.lag("__block").over(everywhere),
            F.last("__block").over(everywhere.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("__before")), "block-order",
    )
    heads = (
        placed.join(F.broadcast(before), "__block")
        .where(F.coalesce("doc_id", F.lit(-(2**63)).cast("bigint")) == F.col("__low"))
        .groupBy("__block", "__before").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"))
    )
    rows = (
        placed.select("doc_id", "text", "__block", F.lit(0).alias("__copy"))
        .unionByName(heads.select("doc_id", "text", F.col("__before").alias("__block"), F.lit(1).alias("__copy")))
        .repartition("__block").withColumn("__spots", spots(F.col("text")))
    )
    order = Window.partitionBy("__block").orderBy("__copy", F.col("doc_id").asc_nulls_first(), "text")
    return (
        rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_spots", F.lead("__spots").over(order))
        .where(F.col("__copy") == 0).drop("__block", "__copy")
    )


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last quarter replaced by the start of the next document. Null text is empty; a null
    ``doc_id`` sorts first; rows with equal ``doc_id`` follow each other by text; one row alone is its own next.
    An empty table gives an empty result. Other columns are not read.
    """
    n = F.char_length("text")
    quarter = F.expr("char_length(text) div 4")
    edited = F.concat(F.substring("text", F.lit(1), (n - quarter).cast("int")), F.substring("next_text", F.lit(1), quarter.cast("int")))
    out = with_next(docs).withColumn("__edited", edited)
    out = out.withColumn("__edited_spots", spots(F.col("__edited")))
    return out.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("__edited", 256).alias("edited_sha256"),
        fingerprint(F.col("__spots")).alias("fingerprint"), fingerprint(F.col("__edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("__spots"), F.col("__edited_spots")).alias("near_edited"),
        likeness(F.col("__spots"), F.col("next_spots")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs): documents by equal fingerprint, and the classes whose likeness reaches ``threshold``.

    ``classes`` is (doc_id, class_id), the class named by its smallest ``doc_id``; ``pairs`` is (a, b, likeness)
    with a < b over class ids. Sets are partitioned by length, so that a set meets only its own and the next
    partition; within them only the rarest signatures that any similar set must share are joined. Texts without
    signatures form one class and no pair; rows without ``doc_id`` take no part.
    """
    rows = stored(docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint"), spots(F.col("text")).alias("s")), "spots")
    classes = rows.groupBy("s").agg(F.min("doc_id").alias("class_id"))
    members = rows.join(classes, "s").select("doc_id", "class_id")
    sets = stored(classes.where(F.size("s") > 0).groupBy("class_id").agg(F.first("s").alias("s")).withColumn("n", F.size("s")), "spot-classes")
    single = sets.select("class_id", "n", F.explode("s").alias("spot"))
    often = single.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    ranked = single.join(often, "spot").withColumn(
        "r", F.row_number().over(Window.partitionBy("class_id").orderBy("df", "spot"))
    ).where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1)
    part = F.floor(F.log(F.col("n")) / math.log(1 / threshold) + 1e-9).cast("int")
    rare = stored(ranked.select("class_id", "n", "spot", part.alias("p")), "rare-spots")
    near = rare.withColumn("p", F.explode(F.array(F.col("p"), F.col("p") + 1)))  # its own and the next longer partition
    x, y = near.alias("x"), rare.alias("y")
    found = x.join(y, ["spot", "p"]).where(
        (F.col("x.class_id") != F.col("y.class_id")) & (F.col("x.n") <= F.col("y.n")) & (F.col("x.n") >= F.col("y.n") * threshold - 1e-9)
    ).select(F.least("x.class_id", "y.class_id").alias("a"), F.greatest("x.class_id", "y.class_id").alias("b")).distinct()
    side = lambda c: sets.select(F.col("class_id").alias(c), F.col("s").alias(f"s_{c}"))
    pairs = found.join(side("a"), "a").join(side("b"), "b").select("a", "b", likeness(F.col("s_a"), F.col("s_b")).alias("likeness"))
    return members, pairs.where(F.col("likeness") >= threshold)

"""Temperature mixing of sources, realised as budgeted block permutations.

Source *i* with token share s_i gets weight s_i^a / sum_j s_j^a. The exponent *a* is the largest in [0, 1] whose
weights reach a target entropy, or, where that would repeat some source too often, the smallest that keeps the
limit. A source's budget is its weight times the token budget: whole epochs first, then the front of a pseudo-random
permutation of its documents. Without a given token budget it is the least that takes every source whole, so the
largest source comes once and source *i* (s_max / s_i)^(1 - a) times. The permutation is cut into blocks; block sums find the block where the budget ends,
and only the rows of that block are put in order. Texts are never shuffled for it.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspan.plans.bounded import bounded_rows
from cellspan.llm.common import stored

# Sources whose shares are brought together on the driver; more are refused.
MAX_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Words between white space: the measure of tokens when none is given."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def weights_at(shares: list[float], exponent: float) -> list[float]:
    raised = [s**exponent if s > 0 else 0.0 for s in shares]
    total = sum(raised)
    return [r / total for r in raised] if total else [0.0] * len(shares)


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def solve_exponent(shares: list[float], *, entropy_share: float | None, max_repeats: float | None, epochs: float | None) -> float:
    """The exponent: entropy falls and the largest repetition falls as it grows, so both are bisected.

    ``entropy_share`` is the target as a share of the largest possible entropy; ``epochs`` is the token budget over
    all tokens, None the least that takes every source whole. Raises when even the natural shares repeat too often.
    """
    if max_repeats is not None and (1.0 if epochs is None else epochs) > max_repeats + 1e-9:
        raise ValueError("the budget repeats the sources more often than allowed")
    live = [s for s in shares if s > 0]
    if len(live) < 2:
        return 1.0

    def largest_true(good) -> float:  # good holds from 0 up to the answer
        if good(1.0):
            return 1.0
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if good(mid) else (low, mid)
        return low

    exponent = 1.0
    if entropy_share is not None:
        target = entropy_share * math.log(len(live))
        exponent = largest_true(lambda a: entropy(weights_at(live, a)) >= target - 1e-12)
    if max_repeats is not None:
        repeats = lambda a: max(repetitions(live, weights_at(live, a), epochs))
        if repeats(exponent) > max_repeats:
            # from above: the largest distance from 1 that keeps the limit
            exponent = 1.0 - largest_true(lambda d: repeats(1.0 - d) <= max_repeats + 1e-12)
    return exponent


def repetitions(shares: list[float], weights: list[float], epochs: float | None) -> list[float]:
    """How often the tokens of each source come in a budget of ``epochs``, or in the least that takes all whole."""
    ratios = [w / s for w, s in zip(weights, shares, strict=True) if s > 0]
    scale = 1.0 / min(ratios, default=1.0) if epochs is None else epochs
    return [r * scale for r in ratios]


def _place(seed: int, epoch: Column) -> Column:
    """A document's place in its source's permutation, as a fraction of 1; equal rows share it."""
    h = F.xxhash64(F.lit(seed), epoch.cast("bigint"), F.col("doc_id"), F.col("text"))
    return F.shiftrightunsigned(h, 11) / float(1 << 53)


def mix(
    docs: DataFrame, *, entropy_share: float | None = None, max_repeats: float | None = None, epochs: float | None = 1.0,
    tokens: Column | None = None, seed: int = 0, block_rows: int = 8192,
) -> DataFrame:
    """``docs`` in the mixture, with ``mix_tokens``, ``mix_weight``, ``mix_epoch``, ``mix_block`` and ``mix_order``.

    A document appears once per epoch it is in, perhaps not at all. Budgets are met to within the document at the
    cut; without ``epochs`` the budget is the least that loses no document. A target that the
    limit on repeats keeps out of reach is warned of, with the entropy reached. Sorting by ``mix_order`` gives the mixed order: blocks of all sources interleaved at random, each permuted.
    Null source is a source; documents without tokens cost nothing and are in every epoch of their source, also when
    no document has tokens; repeated rows count each and stay together at a cut. An empty table gives an empty
    result. All columns pass through; columns named as outputs are replaced.
    """
    names = ["mix_tokens", "mix_weight", "mix_epoch", "mix_block", "mix_order"]
    docs = docs.drop(*names).withColumn("mix_tokens", word_count(F.col("text")) if tokens is None else tokens)
    spark = docs.sparkSession
    sources = bounded_rows(
        docs.groupBy("source").agg(F.sum("mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), MAX_SOURCES, "sources"
    )
    total = sum(r["tokens"] for r in sources)
    shares = [r["tokens"] / total if total else 0.0 for r in sources]
    weights = weights_at(shares, solve_exponent(shares, entropy_share=entropy_share, max_repeats=max_repeats, epochs=epochs))
    if epochs is None:
        epochs = max((s / w for s, w in zip(shares, weights, strict=True) if w > 0), default=1.0)
    most = math.log(max(1, sum(w > 0 for w in weights)))
    if entropy_share is not None and entropy(weights) < entropy_share * most - 1e-9:
        warnings.warn(f"the mixture reaches an entropy share of {entropy(weights) / most:.4f}, not {entropy_share}", stacklevel=2)
    plan = []
    for r, w in zip(sources, weights, strict=True):
        repeats = w * epochs * total / r["tokens"] if r["tokens"] else 1.0
        full = math.floor(repeats + 1e-9)
        rest = max(0.0, repeats - full) * r["tokens"]
        plan.append((r["source"], w, full, rest if rest >= 0.5 else 0.0, max(1, -(-r["docs"] // block_rows))))
    schema = "__source string, mix_weight double, __full int, __rest double, __blocks bigint"
    table = F.broadcast(spark.createDataFrame(plan, schema))
    # the last, partial epoch: where each source's permutation is cut
    joined = docs.withColumn("__source_key", F.col("source").cast("string")).join(table, F.col("__source_key").eqNullSafe(F.col("__source"))).drop("__source")
    partial = joined.where("__rest > 0").withColumn("__place", _place(seed, F.col("__full")))
    partial = partial.select("__source_key", "__rest", "mix_tokens", "__place", F.floor(F.col("__place") * F.col("__blocks")).alias("mix_block"))
    sums = partial.groupBy("__source_key", "__rest", "mix_block").agg(F.sum("mix_tokens").alias("t"))
    upto = Window.partitionBy("__source_key").orderBy("mix_block")
    edge = stored(
        sums.withColumn("upto", F.sum("t").over(upto)).withColumn("before", F.col("upto") - F.col("t"))
        .where("before < __rest and upto >= __rest").groupBy("__source_key").agg(F.min("mix_block").alias("edge"), F.min("before").alias("before")),
        "mix-edges",
    )
    edge = edge.select(F.col("__source_key").alias("__k"), "edge", "before")
    inside = partial.join(F.broadcast(edge), F.col("__source_key").eqNullSafe(F.col("__k")) & (F.col("mix_block") == F.col("edge")))
    running = F.sum("mix_tokens").over(Window.partitionBy("__source_key").orderBy("__place")) + F.col("before")  # equal rows as one
    cut = stored(
        inside.withColumn("upto", running).where(F.col("upto") - F.col("mix_tokens") / 2 <= F.col("__rest"))
        .groupBy("__source_key").agg(F.max("__place").alias("__last")), "mix-cuts",
    )
    marks = (
        edge.join(cut, edge["__k"].eqNullSafe(cut["__source_key"]), "left").select("__k", "edge", F.coalesce("__last", F.lit(-1.0)).alias("__last"))
    )
    copies = joined.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("__full"))))
    copies = copies.withColumn("__place", _place(seed, F.col("mix_epoch"))).withColumn("mix_block", F.floor(F.col("__place") * F.col("__blocks")))
    placed = copies.join(F.broadcast(marks), F.col("__source_key").eqNullSafe(F.col("__k")), "left")
    in_rest = (F.col("__rest") > 0) & (F.col("edge").isNull() | (F.col("mix_block") < F.col("edge")) | ((F.col("mix_block") == F.col("edge")) & (F.col("__place") <= F.col("__last"))))
    kept = placed.where((F.col("mix_epoch") < F.col("__full")) | in_rest)
    block_key = F.xxhash64(F.lit(seed), F.lit("block"), "__source_key", "mix_epoch", "mix_block")
    return kept.withColumn("mix_order", F.struct(block_key.alias("block"), F.col("__place").alias("place"))).drop(
        "__source_key", "__full", "__rest", "__blocks", "__place", "__k", "edge", "__last"
    )

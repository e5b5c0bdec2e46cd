"""Exact interpolated quantiles without holding a group's values in one aggregate buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspan.plans.prefix import ordered_blocks, prefix_sum


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    """Rows ``(*keys, p, quantile)`` by linear interpolation between order statistics.

    Equal values collapse to one counted row first; ranks come from a blocked prefix sum, so a key
    holding most of the table is spread over many tasks.
    """
    keys = list(keys)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("__v"))
        .agg(F.count("*").alias("__n"))
    )
    order = [F.col(k) for k in keys] + [F.col("__v")]
    blocks = ordered_blocks(counted, order)
    ranked = prefix_sum(blocks, [F.col("__v")], "__n", "__before", keys)
    totals = blocks.groupBy(*keys).agg(F.sum("__n").alias("__total"))
    if keys:
        ranked = ranked.join(totals, keys)
    else:
        ranked = ranked.withColumn("__total", totals.scalar())
    # the order statistics each probability needs, kept only in the row that holds them
    needs = []
    for p in probabilities:
        rank = F.lit(float(p)) * (F.col("__total") - 1)
        for k in (F.floor(rank), F.ceil(rank)):
            needs.append(F.struct(F.lit(float(p)).alias("p"), rank.alias("rank"), k.alias("k")))
    held = F.filter(F.array(*needs), lambda x: (x["k"] >= F.col("__before")) & (x["k"] < F.col("__before") + F.col("__n")))
    hits = ranked.withColumn("__x", F.explode(held)).select(
        *keys, "__v", F.col("__x.p").alias("p"), F.col("__x.k").alias("__k"),
        F.floor("__x.rank").alias("__lo"), F.ceil("__x.rank").alias("__hi"), F.col("__x.rank").alias("__rank"),
    )
    share = F.col("__rank") - F.col("__lo")
    return (
        hits.groupBy(*keys, "p")
        .agg(
            F.max(F.when(F.col("__k") == F.col("__lo"), F.col("__v"))).alias("__vlo"),
            F.max(F.when(F.col("__k") == F.col("__hi"), F.col("__v"))).alias("__vhi"),
            F.max(share).alias("__share"),
        )
        .select(*keys, "p", (F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__share")).alias("quantile"))
    )

"""Running sums, maxima and row numbers over orders that do not fit one task.

A plain ``Window`` without a partition key, or with a key that holds a third of the table, sorts
that group inside a single task. The helpers here cut the order into blocks, scan each block on its
own, scan the one-row-per-block summaries, and add the carry back:

* ``ordered_blocks`` cuts by range partitioning, for any total order (blocks balance themselves);
* ``tile_running_max`` cuts by fixed position tiles, when positions are unique per key, so that a
  tile never holds more rows than it has positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspan.functions.columns import int_div
from cellspan.plans.storage import cut_lineage

BLOCK = "__block"


def ordered_blocks(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned by ``order``, with the partition number as ``__block``.

    The range boundaries are sampled, so the result is checkpointed: every later branch must see
    the same blocks. ``order`` has to be total (end it with a unique key).
    """
    return cut_lineage(df.repartitionByRange(*order).withColumn(BLOCK, F.spark_partition_id()))


def prefix_sum(
    blocks: DataFrame,
    order: Sequence[Column],
    value: str,
    out: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Exclusive running sum of ``value`` per ``keys`` over ``ordered_blocks`` output."""
    keys = list(keys)
    local = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per (key, block): at most blocks + keys rows, since keys are contiguous in the order
    carry_window = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    carry = (
        blocks.groupBy(*keys, BLOCK)
        .agg(F.sum(value).alias("__block_sum"))
        .withColumn(
            "__carry",
            F.sum("__block_sum").over(carry_window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select(*keys, BLOCK, F.coalesce("__carry", F.lit(0)).alias("__carry"))
    )
    zero = F.lit(0)
    return (
        blocks.withColumn("__local", F.coalesce(F.sum(value).over(local), zero))
        .join(carry, [*keys, BLOCK])
        .withColumn(out, F.col("__local") + F.col("__carry"))
        .drop("__local", "__carry")
    )


def global_row_number(
    df: DataFrame, order: Sequence[Column], out: str, keys: Sequence[str] = ()
) -> DataFrame:
    """1-based ``row_number`` over ``order`` (per ``keys``) without a single-task window.

    With ``keys`` the blocks are cut by ``(keys, order)``, so one huge key spans many blocks.
    """
    full = [*(F.col(k) for k in keys), *order]
    blocks = ordered_blocks(df.withColumn("__one", F.lit(1).cast("long")), full)
    numbered = prefix_sum(blocks, order, "__one", "__before", keys)
    return numbered.withColumn(out, F.col("__before") + 1).drop("__before", "__one", BLOCK)


def tile_running_max(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: str,
    out: str,
    *,
    inclusive: bool,
    tile: int = 65_536,
) -> DataFrame:
    """Running maximum of ``value`` by ``position`` within ``keys``.

    ``position`` must be unique per key, which bounds a window group by ``tile`` rows; the carry
    window has one row per occupied tile. Nulls in ``value`` are skipped; no earlier value is null.
    """
    keys = list(keys)
    tiled = df.withColumn("__tile", int_div(F.col(position), tile))
    last = 0 if inclusive else -1
    local = Window.partitionBy(*keys, "__tile").orderBy(position).rowsBetween(Window.unboundedPreceding, last)
    across = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    carry = (
        tiled.groupBy(*keys, "__tile")
        .agg(F.max(value).alias("__tile_max"))
        .withColumn(
            "__carry",
            F.max("__tile_max").over(across.orderBy("__tile").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select(*keys, "__tile", "__carry")
    )
    return (
        tiled.withColumn("__local", F.max(value).over(local))
        .join(carry, [*keys, "__tile"])
        .withColumn(out, F.greatest("__local", "__carry"))
        .drop("__local", "__carry", "__tile")
    )

"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspan.plans.storage import cut_lineage

# Rows of a few short columns: a few hundred megabytes at most in an executor.
BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, *, materialize: bool = False) -> DataFrame:
    """``df`` with a broadcast hint when it has at most :data:`BROADCAST_ROWS` rows, else as it is.

    The large side of the join then needs no shuffle. Beyond the limit the planner keeps its
    sort-merge join with adaptive skew splitting. The check is a count; ``materialize`` checkpoints
    a table that is costly to derive, so it is computed once for the check and the join.
    """
    checked = cut_lineage(df) if materialize else df
    return F.broadcast(checked) if checked.count() <= BROADCAST_ROWS else checked

"""Sites placed once by tile: the same residuals and windows, with one exchange of the calls."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspan.operators import methylation as M


@pytest.fixture(scope="module")
def calls(spark):
    rng = np.random.default_rng(5)
    rows = sorted({(f"c{rng.integers(9)}", f"chr{rng.integers(1, 3)}", int(rng.integers(1, 9_000))) for _ in range(3_000)})
    return spark.createDataFrame([(*r, int(rng.integers(2))) for r in rows], "cell_id string, chrom string, pos long, call long").repartition(5).cache()


def exchanges(df):
    """Key exchanges of the plan, but for those inside the cached input."""
    return re.findall(r"(?<!Broadcast)Exchange (hashpartitioning)", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("limit", [0, 2_000_000])
def test_tiles_change_no_number(spark, calls, rows, limit):
    plain = M.call_residuals(calls, M.smooth_methylation(calls, 300))
    tiles = M.tile_calls(calls, bandwidth=400, tile=1_000)
    tiled = M.tile_residuals(tiles, 300, bandwidth=400, tile=1_000, broadcast_rows=limit)
    told = lambda df: rows(df.select("cell_id", "chrom", "pos", "call", F.round("residual", 9).alias("r")))
    assert told(M.own_residuals(tiled)) == told(plain)
    a = M.window_variance(plain, bandwidth=400, step=100, min_cells=2)
    b = M.window_variance(tiled, bandwidth=400, step=100, min_cells=2, tile=1_000)
    near = lambda df: rows(df.withColumn("variance", F.round("variance", 9)))
    assert near(a) == near(b) and a.count() > 100
    scan = lambda r, **x: rows(M.scan_variable_regions(r, bandwidth=400, step=100, top=0.1, min_cells=2, **x).withColumn("peak_var", F.round("peak_var", 9)))
    assert scan(plain) == scan(tiled, tile=1_000) == scan(tiled, tile=1_000, calls=calls)


def test_windows_need_one_exchange_of_the_calls(spark, calls):
    tiled = M.tile_residuals(M.tile_calls(calls))
    assert exchanges(M.window_variance(tiled, step=500)) == ["hashpartitioning"]
    old = M.call_residuals(calls, M.smooth_methylation(calls))
    assert len(exchanges(M.window_variance(old, step=500))) > 1
    # beyond the broadcast limit: the calls once for their residuals, the narrow positions besides
    far = M.window_variance(M.tile_residuals(M.tile_calls(calls), broadcast_rows=0), step=500)
    assert len(exchanges(far)) == 2


def test_stored_tiles_need_none(spark, calls):
    spark.sql("drop table if exists stored_tiles")
    try:
        tiles = M.save_tiles(M.tile_calls(calls), "stored_tiles", 4)
        assert exchanges(M.window_variance(M.tile_residuals(tiles), step=500)) == []
        assert M.own_residuals(tiles).count() == calls.count()
    finally:
        spark.sql("drop table if exists stored_tiles")


def test_a_tile_must_hold_whole_steps(calls):
    with pytest.raises(ValueError, match="multiple of step"):
        M.window_variance(M.tile_residuals(M.tile_calls(calls)), bandwidth=2_100, step=700)

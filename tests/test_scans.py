"""Blocked scans against plain windows, with one key that holds most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cellspan.plans.bounded import bounded_rows
from cellspan.plans.prefix import global_row_number, ordered_blocks, prefix_sum
from cellspan.plans.quantiles import exact_quantiles
from cellspan.plans.storage import shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(20)}", i, rng.randrange(50)) for i in range(5000)]
    return spark.createDataFrame(data, "k string, id long, v long")


def test_row_number_per_key(skewed):
    got = global_row_number(skewed, [F.desc("v"), F.col("id")], "n", ["k"])
    want = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "id")).cast("long"))
    assert got.select("k", "id", "n").exceptAll(want.select("k", "id", "n")).isEmpty()


def test_prefix_sum_per_key(skewed):
    order = [F.col("id")]
    got = prefix_sum(ordered_blocks(skewed, [F.col("k"), *order]), order, "v", "s", ["k"])
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = skewed.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert got.count() == 5000
    assert got.select("k", "id", "s").exceptAll(want.select("k", "id", "s")).isEmpty()


def test_quantiles_equal_numpy(skewed):
    probs = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    rows = skewed.collect()
    for r in exact_quantiles(skewed, ["k"], "v", probs).collect():
        assert r["quantile"] == pytest.approx(np.quantile([x["v"] for x in rows if x["k"] == r["k"]], r["p"]))
    whole = {r["p"]: r["quantile"] for r in exact_quantiles(skewed, [], "v", probs).collect()}
    assert whole == pytest.approx({p: np.quantile([x["v"] for x in rows], p) for p in probs})


def test_bounded_rows_refuses_instead_of_cutting(spark):
    assert len(bounded_rows(spark.range(5), 5, "x")) == 5
    with pytest.raises(ValueError):
        bounded_rows(spark.range(6), 5, "x")


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

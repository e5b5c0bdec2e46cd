"""Interval edges: touching, nested, one-base overlaps, coordinate bases, hot starts."""

import random

import pytest
from pyspark.sql import functions as F

from cellspan.operators import intervals as I
from cellspan.operators import regions as R


def frame(spark, data, cols="chrom string, start long, end long"):
    return spark.createDataFrame(data, cols)


def test_touching_intervals_stay_apart_and_overlaps_merge(spark, rows):
    df = frame(spark, [("c", 0, 10), ("c", 10, 20), ("c", 15, 30), ("c", 16, 18), ("c", 29, 35), ("d", 5, 9)])
    assert rows(I.merge_overlapping(df), "chrom", "start", "end", "source_count") == [("c", 0, 10, 1), ("c", 10, 35, 4), ("d", 5, 9, 1)]


def test_bridge_gaps_joins_near_intervals(spark, rows):
    df = frame(spark, [("c", 0, 10), ("c", 12, 20), ("c", 25, 30)])
    assert rows(I.merge_overlapping(df, bridge_gaps=3), "start", "end") == [(0, 20), (25, 30)]


def brute_merge(items):
    out = []
    for s, e in sorted(items):
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
            out[-1][2] += 1
        else:
            out.append([s, e, 1])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_brute_force_across_tiles(spark, rows, seed):
    # positions span several scan tiles, some intervals are longer than a tile, one start is very hot
    rng = random.Random(seed)
    items = [(s, s + rng.randint(1, 1500)) for s in (rng.randrange(400_000) for _ in range(300))]
    items += [(70_000, 70_000 + rng.randint(1, 50)) for _ in range(150)] + [(130_000, 290_000)]
    got = I.merge_overlapping(frame(spark, [("c", s, e) for s, e in items]))
    assert rows(got, "start", "end", "source_count") == sorted(brute_merge(items), key=repr)


def test_labels_are_sorted_and_unique(spark):
    df = spark.createDataFrame([("c", 0, 10, "B"), ("c", 5, 8, "A"), ("c", 6, 12, "B")], "chrom string, start long, end long, l string")
    assert I.merge_overlapping(df, label="l").first()["labels"] == ["A", "B"]


def test_blacklist_needs_one_single_entry(spark, rows):
    iv = frame(spark, [("c", 0, 100)])
    two = frame(spark, [("c", 0, 15), ("c", 50, 65)])
    one = frame(spark, [("c", 0, 20)])
    assert I.remove_blacklisted(iv, two, 0.2).count() == 1
    assert I.remove_blacklisted(iv, one, 0.2).count() == 0
    with pytest.raises(ValueError):
        I.remove_blacklisted(iv, one, 0)


def test_long_interval_over_many_bins_is_removed_once(spark):
    iv = frame(spark, [("c", 0, 95_000), ("c", 100_000, 100_010)])
    left = I.remove_blacklisted(iv, frame(spark, [("c", 30_000, 60_000)]), 0.2)
    assert [r["start"] for r in left.collect()] == [100_000]


def test_site_edges_in_both_bases(spark, rows):
    region = spark.createDataFrame([("c", 10, 20, "r")], "chrom string, start long, end long, feature_id string")
    sites = spark.createDataFrame([(str(p), "c", p, 1, 2) for p in (10, 11, 20, 21)], "cell_id string, chrom string, pos long, mc long, cov long")
    assert [r[0] for r in rows(I.count_over_regions(sites, region), "cell_id")] == ["11", "20"]
    assert [r[0] for r in rows(I.count_over_regions(sites, region, position_base=0), "cell_id")] == ["10", "11"]


def test_zero_coverage_pairs_are_dropped_and_bins_equal_regions(spark, rows):
    bins = I.tile_genome(spark.createDataFrame([("c", 25)], "chrom string, size long"), 10)
    assert rows(bins, "start", "end") == [(0, 10), (10, 20), (20, 25)]
    sites = spark.createDataFrame([("x", "c", 1, 0, 0), ("x", "c", 11, 1, 3), ("x", "c", 26, 1, 3)], "cell_id string, chrom string, pos long, mc long, cov long")
    a = rows(I.count_over_bins(sites, bins, 10))
    assert a == rows(I.count_over_regions(sites, bins)) == [("x", "c_10_20", 1, 3)]


def test_disjoint_check(spark):
    assert I.overlapping_pairs_check(frame(spark, [("c", 0, 10), ("c", 10, 20)])).isEmpty()
    assert I.overlapping_pairs_check(frame(spark, [("c", 0, 11), ("c", 10, 20)])).count() == 1
    assert I.overlapping_pairs_check(frame(spark, [("c", 0, 5), ("c", 0, 5)])).count() == 1
    # the covering interval lies several scan tiles back
    assert I.overlapping_pairs_check(frame(spark, [("c", 0, 300_000), ("c", 200_000, 200_001)])).count() == 1


def test_unknown_chromosomes_come_last_by_name(spark):
    order = spark.createDataFrame([("b", 9, 0), ("a", 9, 1)], "chrom string, size long, rank int")
    df = frame(spark, [("z", 0, 1), ("a", 0, 1), ("y", 0, 1), ("b", 5, 6), ("b", 2, 3)])
    assert [(r["chrom"], r["start"]) for r in I.genome_order(df, order).collect()] == [("b", 2), ("b", 5), ("a", 0), ("y", 0), ("z", 0)]


def test_region_mean_is_unweighted_and_sums_repeats(spark):
    region = spark.createDataFrame([("c", 0, 100, "r")], "chrom string, start long, end long, feature_id string")
    sites = spark.createDataFrame(
        [("x", "c", 5, 1, 1), ("x", "c", 5, 0, 1), ("x", "c", 9, 0, 10)], "cell_id string, chrom string, pos long, mc long, cov long")
    row = R.region_mean_of_site_ratios(sites, region).first()
    assert row["value"] == pytest.approx(0.25) and row["n_sites"] == 2


def test_zscore_needs_spread_and_enough_cells(spark, rows):
    data = [("a", "flat", 0.5), ("b", "flat", 0.5), ("a", "ok", 0.0), ("b", "ok", 1.0), ("a", "few", 0.1)]
    z = R.region_zscore(spark.createDataFrame(data, "cell_id string, feature_id string, value double"), min_observed=2)
    assert rows(z, "feature_id", "cell_id", "z") == [("few", "a", None), ("flat", "a", None), ("flat", "b", None), ("ok", "a", -1.0), ("ok", "b", 1.0)]


def test_invalid_low_group_is_an_error(spark):
    df = spark.createDataFrame([("A", "B", "group_C")], "cell_type_a string, cell_type_b string, low_group string")
    with pytest.raises(Exception, match="invalid low group"):
        R.hypo_label(df).collect()


def test_best_per_interval_breaks_ties(spark):
    cols = "sample_id string, hypo string, other string, chrom string, start long, end long, abs_diff double, raw_p double"
    data = [("s", "h", "y", "c", 0, 5, 0.5, 0.01), ("s", "h", "x", "c", 0, 5, 0.5, 0.01), ("s", "h", "w", "c", 0, 5, 0.4, 0.0)]
    assert R.best_per_interval(spark.createDataFrame(data, cols)).first()["other"] == "x"


def test_contiguous_groups(spark, rows):
    df = spark.createDataFrame([(i + 1, l) for i, l in enumerate("aabbba")], "position long, l string")
    assert rows(R.contiguous_groups(df, "l"), "run_start", "run_end", "label", "center") == [(1, 2, "a", 1.5), (3, 5, "b", 4.0), (6, 6, "a", 6.0)]


def test_resolve_comparisons(spark, rows):
    cols = "sample_id string, comparison string, status string, dmr_file string"
    base = [("s", "a", "complete", "f1"), ("s", "b", "ineligible", None), ("s", "c", "known_fdr_zero_failure", "f2")]
    fallback = spark.createDataFrame([("s", "c", "g")], "sample_id string, comparison string, dmr_file string")
    assert rows(R.resolve_comparisons(spark.createDataFrame(base, cols), fallback), "comparison", "dmr_file") == [("a", "f1"), ("c", "g")]
    with pytest.raises(Exception, match="unresolved"):
        R.resolve_comparisons(spark.createDataFrame([("s", "d", "failed", "f")], cols), fallback).collect()


def test_feature_ids(spark, rows):
    ids = spark.createDataFrame([("chr1:0-5000",), ("chr1_5000_10000",), ("chr2-100-200",), ("x",), ("chr3:10-5",)], "feature_id string")
    got = {r["feature_id"]: r["problem"] for r in I.parse_feature_id(ids, 5000).collect()}
    assert got == {"chr1:0-5000": None, "chr1_5000_10000": None, "chr2-100-200": "not_aligned", "x": "unparsable", "chr3:10-5": "invalid_interval"}


def test_number_features_is_contiguous_with_one_hot_chromosome(spark):
    order = spark.createDataFrame([("b", 9, 0), ("a", 9, 1)], "chrom string, size long, rank int")
    df = spark.range(2000).select(F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("chrom"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 5).alias("end"))
    got = [r["feature_id"] for r in I.number_features(df, order).orderBy("feature_rank").collect()]
    assert got == [f"VMR_{i:06d}" for i in range(1, 2001)]

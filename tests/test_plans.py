"""Plan shapes: no nested loops, filters at the scan, rank limits below the shuffle."""

import re

import pytest

from cellspan.catalog.base import Tables
from cellspan.operators import cells as K
from cellspan.operators import intervals as I
from cellspan.operators import methylation as M
from cellspan.operators import regions as R
from cellspan.operators import sites as S
from cellspan.plans import sizes

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    t = Tables(spark, SF_DIR)
    base = str(tmp_path_factory.mktemp("tables"))
    t.sites.write.parquet(f"{base}/sites")
    t.regions.write.parquet(f"{base}/regions")
    return spark.read.parquet(f"{base}/sites"), spark.read.parquet(f"{base}/regions"), t


@pytest.mark.parametrize("limit,join", [(2_000_000, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_interval_joins_are_equi_joins_at_any_size(spark, stored, monkeypatch, limit, join):
    # below the counted limit the sites are not shuffled; beyond it the join is sort-merge
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", limit)
    sites, regions, t = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [
            I.count_over_regions(sites, regions), I.count_over_bins(sites, I.tile_genome(t.chrom_order, 1000), 1000),
            I.remove_blacklisted(regions, t.blacklist), I.non_overlapping(regions, t.blacklist),
        ]
        for df in frames:
            text = plan(df)
            assert "NestedLoop" not in text and "Cartesian" not in text
            assert join in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_both_join_ways_agree(stored, monkeypatch):
    sites, regions, _ = stored
    small = rows_of(I.count_over_regions(sites, regions))
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 0)
    assert rows_of(I.count_over_regions(sites, regions)) == small


def test_context_filter_and_columns_reach_the_scan(spark, stored):
    sites, regions, _ = stored
    text = I.count_over_regions(sites.where("context like 'CG%'"), regions)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(context,CG)" in text
    assert not re.search(r"ReadSchema: struct<[^>]*cell_type", text)
    assert "GreaterThanOrEqual(pos,1)" in plan(S.valid_sites(sites))


def test_counting_combines_before_its_shuffle(stored):
    sites, regions, _ = stored
    assert plan(I.count_over_regions(sites, regions)).count("HashAggregate(keys=[cell_id") >= 2


def test_rank_limits_run_before_the_shuffle(stored):
    _, _, t = stored
    best = R.best_per_interval(R.hypo_label(R.dmr_threshold(t.dmr)))
    assert "WindowGroupLimit" in plan(R.top_n_per_label(best, t.chrom_order, 5))
    assert "WindowGroupLimit" in plan(K.balanced_sample(t.cells, 5))


def test_sliding_windows_shuffle_sites_once_and_never_their_repeats(spark):
    rows = spark.createDataFrame([("a", "c", p, 1, 0.5) for p in (1, 25_601, 25_701)], "cell_id string, chrom string, pos long, call long, residual double")
    df = M._cell_windows(rows, 2000, 100)
    assert plan(df).count("Exchange hashpartitioning") == 1
    # a window across the tile edge sees the sites of both tiles, and no window is listed twice
    got = {r["window"]: r["n"] for r in df.collect()}
    assert len(got) == df.count() and got[250] == 2 and got[256] == 2 and got[257] == 1 and got[0] == 1


def test_region_mean_uses_one_shuffle_for_both_steps(stored):
    sites, regions, _ = stored
    text = plan(R.region_mean_of_site_ratios(sites, regions))
    assert text.count("Exchange hashpartitioning(cell_id") == 1

"""Ranked queries on tables with fewer eligible regions than they ask for return all of them."""

import duckdb
import oracle
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def few(tmp_path_factory):
    """The smallest tables with the sites of the first parts only: about ten regions."""
    out = tmp_path_factory.mktemp("few")
    for t in oracle.TABLES:
        keep = "where l_partkey < 40" if t == "lineitem" else ""
        duckdb.sql(f"copy (select * from '{SF_DIR}/{t}.parquet' {keep}) to '{out}/{t}.parquet' (format parquet)")
    return str(out)


@pytest.mark.parametrize("name", ["flagship_ranked_regions", "w9_rank_regions", "w10_nested_subset", "route_feature_matrix"])
def test_equal_to_sql(spark, few, name):
    assert oracle.compare(entry.queries()[name](spark, few), oracle.connect(few), entry.oracle_sql()[name]) is None


def test_combined_ranks_follow_the_regions_found(spark, few):
    ranked = entry.queries()["w9_rank_regions"](spark, few).count()
    rows = entry.queries()["j8_combine_features"](spark, few).collect()
    assert 0 < ranked < 30 and sorted(r["selection_rank"] for r in rows) == list(range(1, len(rows) + 1))
    assert sum(r["feature_source"] == "VMR" for r in rows) == ranked
    summary = entry.queries()["a20_model_input_summary"](spark, few).first()
    assert (summary["vmr_features"], summary["combined_features"]) == (ranked, len(rows))


def test_no_region_kept_is_a_fraction_of_zero(spark, tmp_path):
    # sites of another context only: cells without any region
    for t in oracle.TABLES:
        keep = "where l_returnflag = 'N'" if t == "lineitem" else ""
        duckdb.sql(f"copy (select * from '{SF_DIR}/{t}.parquet' {keep}) to '{tmp_path}/{t}.parquet' (format parquet)")
    df = entry.queries()["p9_cell_missingness_qc"](spark, str(tmp_path))
    assert {r["observed_fraction"] for r in df.collect()} == {0.0}
    assert oracle.compare(df, oracle.connect(tmp_path), entry.oracle_sql()["p9_cell_missingness_qc"]) is None

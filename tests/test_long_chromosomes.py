"""Bins reach as far as the sites do, past the size the small tables declare."""

import duckdb
import oracle
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def far(tmp_path_factory):
    """The smallest tables with every other part moved beyond position 1,000,000."""
    out = tmp_path_factory.mktemp("far")
    for t in oracle.TABLES:
        moved = "replace (l_partkey + (l_partkey % 2) * 120000 as l_partkey)" if t == "lineitem" else ""
        duckdb.sql(f"copy (select * {moved} from '{SF_DIR}/{t}.parquet') to '{out}/{t}.parquet' (format parquet)")
    return str(out)


@pytest.mark.parametrize("name", ["j4_count_over_bins", "a4_hypo_prevalence", "w8_rank_bins", "w8_rank_bins_summary"])
def test_equal_to_sql(spark, far, name):
    assert oracle.compare(entry.queries()[name](spark, far), oracle.connect(far), entry.oracle_sql()[name]) is None

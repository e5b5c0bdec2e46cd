"""Queries that use a derived table several times derive it once, and nothing in them grows with a fixed number of tasks."""

import os

import duckdb
import oracle
import pytest

import __spark_entry__ as entry
from cellspan.catalog import base, source_queries
from cellspan.operators import methylation as M
from cellspan.operators import neighbors as N
from cellspan.operators.expression import normalize_log1p

SF_DIR = "/root/testdata/sf0.001"
LINES = duckdb.sql(f"select count(*) from '{SF_DIR}/lineitem.parquet'").fetchall()[0][0]


def counted(spark, df):
    """``df`` and a counter of the rows that any run of it has produced."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


@pytest.mark.parametrize("name", [
    "p2_valid_sites", "m9_regress_out", "m10_scale_genes", "m11_pca_expression", "a22_annotation_audit", "a22_audit_without_panels", "p13_parse_feature_id",
    "m13_lsi", "m13_tf_idf", "m4_diff_methylation", "m4_diff_methylation_fdr", "m2_tile_residuals", "s6_read_10x_mtx", "t1_stream_region_counts",
    "route_differential_matrix", "route_expression_clusters",
])
def test_lines_are_read_once(spark, monkeypatch, name):
    raw, counters = base.Tables.raw, []

    def watched(tables, table):
        df = raw(tables, table)
        # the genome's length is another, single number of the lines
        if table != "lineitem" or "_watch" not in tables.__dict__:
            return df
        df, seen = counted(spark, df)
        counters.append(seen)
        return df

    getattr_ = base.Tables.__getattr__

    def get(tables, table):
        if table in ("sites", "rna"):
            tables.__dict__["_watch"] = True
            try:
                return getattr_(tables, table)
            finally:
                del tables.__dict__["_watch"]
        return getattr_(tables, table)

    monkeypatch.setattr(base.Tables, "raw", watched)
    monkeypatch.setattr(base.Tables, "__getattr__", get)
    entry.queries()[name](spark, SF_DIR).collect()
    assert sum(c.value for c in counters) == LINES


def test_counts_and_windows_of_a_cell_share_one_exchange(spark):
    t = base.Tables(spark, SF_DIR)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(normalize_log1p(t.rna)).count("Exchange hashpartitioning(cell_id") == 1
    assert "Exchange hashpartitioning(cell_id" in plan(t.rna) and plan(t.rna).count("Exchange hash") == plan(normalize_log1p(t.rna)).count("Exchange hash")


def test_mutual_edges_search_once(spark):
    rows = [(i, j, 0.5) for i in range(6) for j in range(6) if i != j]
    edges, seen = counted(spark, spark.createDataFrame(rows, "src long, dst long, dist double"))
    mutual = N.mutual_edges(edges)
    assert mutual.count() == mutual.count() == len(rows) and seen.value == len(rows)


def test_a_path_spans_tasks(spark, monkeypatch):
    made = []
    monkeypatch.setattr(source_queries, "scratch_path", lambda s, n, f=source_queries.scratch_path: made.append(f(s, n)) or made[-1])
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        for name in ("w4_order_summaries", "s2_discover_cells"):
            assert oracle.compare(entry.queries()[name](spark, SF_DIR), oracle.connect(SF_DIR), entry.oracle_sql()[name]) is None
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for folder in made:
        for path, _, files in os.walk(folder):
            if "=" in path:
                assert len([f for f in files if f.startswith("part-")]) > 1


def test_buckets_follow_the_calls(spark, monkeypatch):
    calls = spark.range(1_000)
    assert M.tile_buckets(calls, 8) == 8
    monkeypatch.setattr(M, "BUCKET_CALLS", 100)
    assert M.tile_buckets(calls, 8) == 10
    monkeypatch.setattr(M, "BUCKET_CALLS", 150)
    name = "m2_tile_residuals"
    assert oracle.compare(entry.queries()[name](spark, SF_DIR), oracle.connect(SF_DIR), entry.oracle_sql()[name]) is None

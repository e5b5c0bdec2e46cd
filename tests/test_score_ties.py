"""Scores that lie on half a sixth digit are rounded alike, whichever way the sums erred."""

import duckdb

import __spark_entry__ as entry
from cellspan.catalog import methylation_queries as MQ


def test_halves_go_up_in_both_engines(spark):
    half = 0.9459775  # P(X > 1) of five reads at a rate of 13/20
    near = [half - 3e-13, half, half + 3e-13]
    got = {r["score"] for r in MQ.rounded_score(spark.createDataFrame([(x,) for x in near], "score double")).collect()}
    assert got == {0.945978}
    for name in ("m6_hypo_score", "m6_hypo_score_deep"):
        rule = entry.oracle_sql()[name].rsplit("select cell_id, feature_id, mc, cov, ", 1)[1].split(" score from")[0]
        assert {duckdb.execute(f"select {rule} from (select ?::double score)", [x]).fetchone()[0] for x in near} == got

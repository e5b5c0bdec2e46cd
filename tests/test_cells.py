"""Label rules, selection reasons, review guards."""

import pytest
from pyspark.sql import functions as F

from cellspan.functions import columns as C
from cellspan.operators import annotation as AN
from cellspan.operators import cells as K
from cellspan.operators import features as FT
from cellspan.operators import preflight as P
from cellspan.operators import quality as Q
from cellspan.operators import sites as S


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_context_modes_differ_for_three_letter_contexts(spark):
    df = spark.createDataFrame([("CGN",), ("CGH",), ("cga",), ("CHN",), ("CCG",)], "context string")
    got = lambda *a: [r[0] for r in S.context_filter(df, *a).collect()]
    assert got("CGN") == ["CGN", "CGH", "cga"]
    assert got("CGH") == ["CGH"]
    assert got("CGH", "dinucleotide") == ["CGN", "CGH", "cga"]
    with pytest.raises(ValueError):
        S.context_filter(df, "GCN", "dinucleotide")


def test_site_rules(spark):
    data = [(1, 1, 2), (1, 0, 0), (0, 1, 2), (1, 3, 2), (1, -1, 2)]
    df = spark.createDataFrame(data, "pos long, mc long, cov long")
    assert [S.valid_sites(df, r).count() for r in ("convert", "preflight", "count")] == [1, 2, 2]
    assert S.invalid_sites(df, "convert").count() == 4


def test_mixed_calls(spark, rows):
    df = spark.createDataFrame([(0, 2), (2, 2), (1, 2), (1, 4)], "mc long, cov long")
    assert rows(S.binary_calls(df), "mc", "call") == [(0, 0), (2, 1)]
    assert rows(S.binary_calls(df, True), "mc", "cov", "call") == [(0, 2, 0), (1, 2, 1), (1, 4, 0), (2, 2, 1)]


def test_selection_reasons(spark, rows):
    cells = spark.createDataFrame([(f"S_{i}", "S") for i in range(6)], "cell_id string, sample_id string")
    notes = spark.createDataFrame([("S_0", "T"), ("S_1", ""), ("S_2", "NA"), ("S_3", "requires_review"), ("S_4", "unassigned")], "cell_id string, cell_type string")
    got = {r["cell_id"]: r["reason"] for r in K.select_cells(cells, notes, approved=True, exclude="Odd").collect()}
    assert got == {"S_0": None, "S_1": "missing_scanpy_cell_type", "S_2": "excluded_scanpy_cell_type_Odd", "S_3": "excluded_scanpy_cell_type_Odd", "S_4": None, "S_5": "not_in_scanpy"}
    assert K.selected(K.select_cells(cells, notes, approved=False)).where("rna_cell_type = 'Unassigned'").count() == 6


def test_placeholder_modes(spark):
    df = spark.createDataFrame([("NA",), (" na ",), ("Requires Review",), ("T",), (None,)], "cell_type string")
    assert [r[0] for r in K.drop_placeholder_labels(df).collect()] == ["T"]
    assert [r[0] for r in K.drop_placeholder_labels(df, mode="strict").collect()] == [" na ", "Requires Review", "T"]


def test_scalar_columns(spark):
    assert one(spark, C.sanitize_label(F.lit("__T cells (CD4+)_"))) == "T_cells_CD4"
    with pytest.raises(Exception, match="no usable character"):
        one(spark, C.sanitize_label(F.lit("???")))
    tags = [one(spark, C.weight_tag(F.lit(w))) for w in (0.2, 1.0, 0.0, 0.05, 0.0001, 0.123456789)]
    assert tags == [f"{w:g}".replace(".", "p") for w in (0.2, 1.0, 0.0, 0.05, 0.0001, 0.123456789)]
    assert one(spark, C.safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, C.clip(F.lit(-9.0), 2)) == -2.0 and one(spark, C.clip(F.lit(None).cast("double"), 2)) is None


def test_label_codes_need_two_labels(spark):
    df = spark.createDataFrame([("T",), ("T",), ("NA",)], "cell_type string")
    assert {r["code"] for r in K.label_codes(df).collect()} == {-1}
    two = df.union(spark.createDataFrame([("B",)], "cell_type string"))
    assert {(r["cell_type"], r["code"]) for r in K.label_codes(two).collect()} == {("T", 1), ("B", 0), ("NA", -1)}


def test_pairs_and_single_label_samples(spark, rows):
    df = spark.createDataFrame([("1", "s", "B"), ("2", "s", "A"), ("3", "t", "A"), ("4", "s", "NA")], "cell_id string, sample_id string, cell_type string")
    assert rows(K.label_pairs(df), "sample_id", "comparison") == [("s", "A_vs_B")]
    assert rows(K.label_pairs(df, pool_as="p"), "sample_id", "group_a_cells", "group_b_cells") == [("p", 2, 1)]
    assert rows(K.samples_with_one_label(df), "sample_id") == [("t",)]


def test_review_round_trip(spark, rows):
    labels = [("0", "AT1")] * 6 + [("1", "AT2")] * 4 + [("2", "Macrophage")] * 4 + [("2", "Ciliated")] * 2 + [("3", "b"), ("3", "a")]
    cells = spark.createDataFrame([(str(i), c, l) for i, (c, l) in enumerate(labels)], "cell_id string, leiden string, cell_type string")
    sheet = AN.review_worksheet(cells)
    assert rows(sheet, "cluster", "cell_type", "cells") == [("0", "AT1", 6), ("1", "AT2", 4), ("2", "Macrophage", 6), ("3", "a", 2)]
    assert rows(AN.mixed_clusters(cells), "leiden") == [("2",), ("3",)]
    assert AN.worksheet_problems(sheet).isEmpty()
    bad = sheet.withColumn("cell_type", F.when(F.col("cluster") == "1", "Unassigned").otherwise(F.col("cell_type")))
    assert rows(AN.worksheet_problems(bad), "cluster", "problem") == [("1", "placeholder label")]
    view = cells.select("cell_id", F.col("leiden").alias("cluster"))
    good = AN.record_profile(sheet, "sig")
    assert {r["status"] for r in AN.apply_reviewed_labels(view, good, "sig").collect()} == {"reviewed"}
    other = AN.apply_reviewed_labels(view, good, "changed").collect()
    assert {(r["cell_type"], r["reason"]) for r in other} == {("Unassigned", "analysis_signature_mismatch")}


def test_nested_ranks_must_be_complete(spark):
    df = spark.createDataFrame([(1,), (2,), (4,)], "selection_rank long")
    assert FT.nested_subset_problem(df, 2).isEmpty() and FT.nested_subset_problem(df, 3).count() == 1


def test_balanced_sample_is_round_robin(spark):
    df = spark.createDataFrame([("b1", "B"), ("a1", "A"), ("a2", "A"), ("a3", "A")], "cell_id string, sample_id string")
    assert [r["cell_id"] for r in K.balanced_sample(df, 3).collect()] == ["a1", "b1", "a2"]


def lines(spark, data):
    return spark.createDataFrame([("f", i + 1, c, p, x, 1, 2) for i, (c, p, x) in enumerate(data)], "path string, line_no long, chrom string, pos long, context string, mc long, cov long")


def test_order_breaks(spark, rows):
    bad = lines(spark, [("1", 5, "CGN"), ("1", 4, "CGN"), ("2", 1, "CGN"), ("1", 9, "CGN")])
    assert rows(P.sorted_site_check(bad)) == [("f", "1", 1, 2)]
    assert P.preflight_sites(bad, "CGN", "full").first()["problem"] == "not coordinate sorted"
    assert P.preflight_sites(bad, "CGN", "quick").first()["problem"] is None


def test_quick_preflight_reads_until_the_context_shows(spark):
    df = lines(spark, [("1", i + 1, "CGN" if i == 6 else "CHN") for i in range(20)])
    assert P.preflight_sites(df, "CGN", "quick", 3).first()["records_checked"] == 7
    assert P.preflight_sites(df, "CHN", "quick", 3).first()["records_checked"] == 3
    assert P.preflight_sites(df, "CCC", "quick", 3).first()["problem"] == "no matching context"


def test_require_empty_names_examples(spark):
    Q.require_empty(spark.range(0), "fine")
    with pytest.raises(ValueError, match="duplicate ids"):
        Q.require_empty(Q.expect_unique(spark.createDataFrame([(1,), (1,)], "x long"), "x"), "duplicate ids")

"""Adjusted p values of contrasts, and rankings that must be complete."""

import pytest

from cellspan.operators import features as FT
from cellspan.operators import methylation as M

CONTRAST = (
    "sample_id string, cell_type_a string, cell_type_b string, is_real boolean, chrom string, start long, end long, t_stat double, "
    "n_sites long, n_a double, n_b double, meth_a double, meth_b double, low_group string, raw_p double"
)


def contrasts(spark, windows):
    """``windows``: (label b, is_real, start, t)."""
    rows = [
        ("s", "A", b, real, "chr1", at, at + 10, t, 5, 6.0, 6.0, 0.1, 0.9, "group_A" if t < 0 else "group_B", 0.01)
        for b, real, at, t in windows
    ]
    return spark.createDataFrame(rows, CONTRAST)


def test_adjusted_p_against_permuted_regions(spark):
    # B: three real regions and one permuted one that is stronger than the weakest; C: no permuted window
    given = contrasts(spark, [
        ("B", True, 0, -9.0), ("B", True, 100, 7.0), ("B", True, 200, 3.0), ("B", False, 300, 5.0), ("B", False, 400, 1.0),
        ("C", True, 0, 4.0),
    ])
    got = {(r["cell_type_b"], r["start"]): r["adj_p"] for r in M.diff_methylation(given, threshold=1.0).collect()}
    # the cut is the weakest real window, so the permuted window at 1.0 takes no part
    assert got == {("B", 0): 0.0, ("B", 100): 0.0, ("B", 200): 1.0, ("C", 0): None}


def test_adjusted_p_counts_ties_and_shares(spark):
    given = contrasts(spark, [("B", True, 100 * i, t) for i, t in enumerate((8.0, 6.0, 6.0, 2.0))]
                      + [("B", False, 1000 + 100 * i, t) for i, t in enumerate((6.0, 2.0, 2.0, 2.0))])
    got = {r["start"]: r["adj_p"] for r in M.diff_methylation(given, threshold=1.0).collect()}
    assert got == {0: 0.0, 100: pytest.approx((1 / 4) / (3 / 4)), 200: pytest.approx((1 / 4) / (3 / 4)), 300: 1.0}


def test_permuted_windows_alone_are_an_error(spark):
    with pytest.raises(ValueError, match="without a real window"):
        M.diff_methylation(contrasts(spark, [("B", True, 0, 4.0), ("C", False, 0, 4.0)]))


def test_without_permuted_labels_there_is_no_adjusted_p(spark):
    rows = M.diff_methylation(contrasts(spark, [("B", True, 0, 4.0)]).drop("is_real")).collect()
    assert [r["adj_p"] for r in rows] == [None]


def test_permuted_windows_keep_the_real_ones(spark):
    residuals = spark.createDataFrame(
        [(c, "chr1", p, (c + p) % 2, 0.1 * c - 0.3) for c in range(12) for p in (1, 700, 2300)], "cell_id long, chrom string, pos long, call int, residual double"
    )
    cells = spark.createDataFrame([(c, "s", "A" if c < 6 else "B") for c in range(12)], "cell_id long, sample_id string, cell_type string")
    plain = M.label_windows(residuals, cells, bandwidth=1000, step=500)
    both = M.label_windows(residuals, cells, bandwidth=1000, step=500, permute_seed=1)
    rows = lambda df: sorted((r["cell_type"], r["window"], r["cells"], round(r["s"], 9), r["meth"], r["n_sites"]) for r in df.collect())
    assert rows(both.where("is_real")) == rows(plain)
    # the permuted half deals out the same cells
    total = lambda df: df.groupBy().sum("cells", "meth", "n_sites").first()
    assert total(both.where("not is_real")) == total(plain)


def test_short_rankings_are_an_error(spark):
    bins = spark.createDataFrame([("a", 3), ("b", 0)], "feature_id string, hypo_cells long")
    with pytest.raises(ValueError, match="1 are eligible"):
        FT.rank_bins(bins, 5)
    assert FT.rank_bins(bins, 5, exact=False).count() == 1 and FT.rank_bins(bins, 1).count() == 1
    covered = spark.createDataFrame([("a", "chr1", 0, 10, 0.5, 3, 3, 2)], "feature_id string, chrom string, start long, end long, peak_var double, n_obs_cells long, n_cpg long, covered_cells long")
    cells = spark.createDataFrame([(1,), (2,)], "cell_id long")
    with pytest.raises(ValueError, match="2 features were asked for"):
        FT.rank_regions(covered, cells, 2)
    assert FT.rank_regions(covered, cells, 1).count() == 1


@pytest.mark.parametrize("ranks", [[1, 3], [1, 1], []])
def test_incomplete_ranks_are_an_error(spark, ranks):
    ranked = spark.createDataFrame([(f"f{i}", r) for i, r in enumerate(ranks)], "feature_id string, selection_rank long")
    with pytest.raises(ValueError, match="not complete"):
        FT.nested_subset(ranked, 2)

"""Numerical operators against small direct computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspan.functions import stats
from cellspan.operators import batch as B
from cellspan.operators import expression as X
from cellspan.operators import graph as G
from cellspan.operators import linalg as L
from cellspan.operators import methylation as M
from cellspan.operators import neighbors as N

RNG = np.random.default_rng(3)


def vectors(spark, x, ids=None):
    ids = ids or list(range(len(x)))
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "cell_id long, vec array<double>")


def matrix(df, n):
    out = {r["cell_id"]: r["vec"] for r in df.collect()}
    return np.array([out[i] for i in range(n)])


@pytest.mark.parametrize("parts", [1, 7])
def test_pca_matches_direct_svd(spark, parts):
    x = RNG.normal(size=(60, 8)) * np.array([5, 4, 3, 2, 1, 1, 1, 1])
    scores, factors = L.pca(vectors(spark, x).repartition(parts), 3)
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.abs(matrix(scores, 60)) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-6)
    assert factors.variance_ratio == pytest.approx((s**2 / (s**2).sum())[:3])
    big = np.abs(factors.components).argmax(0)
    assert (factors.components[big, range(3)] > 0).all()


def test_component_number_is_cut(spark):
    assert L.pca(vectors(spark, RNG.normal(size=(5, 10))), 30)[1].components.shape == (10, 4)
    with pytest.raises(ValueError):
        L.pca(vectors(spark, RNG.normal(size=(2, 10))), 3)


def test_imputation_restores_low_rank_values_only_where_missing(spark):
    full = RNG.normal(size=(80, 2)) @ RNG.normal(size=(2, 12))
    gaps = RNG.random(full.shape) < 0.1
    data = [(i, [None if g else float(v) for v, g in zip(r, m)]) for i, (r, m) in enumerate(zip(full, gaps))]
    filled, change = L.pca_impute(spark.createDataFrame(data, "cell_id long, vec array<double>"), 2, 10)
    got = matrix(filled, 80)
    assert got[~gaps] == pytest.approx(full[~gaps])
    assert np.sqrt(np.mean((got[gaps] - full[gaps]) ** 2)) < 0.3 * full.std()
    assert change[-1] < change[0] and len(change) <= 10
    same, none = L.pca_impute(vectors(spark, full), 2)
    assert none == [] and matrix(same, 80) == pytest.approx(full)


def brute_knn(x, k, ids):
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), N.DIGITS)
    return {(ids[i], r + 1): ids[j] for i in range(len(x)) for r, j in enumerate(sorted((j for j in range(len(x)) if j != i), key=lambda j: (d[i, j], ids[j]))[:k])}


@pytest.mark.parametrize("block", [16384, 25])
def test_knn_is_exact_with_copies_and_small_blocks(spark, block):
    # a third of the rows is one repeated vector
    x = np.vstack([RNG.normal(size=(120, 4)), np.tile(RNG.normal(size=4), (60, 1))])
    ids = [int(i) for i in RNG.permutation(len(x))]
    edges = N.knn(vectors(spark, x, ids), 5, block=block).collect()
    assert {(r["src"], r["rank"]): r["dst"] for r in edges} == brute_knn(x, 5, ids)


def test_knn_on_a_grid_with_many_ties(spark):
    x = np.array([(i, j) for i in range(9) for j in range(9)], dtype=float)
    ids = list(range(81))
    edges = N.knn(vectors(spark, x), 4, block=20).collect()
    assert {(r["src"], r["rank"]): r["dst"] for r in edges} == brute_knn(x, 4, ids)


def test_knn_cuts_k(spark):
    assert N.knn(vectors(spark, RNG.normal(size=(4, 2))), 10).count() == 12


def edges_of(spark, pairs):
    return spark.createDataFrame([(a, b, 1.0) for a, b in pairs] + [(b, a, 1.0) for a, b in pairs], "src long, dst long, weight double")


def nodes_of(spark, n):
    return spark.range(n).withColumnRenamed("id", "cell_id")


def test_components_on_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(39)] + [(50, 51)]
    got = {r["node"]: r["label"] for r in G.connected_components(edges_of(spark, pairs), nodes_of(spark, 53)).collect()}
    assert all(got[i] == 0 for i in range(40)) and got[51] == 50 and got[52] == 52 and got[45] == 45


def test_communities_split_two_cliques(spark):
    clique = lambda lo: [(i, j) for i in range(lo, lo + 6) for j in range(i + 1, lo + 6)]
    e = edges_of(spark, clique(0) + clique(6) + [(5, 6)])
    got = {r["cell_id"]: r["cluster"] for r in G.graph_communities(e, nodes_of(spark, 12)).collect()}
    assert len({got[i] for i in range(6)}) == 1 and len({got[i] for i in range(6, 12)}) == 1 and got[0] != got[6]
    consensus = {r["cell_id"]: r for r in G.consensus_communities(e, nodes_of(spark, 13), repeats=6, min_size=3, iterations=4).collect()}
    assert consensus[0]["cluster"] == consensus[5]["cluster"] != consensus[11]["cluster"]
    assert consensus[12]["cluster"] == "outlier" and 0 <= consensus[0]["agreement"] <= 1


def test_binomial_tail(spark):
    cases = [(k, n, p) for n in (1, 5, 40) for k in (0, n // 2, n) for p in (0.0, 0.2, 0.7, 1.0)]
    df = spark.createDataFrame(cases, "k long, n long, p double")
    for r in df.withColumn("t", stats.binomial_upper_tail(F.col("k"), F.col("n"), F.col("p"))).collect():
        want = sum(math.comb(r["n"], i) * r["p"] ** i * (1 - r["p"]) ** (r["n"] - i) for i in range(r["k"] + 1, r["n"] + 1))
        assert r["t"] == pytest.approx(want, abs=1e-9)


def test_binomial_tail_at_depth(spark):
    # from exact rational sums
    cases = [(199, 200, 0.98, 0.017588), (195, 200, 0.98, 0.62884), (380, 400, 0.9, 9.4654e-5), (10, 201, 0.05, 0.42335)]
    df = spark.createDataFrame(cases, "k long, n long, p double, want double")
    for r in df.withColumn("t", stats.binomial_upper_tail(F.col("k"), F.col("n"), F.col("p"))).collect():
        assert r["t"] == pytest.approx(r["want"], abs=1e-5, rel=1e-4)
    deep = [(k, 5000, p) for p in (0.001, 0.5, 0.999) for k in (0, 10, 2400, 2600, 4990, 4999)]
    df = spark.createDataFrame(deep, "k long, n long, p double")
    for r in df.withColumn("t", stats.binomial_upper_tail(F.col("k"), F.col("n"), F.col("p"))).collect():
        n, p = r["n"], r["p"]
        log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        assert r["t"] == pytest.approx(math.fsum(math.exp(log(i)) for i in range(r["k"] + 1, n + 1)), rel=1e-7, abs=1e-12)


def test_tails(spark):
    row = spark.range(1).select(stats.normal_two_sided(F.lit(1.96)), stats.student_two_sided(F.lit(2.228), F.lit(10.0)), stats.normal_two_sided(F.lit(0.0))).first()
    assert row[0] == pytest.approx(0.05, abs=1e-4) and row[1] == pytest.approx(0.05, abs=1e-3) and row[2] == pytest.approx(1.0, abs=1e-6)


def test_smoothing_equals_direct_kernel_across_tiles(spark):
    pos = sorted({int(p) for p in RNG.integers(1, 3000, 250)})
    data = [(f"c{j}", "chr1", p, int(RNG.integers(0, 2))) for p in pos for j in range(int(RNG.integers(1, 4)))]
    got = {r["pos"]: r["smoothed"] for r in M.smooth_methylation(spark.createDataFrame(data, "cell_id string, chrom string, pos long, call long"), 200, tile=500).collect()}
    assert sorted(got) == pos
    for p in pos:
        w = [((1 - (abs(p - q) / 200) ** 3) ** 3, c) for _, _, q, c in data if abs(p - q) < 200]
        assert got[p] == pytest.approx(sum(a * c for a, c in w) / sum(a for a, _ in w))


def test_fdr_without_permuted_windows_stays_null(spark, rows):
    df = spark.createDataFrame([("a", 3.0, True), ("a", 1.0, True), ("b", 2.0, True), ("b", 2.5, False), ("c", 1.0, False)], "comparison string, abs_t double, is_real boolean")
    assert rows(M.empirical_fdr(df), "comparison", "abs_t", "adj_p") == [("a", 1.0, None), ("a", 3.0, None), ("b", 2.0, 1.0)]
    assert rows(M.comparisons_without_real(df)) == [("c",)]


def counts_frame(spark, cells=160, genes=40):
    data = []
    for i in range(cells):
        kind = i % 2
        lam = np.where(np.arange(genes) % 2 == kind, 6.0, 0.4)
        data += [(f"x{i:03d}", "s", f"g{g:02d}", int(c)) for g, c in enumerate(RNG.poisson(lam)) if c]
    return spark.createDataFrame(data, "cell_id string, sample_id string, gene string, count long")


def test_mixed_cells_score_as_doublets(spark):
    counts = counts_frame(spark)
    # ten cells are sums of one cell of each kind
    mixed = None
    for i in range(10):
        pair = counts.where(F.col("cell_id").isin(f"x{2 * i:03d}", f"x{2 * i + 1:03d}")).groupBy("sample_id", "gene").agg(F.sum("count").alias("count"))
        one = pair.select(F.lit(f"mix{i}").alias("cell_id"), "sample_id", "gene", "count")
        mixed = one if mixed is None else mixed.unionByName(one)
    scored = {r["cell_id"]: r["doublet_score"] for r in B.doublet_scores(counts.unionByName(mixed), expected_rate=0.06, components=5, genes=40).collect()}
    assert len(scored) == 170
    mix = np.mean([v for k, v in scored.items() if k.startswith("mix")])
    assert mix > 3 * np.mean([v for k, v in scored.items() if k.startswith("x")])


def test_doublet_rate_needs_cells(spark):
    few = spark.range(50).select(F.lit("s").alias("sample_id"), F.col("id").cast("string").alias("cell_id"))
    with pytest.raises(Exception, match="too few cells"):
        X.expected_doublet_rate(few).collect()


def test_harmonize_brings_batches_together(spark):
    base = RNG.normal(size=(200, 5)) + np.where(np.arange(200) % 2 == 0, 6, -6)[:, None] * np.array([1, 0, 0, 0, 0])
    batch = np.array(["a", "b"])[(np.arange(200) // 2) % 2]
    shifted = base + np.where(batch == "b", 3.0, 0.0)[:, None] * np.array([0, 1, 0, 0, 0])
    df = spark.createDataFrame([(i, b, [float(v) for v in r]) for i, (b, r) in enumerate(zip(batch, shifted))], "cell_id long, batch string, vec array<double>")
    got = matrix(B.harmonize(df, clusters=4, max_rounds=8), 200)
    gap = lambda x: np.linalg.norm(x[batch == "a"].mean(0) - x[batch == "b"].mean(0))
    assert gap(got) < 0.35 * gap(shifted)
    # the biological axis survives
    assert abs(got[::2, 0].mean() - got[1::2, 0].mean()) > 8


def test_regression_removes_covariates(spark):
    counts = counts_frame(spark, 60, 10)
    values = X.normalize_log1p(counts)
    cells = X.cell_metrics(counts).withColumn("pct_counts_mt", F.col("n_genes_by_counts") % 3)
    genes = counts.select("gene").distinct()
    out = {r["cell_id"]: r["vec"] for r in X.regress_out(values, cells, genes).collect()}
    meta = {r["cell_id"]: r for r in cells.collect()}
    ids = sorted(out)
    res = np.array([out[i] for i in ids])
    for c in ("total_counts", "pct_counts_mt"):
        x = np.array([meta[i][c] for i in ids], dtype=float)
        assert ((x - x.mean()) @ res) == pytest.approx(np.zeros(res.shape[1]), abs=1e-6)


def test_split_is_disjoint_and_seeded(spark):
    cells = spark.range(101).select(F.col("id").cast("string").alias("cell_id"))
    a = {r["cell_id"]: r["split"] for r in B.train_validation_split(cells, 0.1, 1).collect()}
    assert len(a) == 101 and sum(v == "validation" for v in a.values()) == 10
    assert a == {r["cell_id"]: r["split"] for r in B.train_validation_split(cells.repartition(7), 0.1, 1).collect()}
    assert a != {r["cell_id"]: r["split"] for r in B.train_validation_split(cells, 0.1, 2).collect()}


def test_silent_gene_counts_as_zero(spark, rows):
    values = spark.createDataFrame([("a", "g", 2.0), ("b", "g", 4.0)], "cell_id string, gene string, value double")
    groups = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "2")], "cell_id string, cluster string")
    genes = spark.createDataFrame([("g",), ("absent",)], "gene string")
    assert rows(X.dotplot_stats(values, groups, genes), "cluster", "gene", "fraction", "mean_value") == [("1", "g", pytest.approx(2 / 3), 2.0), ("2", "g", 0.0, 0.0)]

"""The expression route: cells as single rows give what long rows give, and nothing is derived that the clusters don't need."""

import numpy as np

import __spark_entry__ as entry
from cellspan.operators import expression as X
from cellspan.operators import neighbors as N
from cellspan.plans import routes


def long_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(f"c{i:02d}", f"s{i % 2}", f"g{j:02d}", int(n)) for i in range(40) for j, n in enumerate(rng.poisson(0.3 + np.arange(20) % 7 / 3)) if n]
    # genes that too few cells of a sample hold, one of them a cell's only gene
    rows += [("c00", "s0", "rare", 5), ("c02", "s0", "rare", 2), ("c99", "s1", "rare", 4), ("c01", "s1", "g00", 0)]
    return spark.createDataFrame(rows, "cell_id string, sample_id string, gene string, count long")


def test_packed_cells_equal_long_rows(spark, rows):
    long = long_rows(spark)
    packed = X.packed_cells(long)
    assert rows(X.unpacked(packed), *long.columns) == rows(long)
    kept = X.packed_gene_min_cells(packed, 3)
    assert rows(X.unpacked(kept), *long.columns) == rows(X.gene_min_cells(long, 3), *long.columns) and kept.where("cell_id = 'c99'").isEmpty()
    values = X.normalize_log1p(X.gene_min_cells(long, 3))
    kept = X.packed_totals(kept)
    exact = lambda df: [(*r[:3], round(r[3], 12)) for r in rows(df, "cell_id", "sample_id", "gene", "value")]
    assert exact(X.packed_values(kept)) == exact(values)
    chosen = X.highly_variable_genes(values, 6)
    names = sorted(r["gene"] for r in chosen.collect())
    found = {r["cell_id"]: r["vec"] for r in X.scale_rows(X.chosen_counts(kept, names), len(names)).collect()}
    wanted = {r["cell_id"]: r["vec"] for r in X.scale_genes(values, values.select("cell_id").distinct(), chosen).collect()}
    assert set(found) == set(wanted) and all(np.allclose(found[c], wanted[c]) for c in wanted)


def test_clusters_are_found_without_marker_scores(spark, monkeypatch):
    def never(*_):
        raise AssertionError("marker scores were derived")

    monkeypatch.setattr(routes.expression, "rank_genes_wilcoxon", never)
    assert entry.queries()["route_expression_clusters"](spark, "/root/testdata/sf0.001").count() > 0


def test_mutual_edges_keep_loops_and_both_ways(spark, rows):
    edges = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5), (1, 3, 1.0), (4, 4, 0.0)], "src long, dst long, dist double")
    assert rows(N.mutual_edges(edges), "src", "dst", "weight") == [(1, 2, 1 / 1.5), (2, 1, 1 / 1.5), (4, 4, 1.0)]

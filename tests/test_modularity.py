"""Parallel modularity moves: against plain Python, on planted groups, and on odd graphs."""

from collections import defaultdict

import numpy as np
import pytest

from cellspan.operators import graph as G


def both_ways(spark, pairs):
    rows = [x for i, j, w in pairs for x in ((i, j, w), (j, i, w))]
    return spark.createDataFrame(rows, "src long, dst long, weight double")


def cells(spark, n):
    return spark.range(n).withColumnRenamed("id", "cell_id")


def plain_modularity(pairs, label, resolution):
    inner, total = 0.0, defaultdict(float)
    for i, j, w in pairs:
        inner += 2 * w * (label[i] == label[j])
        total[label[i]] += w
        total[label[j]] += w
    both = sum(total.values())
    return inner / both - resolution * sum(t * t for t in total.values()) / both**2


def planted(rng, groups, size, subgroups):
    """Groups whose members are often linked, each of subgroups whose members nearly always are."""
    n = groups * size
    out = []
    for i in range(n):
        for j in range(i + 1, n):
            same, near = i // size == j // size, i // (size // subgroups) == j // (size // subgroups)
            if rng.random() < (0.95 if near else 0.25 if same else 0.005):
                out.append((i, j, 1.0))
    return out, n


def test_modularity_never_falls_and_is_told_right(spark):
    pairs, n = planted(np.random.default_rng(2), 3, 16, 2)
    edges = both_ways(spark, pairs)
    found = {}
    # expected weight of a pair is some 0.18 times the resolution: 0.09 parts groups (0.25 against 0.005), 0.45 subgroups (0.95 against 0.25)
    for resolution in (0.5, 2.5):
        labels, history = G.modular_levels(edges, cells(spark, n), resolution=resolution)
        label = {r["node"]: r["label"] for r in labels.collect()}
        assert len(label) == n and all(a < b for a, b in zip(history, history[1:]))
        assert history[-1] == pytest.approx(plain_modularity(pairs, label, resolution), abs=1e-9)
        told = G.modularity(edges, G.number_by_size(labels), [resolution]).first()["modularity"]
        assert told == pytest.approx(history[-1], abs=1e-9)
        truth = {i: i // 16 if resolution < 1 else i // 8 for i in range(n)}
        assert history[-1] >= plain_modularity(pairs, truth, resolution) - 1e-9
        found[resolution] = label
    wide, narrow = (set(found[g].values()) for g in (0.5, 2.5))
    assert len(wide) == 3 and len(narrow) == 6
    # every narrow community lies in one wide one
    assert len({(found[2.5][i], found[0.5][i]) for i in range(n)}) == 6


def test_swapping_pairs_settle_and_lone_nodes_stay(spark):
    pairs = [(0, 1, 1.0), (2, 3, 1.0), (4, 5, 2.0), (5, 6, 2.0), (4, 6, 2.0)]
    got = {r["cell_id"]: r["cluster"] for r in G.modular_communities(both_ways(spark, pairs), cells(spark, 8)).collect()}
    assert got[4] == got[5] == got[6] == 0 and got[0] == got[1] and got[2] == got[3] and len(set(got.values())) == 4


def test_no_edges(spark):
    labels, history = G.modular_levels(both_ways(spark, [(0, 1, 1.0)]).where("src < 0"), cells(spark, 3))
    assert history == [0.0] and sorted(labels.collect()) == [(0, 0), (1, 1), (2, 2)]

"""Neighbour descent, graph layout and the sweep: recall, residuals, and equal single runs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators import density, layout, neighbours
from topicloom.operators.descent import knn_descent
from topicloom.plans import queries as Q


def recall(found, exact, k):
    truth = {r.i: r.farthest for r in exact.where(F.col("rank") == k).select(
        "i", F.col("measure").alias("farthest")).collect()}
    hits = sum(r.measure >= truth[r.i] - 1e-9 for r in found.collect())
    return hits / (k * len(truth))


@pytest.mark.parametrize("name", ["embeddings", "texts"])
def test_descent_recall(spark, medium, name, capsys):
    """Against the exact graph, on vectors that are close to random and on texts' vectors."""
    df, node, vec = ((Q.read(spark, medium, "embeddings"), "vec_id", "embedding")
                     if name == "embeddings" else (Q.hashed(spark, medium), "doc_id", "vec"))
    exact = neighbours.knn_graph(df, node, vec, 5)
    found = knn_descent(df, node, vec, 5, leaf_rows=32)
    assert found.groupBy("i").count().where("count <> 5").isEmpty()
    assert found.select("i", "j").distinct().count() == found.count()
    got = recall(found, exact, 5)
    with capsys.disabled():
        print(f"recall of 5 nearest, {name}: {got:.3f}")
    assert got >= 0.9


def test_descent_on_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, [0.0, 0.0])],
                               "id bigint, v array<double>")
    got = {(r.i, r.j, r["rank"]) for r in knn_descent(df, "id", "v", 3).collect()}
    assert got == {(1, 2, 1), (2, 1, 1)}
    assert knn_descent(df.limit(0), "id", "v", 3).count() == 0


def planted(spark, parts=3, size=40, seed=8):
    """A graph of dense parts with a few edges between them."""
    rng = np.random.default_rng(seed)
    edges = [(a * size + i, a * size + j, 1.0) for a in range(parts) for i in range(size)
             for j in range(i) if rng.random() < 0.3]
    edges += [(a * size, (a + 1) % parts * size + 1, 1.0) for a in range(parts)]
    return edges, spark.createDataFrame(edges, "i bigint, j bigint, w double")


def test_layout_is_the_leading_eigenvectors(spark):
    edges, df = planted(spark)
    found = layout.graph_layout(df, "w", dims=2, tolerance=1e-5, rounds=60)
    n = 120
    w = np.zeros((n, n))
    for i, j, x in edges:
        w[i, j] = w[j, i] = x
    d = w.sum(1)
    values, vectors = np.linalg.eigh((np.eye(n) + w / np.sqrt(d[:, None] * d[None])) / 2)
    assert found.residual <= 1e-5
    assert found.values == pytest.approx(values[::-1][1:3], abs=1e-8)
    x = np.zeros((n, 2))
    for r in found.nodes.collect():
        x[r.node] = r.coordinates
    # The same plane, whichever vectors of equal value span it.
    top = vectors[:, ::-1][:, 1:3]
    assert np.linalg.norm(x - top @ (top.T @ x)) < 1e-3
    assert np.abs(x.T @ x - np.eye(2)).max() < 1e-6
    # Parts lie apart.
    centres = np.array([x[a * 40:a * 40 + 40].mean(0) for a in range(3)])
    own = np.abs(x - np.repeat(centres, 40, axis=0)).max()
    between = min(np.linalg.norm(centres[a] - centres[b]) for a in range(3) for b in range(a))
    assert between > 2 * own


def test_layout_of_little(spark):
    empty = spark.createDataFrame([], "i bigint, j bigint, w double")
    assert layout.graph_layout(empty, "w").nodes.count() == 0
    loops = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.0)], "i bigint, j bigint, w double")
    assert layout.graph_layout(loops, "w").nodes.count() == 0
    pair = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5)], "i bigint, j bigint, w double")
    got = layout.graph_layout(pair, "w", dims=2)
    assert {r.node for r in got.nodes.collect()} == {1, 2} and len(got.values) == 1


def test_sweep_equals_single_runs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    v = np.repeat(rng.normal(size=(5, 4)) * 4, 30, axis=0) + rng.normal(size=(150, 4)) * 0.4
    v[::11] = v[1]
    df = spark.createDataFrame([(10 ** 17 + k, x.tolist()) for k, x in enumerate(v)],
                               "id bigint, v array<double>")
    configs = [{"min_samples": 4, "min_cluster_size": 6, "floor": 0.2},
               {"min_samples": 2, "min_cluster_size": 5, "floor": 0.1, "largest": 1.0},
               {"min_samples": 4, "min_cluster_size": 12, "floor": 0.5, "components": 2}]
    searches = []
    real = density.nearest_points
    monkeypatch.setattr(density, "nearest_points", lambda *a: searches.append(a[1]) or real(*a))
    got = {}
    for r in density.sweep_leaves(df, "id", "v", configs).collect():
        got.setdefault(r.config, {})[r.id] = r.cluster_id
    assert sorted(searches) == [3, 3]  # once for the vectors, once for their components
    for n, c in [(1, configs[1])]:  # the other one has no largest distance, see test_forest
        tree = density.density_tree(df, "id", "v", c.get("largest"), c["min_samples"])
        want = density.tree_leaves(tree, c["floor"], c["min_cluster_size"])
        assert got[n] == {r.node: r.cluster_id for r in want.collect()}
    assert len(got[2]) == 150 and max(got[2].values()) >= 2

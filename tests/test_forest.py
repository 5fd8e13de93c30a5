"""Forests, merge trees and density leaves against plain loops; block pairs against all pairs."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators import balls, density, forest, ladder, neighbours


def edge_table(spark, edges):
    return spark.createDataFrame(edges, "i bigint, j bigint, weight double").repartition(4)


def random_edges(seed, n, m, weights):
    rng = random.Random(seed)
    return [(a, b, float(rng.choice(weights))) for a, b in
            ((rng.randrange(n), rng.randrange(n)) for _ in range(m))]


def kruskal(edges):
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    kept = set()
    for w, i, j in sorted({(w, min(i, j), max(i, j)) for i, j, w in edges if i != j}):
        a, b = top(i), top(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.add((i, j, w))
    return kept


def parts_at(nodes, edges, t):
    root = {k: k for k in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j, w in edges:
        if w <= t and i != j:
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return {k: top(k) for k in nodes}


CASES = {
    "sparse": random_edges(1, 80, 70, [k / 7 for k in range(60)]),
    "dense": random_edges(2, 40, 400, [k / 3 for k in range(900)]),
    "ties": random_edges(3, 60, 200, [0.25, 0.5, 0.75]),
    "path": [(k, k + 1, float((k * 37) % 101)) for k in range(100)],
    "rising path": [(k, k + 1, float(k)) for k in range(70)],
    "star": [(0, k, float(k % 9)) for k in range(1, 90)],
    "none": [], "loop only": [(4, 4, 1.0)],
}


# All cases as one graph of many trees.
EDGES = [(1000 * k + i, 1000 * k + j, w) for k, case in enumerate(CASES.values())
         for i, j, w in case]
NODES = sorted({x for i, j, _ in EDGES for x in (i, j)} | {99_000})


@pytest.fixture(scope="module")
def tree(spark):
    return forest.merge_tree(forest.spanning_forest(edge_table(spark, EDGES)))


def test_forest(tree):
    got = {tuple(r) for r in tree.forest.edges().select("i", "j", "weight").collect()}
    assert got == kruskal(EDGES)
    assert tree.forest.rounds <= 7


def test_cuts(spark, tree):
    table = spark.createDataFrame([(k,) for k in NODES], "node bigint")
    levels = sorted({w for _, _, w in EDGES})[::40] + [-1.0, 0.5, 1e9]
    got = forest.cuts(tree, table, levels).collect()
    want = {(t, k, c) for t in levels for k, c in parts_at(NODES, EDGES, t).items()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_no_edges(spark):
    tree = forest.merge_tree(forest.spanning_forest(edge_table(spark, [(4, 4, 1.0)])))
    table = spark.createDataFrame([(4,), (7,)], "node bigint")
    assert {tuple(r) for r in forest.cuts(tree, table, [0.5, 2.0]).collect()} == {
        (t, k, k) for t in (0.5, 2.0) for k in (4, 7)}
    points = spark.createDataFrame([(4, 3), (7, 1)], "point bigint, rows bigint")
    lv = forest.levels(tree, points)
    assert lv.nodes.count() == 0
    assert {tuple(r) for r in forest.leaf_groups(lv, 2).collect()} == {(4, -5)}


def test_merge_tree_sizes(spark, tree):
    """Every level's node holds the rows of the part that its weight makes."""
    rows = {k: 1 + k % 3 for k in NODES}
    points = spark.createDataFrame(list(rows.items()), "point bigint, rows bigint")
    lv = forest.levels(tree, points)
    want = collections.Counter()
    before = {k: k for k in NODES}
    for t in sorted({w for i, j, w in EDGES if i != j}):
        now = parts_at(NODES, EDGES, t)
        sizes = collections.Counter()
        for k in NODES:
            sizes[now[k]] += rows[k]
        for c in {now[k] for k in NODES if now[k] != before[k]}:
            want[t, sizes[c]] += 1
        before = now
    got = lv.nodes.select("node", "weight", "size", "parent").collect()
    assert collections.Counter((r.weight, r["size"]) for r in got) == want
    weight = {r.node: r.weight for r in got}
    assert all(r.parent is None or weight[r.parent] > r.weight for r in got)
    leaves = {r.point: r for r in lv.leaves.collect()}
    assert set(leaves) == set(NODES) and leaves[99_000].parent is None


def slow_leaves(nodes, rows, edges, size, floor, roots_count):
    """Going down all distinct weights; (point, smallest point of its leaf)."""
    weights = sorted({w for _, _, w in edges}, reverse=True)
    stages = [parts_at(nodes, edges, t) for t in weights] + [{k: k for k in nodes}]

    def groups(stage, inside):
        out = collections.defaultdict(list)
        for k in inside:
            out[stage[k]].append(k)
        return [g for g in out.values() if sum(rows[k] for k in g) >= size]
    done = []

    def down(group, at, counted):
        for n in range(at, len(weights)):
            parts = groups(stages[n + 1], group)
            if len(parts) >= 2 and (weights[n] >= floor or not counted):
                for part in parts:
                    down(part, n + 1, True)
                return
        if counted:
            done.append(group)
    for g in groups(stages[0], nodes):
        down(g, 0, roots_count)
    return {k: min(g) for g in done for k in g}


def test_leaf_groups(spark, tree):
    rows = {k: 1 + (k % 5 == 0) * 2 for k in NODES}
    points = spark.createDataFrame(list(rows.items()), "point bigint, rows bigint")
    lv = forest.levels(tree, points)
    for size, floor in ((2, 0.0), (3, 0.5), (5, 4.0)):
        got = collections.defaultdict(set)
        for r in forest.leaf_groups(lv, size, floor).collect():
            got[r.group].add(r.point)
        assert {k: min(g) for g in got.values() for k in g} == slow_leaves(
            NODES, rows, EDGES, size, floor, True)


def blobs(seed, n, dims=6, centres=7):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims)) * 3
    v = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * 0.3
    v[::17] = v[0]
    return v


def vectors(spark, v):
    return spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)],
                                 "id bigint, v array<double>").repartition(4)


def test_tree_equals_clusters_at_every_radius(spark):
    df = vectors(spark, blobs(4, 260))
    radii = [0.3, 0.6, 1.2]
    tree = density.density_tree(df, "id", "v", block_rows=256)
    rows = collections.defaultdict(dict)
    for r in density.clusters_at(tree, radii).collect():
        rows[r.radius][r.node] = r.cluster_id
    for radius in radii:
        want = density.density_clusters(df, "id", "v", epsilon=radius)
        assert rows[radius] == {r.id: r.cluster_id for r in want.collect()}


def test_tree_leaves_without_a_largest_distance(spark):
    """Everything together is no cluster, and its first split counts below the floor too."""
    v = np.concatenate([np.arange(20)[:, None] * 0.01, 1 + np.arange(20)[:, None] * 0.01])
    v = np.concatenate([v, np.zeros_like(v)], axis=1)
    tree = density.density_tree(vectors(spark, v), "id", "v", min_samples=2)
    labels = {r.node: r.cluster_id for r in density.tree_leaves(tree, floor=50.0).collect()}
    assert labels == {k: int(k >= 20) for k in range(40)}
    one = density.density_tree(vectors(spark, v[:20]), "id", "v", min_samples=2)
    assert {r.cluster_id for r in density.tree_leaves(one).collect()} == {-1}
    limited = density.density_tree(vectors(spark, v[:20]), "id", "v", 5.0, min_samples=2)
    assert {r.cluster_id for r in density.tree_leaves(limited).collect()} == {0}


@pytest.mark.parametrize("n,block,reach", [(50, 64, 0.5), (900, 64, 0.8), (900, 64, 30.0),
                                           (700, 16, 0.4)])
def test_block_pairs_lose_no_pair(spark, n, block, reach):
    v = np.unique(blobs(n + block, n), axis=0)
    rows = vectors(spark, v).withColumn("core", F.lit(0.0))
    tree = balls.ball_blocks(rows, len(v), block)
    of = {r.id: r.block for r in tree.rows.collect()}
    assert len(of) == len(v) and max(collections.Counter(of.values()).values()) <= block
    listed = [tuple(r) for r in balls.block_pairs(tree, reach).collect()]
    assert len(listed) == len(set(listed))
    pairs = {frozenset(p) for p in listed}
    assert len(pairs) == len(listed)
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    for i, j in zip(*np.nonzero(d <= reach)):
        assert frozenset((of[i], of[j])) in pairs
    if n > block and reach < 1:
        assert len(pairs) < len(set(of.values())) ** 2 / 2


def test_points_that_pivots_cannot_part(spark, monkeypatch):
    """A level of hashing parts what no pivot does, with the same result."""
    monkeypatch.setattr(balls, "PIVOT_LEVELS", 1)
    v = np.unique(blobs(9, 600), axis=0)
    df = vectors(spark, v)
    p = neighbours.distinct_points(df, "id", "v", "euclidean")
    got = {(r.i, r.j) for r in neighbours.pairs_within(p, 0.5, block_rows=16).collect()}
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    assert got == {(i, j) for i, j in zip(*np.nonzero(d <= 0.5)) if i < j}


def test_copies_of_a_row_stay_below_all_blocks(spark, capsys):
    """20,000 vectors in clusters: how often a row is sent, against comparing all blocks."""
    v = blobs(11, 20_000, dims=16, centres=40)
    p = neighbours.distinct_points(vectors(spark, v), "id", "v", "euclidean")
    rows = p.points.select("id", "v", F.lit(0.0).alias("core"))
    tree = balls.ball_blocks(rows, p.count, 256)
    sent = balls.dealt_to_pairs(tree, balls.block_pairs(tree, 0.5)).count()
    factor = sent / p.count
    with capsys.disabled():
        print(f"copies of a row: {factor:.1f}, of {p.count / 256:.0f} when all blocks meet")
    assert factor < p.count / 256 / 2


def test_lineage_passes_are_logarithmic(spark, monkeypatch):
    """A chain of 40 merges takes 6 passes and one that finds nothing."""
    leaves = spark.createDataFrame([(0,), (500,)], "node_id bigint")
    history = spark.createDataFrame(
        [(1.0 - k / 100, k + 1, k, k + 1, "x") for k in range(40)],
        "level double, round int, child_id bigint, parent_id bigint, new_name string")
    passes = []
    real = ladder.cut_with
    monkeypatch.setattr(ladder, "cut_with", lambda *a, **m: passes.append(1) or real(*a, **m))
    got = {tuple(r) for r in ladder.lineage(leaves, history).collect()}
    assert got == {(0, None, 0, 0), (500, None, 0, 500),
                   *((0, 1.0 - k / 100, k + 1, k + 1) for k in range(40))}
    assert len(passes) == 7

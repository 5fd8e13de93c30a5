"""Neighbours, components, density and the ladder against numpy on small tables."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.functions import vectors as V
from topicloom.operators import density, ladder, neighbours
from topicloom.operators.graph import connected_components
from topicloom.operators.ranking import ordinal, sample_n, top_k
from topicloom.plans import queries as Q

rng = np.random.default_rng(7)


def blobs(n=240, dims=8, centres=6, copies=40):
    """Clustered vectors; the last ``copies`` rows hold one and the same vector."""
    middle = rng.normal(size=(centres, dims))
    v = middle[rng.integers(centres, size=n)] + 0.25 * rng.normal(size=(n, dims))
    v[-copies:] = v[0]
    return v


VECTORS = blobs()


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(VECTORS)],
                                 "id bigint, vec array<double>").cache()


def groups_of(adjacent: np.ndarray) -> np.ndarray:
    label = np.arange(len(adjacent))
    while True:
        new = np.array([min(label[i], label[adjacent[i]].min(initial=label[i]))
                        for i in range(len(label))])
        if (new == label).all():
            return label
        label = new


def cosines() -> np.ndarray:
    unit = VECTORS / np.linalg.norm(VECTORS, axis=1)[:, None]
    return unit @ unit.T


def distances() -> np.ndarray:
    d = np.sqrt(((VECTORS[:, None] - VECTORS[None]) ** 2).sum(-1))
    return d


# block_rows of 2048 compares everything in one task, 16 uses cells and blocks.
@pytest.mark.parametrize("block_rows", [2048, 16])
def test_cosine_pairs(table, block_rows):
    got = neighbours.cosine_pairs(table, "id", "vec", 0.9, block_rows).collect()
    point = np.where(np.arange(len(VECTORS)) >= len(VECTORS) - 40, 0, np.arange(len(VECTORS)))
    firsts = np.unique(point)
    c = cosines()
    want = {(i, j) for i in firsts for j in firsts if i < j and c[i, j] >= 0.9}
    assert {(r["i"], r["j"]) for r in got} == want
    assert {r["copies_i"] for r in got if r["i"] == 0} <= {41}


@pytest.mark.parametrize("block_rows", [2048, 16])
@pytest.mark.parametrize("emit", ["pairs", "forest", "stars"])
def test_components_do_not_depend_on_what_is_emitted(table, block_rows, emit):
    p = neighbours.distinct_points(table, "id", "vec")
    edges = neighbours.pairs_within(p, neighbours.cosine_limit(0.9), emit, block_rows)
    linked = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    want = groups_of(cosines() >= 0.9 - 1e-12)
    for r in p.points.select("id").collect():
        assert linked.get(r["id"], r["id"]) == want[r["id"]]


@pytest.mark.parametrize("block_rows", [2048, 16])
@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_knn_with_copies(table, block_rows, metric):
    got = neighbours.knn_graph(table, "id", "vec", 3, metric, block_rows).collect()
    m = np.round(-cosines() if metric == "cosine" else distances(), 6)
    np.fill_diagonal(m, np.inf)
    want = {(i, j) for i in range(len(m))
            for j in np.lexsort((np.arange(len(m)), m[i]))[:3]}
    assert {(r["i"], r["j"]) for r in got} == want


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_density_clusters(table, block_rows):
    got = {r["id"]: r["cluster_id"] for r in density.density_clusters(
        table, "id", "vec", epsilon=0.6, block_rows=block_rows).collect()}
    d = distances()
    core = np.sort(d, axis=1)[:, 4]
    dense = core <= 0.6
    label = groups_of((d <= 0.6) & dense[:, None] & dense[None])
    ids, sizes = np.unique(label[dense], return_counts=True)
    number = {c: k for k, c in enumerate(ids[sizes >= 10])}
    want = {n: number.get(label[n], -1) if dense[n] else -1 for n in range(len(d))}
    assert got == want


def test_density_leaves_split(spark):
    """Two tight groups joined at a wide radius: leaves keep them apart."""
    a = [(n, [0.0 + n * 0.01, 0.0]) for n in range(12)]
    b = [(20 + n, [1.0 + n * 0.01, 0.0]) for n in range(12)]
    df = spark.createDataFrame(a + b, "id bigint, vec array<double>")
    flat = density.density_clusters(df, "id", "vec", epsilon=2.0)
    assert flat.select("cluster_id").distinct().count() == 1
    leaves = {r["id"]: r["cluster_id"] for r in
              density.density_leaves(df, "id", "vec", [2.0, 0.5, 0.2]).collect()}
    assert {leaves[n] for n, _ in a} == {0} and {leaves[n] for n, _ in b} == {1}


def test_path_graph(spark):
    edges = spark.range(200).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"))
    got = connected_components(edges)
    assert got.count() == 201 and {r[0] for r in got.select("component").distinct().collect()} == {0}


def test_zero_vectors_stay_alone(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0])],
                               "id bigint, vec array<double>")
    got = {r["id"]: r["component"] for r in
           density.threshold_groups(df, "id", "vec", 0.5).collect()}
    assert got == {1: 1, 2: 2, 3: 3}


def test_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, vec array<double>")
    assert density.threshold_groups(df, "id", "vec", 0.5).count() == 0
    assert neighbours.knn_graph(df, "id", "vec", 3).count() == 0


def test_unit_and_finite(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([float("nan"), 1.0],)],
                               "v array<double>")
    got = [r[0] for r in df.select(V.unit(V.finite(F.col("v")))).collect()]
    assert got == [[0.6, 0.8], [0.0, 0.0], [0.0, 1.0]]


def test_ordinal_and_sample(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("k"))
    numbered = {r["k"]: r["n"] for r in ordinal(df, ["k"], "n", 5).collect()}
    assert [numbered[k] for k in sorted(numbered)] == list(range(5, 1005))
    drawn = {r[0] for r in sample_n(df, "k", 50).collect()}
    by_digest = sorted(numbered, key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    assert drawn == set(by_digest[:50])
    assert sample_n(df, "k", 5000).count() == 1000 and sample_n(df.limit(0), "k", 5).count() == 0


def test_null_and_ragged_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [4.0, 5.0]), (4, [])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    found = {(r["i"], r["j"]) for r in neighbours.knn_graph(df, "id", "v", 2, "euclidean").collect()}
    assert found == {(1, 3), (3, 1)}
    ragged = df.unionByName(spark.createDataFrame([(5, [1.0])], df.schema))
    with pytest.raises(ValueError):
        neighbours.knn_graph(ragged, "id", "v", 2, "euclidean")


def test_one_bad_prompt_costs_one_answer(spark):
    from topicloom.operators.labels import ask

    def model():
        def answer(prompts):
            if "p7" in prompts:
                raise RuntimeError("no")
            return [p.upper() for p in prompts]
        return answer
    df = spark.createDataFrame([(f"p{k}",) for k in range(100)], "p string").coalesce(1)
    got = {r["p"]: r for r in ask(df, "p", "a", model, error="e").collect()}
    assert got["p7"]["a"] is None and "no" in got["p7"]["e"]
    assert all(r["a"] == p.upper() and r["e"] is None for p, r in got.items() if p != "p7")


def test_salted_top_k(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), F.col("id"), (F.col("id") % 7).alias("s"))
    order = [F.desc("s"), F.asc("id")]
    plain = top_k(df, ["g"], order, 1500).collect()
    salted = top_k(df, ["g"], order, 1500, salt=F.col("id")).collect()
    assert sorted(plain) == sorted(salted) and len(salted) == 1500


# Expected numbers come from a separate numpy run of the same recipe.
def test_ladder(spark, medium):
    nodes = Q.topic_nodes(spark, medium)
    done = ladder.merge_ladder(nodes)
    rounds = (done.history.groupBy("level", "round")
              .agg(F.count_distinct("parent_id").alias("groups"), F.count("*").alias("rows"))
              .orderBy("round").collect())
    left, seen = 80, []
    for r in rounds:
        left += r["groups"] - r["rows"]
        seen.append((r["level"], r["groups"], left))
    assert seen == [(0.95, 4, 44), (0.95, 3, 36), (0.95, 1, 34), (0.92, 3, 25), (0.92, 2, 22),
                    (0.89, 2, 16), (0.86, 2, 13), (0.86, 1, 12), (0.83, 2, 8), (0.74, 1, 7),
                    (0.71, 1, 6), (0.65, 2, 4), (0.59, 1, 3)]
    assert done.final.count() == 3
    summary = {r["level"]: r["n_clusters_remaining"] for r in done.summary.collect()}
    assert summary[0.59] == 3 and summary[0.95] == 34
    paths = ladder.lineage(nodes, done.history)
    ends = ladder.members_at(paths, 0.5)
    assert ends.count() == 80
    sizes = {r["node_id"]: r["n"] for r in ends.groupBy("node_id").agg(
        F.count("*").alias("n")).collect()}
    assert sizes == {r["node_id"]: r["leaves"] for r in done.final.collect()}

"""What grows with the input: rows sent, calls of tasks, tables that reach the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from topicloom.functions.tiles import Meeting, grow_forests
from topicloom.operators import descent, layout, neighbours


def vectors(spark, v):
    return spark.createDataFrame([(n, x.tolist()) for n, x in enumerate(v)],
                                 "id bigint, v array<double>")


@pytest.mark.parametrize("n", [600, 2400])
def test_a_row_is_sent_a_dozen_times(spark, monkeypatch, n):
    sent = []
    real = neighbours.dealt_to_pairs

    def dealt(*a):
        out = real(*a)
        sent.append(out.count())
        return out
    monkeypatch.setattr(neighbours, "dealt_to_pairs", dealt)
    v = np.random.default_rng(1).normal(size=(n, 6))
    p = neighbours.distinct_points(vectors(spark, v), "id", "v", "euclidean")
    got = {(r.i, r.j) for r in neighbours.nearest_points(p, 3, 16).collect()}
    assert sent and max(sent) <= n * neighbours.PACKS
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert got == {(i, int(j)) for i in range(n) for j in np.argsort(d[i])[:3]}


@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_forest_that_drops_joined_pairs(monkeypatch, shift):
    """Settled after every tile, far from the origin, the forest weighs what Kruskal's does."""
    from topicloom.functions import tiles
    from topicloom.functions.matrices import spanning_forest
    monkeypatch.setattr(tiles, "BUFFER", 1)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 5)) + 3 * rng.normal(size=(4, 5))[rng.integers(4, size=300)] + shift
    meet = Meeting([v[:170], v[170:]], 16)
    cores = rng.uniform(0, 1, size=(300, 1))[meet.order]
    found, = grow_forests(meet, "euclidean", [2.5], cores)
    d = np.sqrt(((meet.v[:, None] - meet.v[None]) ** 2).sum(2))
    w = np.round(np.maximum(d, np.maximum(cores, cores.T)), 10)
    first = meet.order < 170
    i, j = np.nonzero((w <= 2.5) & first[:, None] & ~first[None])
    kept, _ = spanning_forest(i, j, w[i, j], 300)
    assert np.allclose(np.sort(found.weight), np.sort(w[i, j][kept]), atol=1e-9)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_many_meetings_in_one_call(metric):
    rng = np.random.default_rng(5)
    rows = [(at, int(k), bool(rng.integers(2)), float(rng.choice([0.9, np.inf])))
            for at in range(200) for k in rng.choice(1000, rng.integers(1, 12), replace=False)]
    v = rng.normal(size=(1000, 4))
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [rows[k] for k in rng.permutation(len(rows))]
    table = pa.table({"at": [r[0] for r in rows], "id": [r[1] for r in rows],
                      "new": [r[2] for r in rows], "worst": [r[3] for r in rows],
                      "v": pa.array([v[r[1]].tolist() for r in rows], pa.list_(pa.float64()))})
    got = descent._at_points(metric, 3)(table)
    want = []
    for at in range(200):
        mine = [r for r in rows if r[0] == at]
        for _, i, new, worst in mine:
            near = sorted((round(-float(v[i] @ v[j]) if metric == "cosine" else
                                 float(np.linalg.norm(v[i] - v[j])), 10), j)
                          for _, j, also, _ in mine if j != i and (new or also))
            want += [(i, j) for m, j in near if m < worst][:3]
    assert sorted(zip(got["i"].to_pylist(), got["j"].to_pylist())) == sorted(want)


def test_layout_sends_no_table_of_nodes_to_the_driver(spark, monkeypatch):
    plans = []
    real = layout.cut_with

    def seen(df, *a, **m):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *a, **m)
    monkeypatch.setattr(layout, "cut_with", seen)
    edges = spark.createDataFrame([(k, (k * 7 + 1) % 60, 1.0) for k in range(60)],
                                  "i bigint, j bigint, w double")
    assert layout.graph_layout(edges, "w", rounds=3).nodes.count() == 60
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("side", [5, 7])
def test_any_two_packs_share_one_line(spark, side):
    packs = spark.range(side * side)
    pairs = packs.toDF("a").crossJoin(packs.toDF("b")).where("a <= b")
    rows = neighbours._lines(pairs, side).collect()
    assert len(rows) == len({(r.a, r.b) for r in rows}) == pairs.count()
    assert all(r.whole == (r.a // side == r.b // side) for r in rows)
    of_pack = {}
    for r in rows:
        of_pack.setdefault(r.a, set()).add(r.line)
        of_pack.setdefault(r.b, set()).add(r.line)
    assert all(len(lines) == side + 1 for lines in of_pack.values())
    assert len({r.line for r in rows}) == side * (side + 1)


def test_a_row_is_sent_six_times(spark, monkeypatch):
    """All packs meet, and a row goes to half as many tasks as there were packs before."""
    sent = []
    real = neighbours.dealt_to_pairs

    def dealt(*a):
        out = real(*a)
        sent.append(out.count())
        return out
    monkeypatch.setattr(neighbours, "dealt_to_pairs", dealt)
    v = np.random.default_rng(2).normal(size=(900, 6))
    p = neighbours.distinct_points(vectors(spark, v), "id", "v", "euclidean")
    got = {(r.i, r.j) for r in neighbours.pairs_within(p, 1.5, block_rows=16).collect()}
    assert sent and max(sent) <= 6 * 900
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(d <= 1.5, 1)))}


def test_grid_grows_with_the_points():
    sides = [neighbours._grid_side(n) for n in (1, 10 ** 6, 2 * 10 ** 6, 3 * 10 ** 6)]
    assert sides == [5, 5, 11, 13]
    assert all(n / neighbours._grid_side(n) <= neighbours.LINE_ROWS for n in (10 ** 6, 10 ** 7))


def test_packs_are_dealt_without_a_sort(spark, monkeypatch):
    """Packs of about one size along the tree, for which no row is sorted or written again."""
    from topicloom.operators import ranking

    def no_sort(*_):
        raise AssertionError("rows were numbered")
    monkeypatch.setattr(ranking, "cut", no_sort)
    v = np.random.default_rng(8).normal(size=(3000, 5))
    p = neighbours.distinct_points(vectors(spark, v), "id", "v", "euclidean")
    rows = p.points.selectExpr("id", "v", "0.0D AS core")
    _, placed = neighbours._packed(rows, p.count, 16)
    got = placed.select("id", "block", "pack").collect()
    sizes = np.bincount([r.pack for r in got], minlength=neighbours.GRID ** 2)
    assert len({r.id for r in got}) == len(got) == 3000
    assert len(sizes) == neighbours.GRID ** 2 and 60 < sizes.min() and sizes.max() < 180
    last = sorted((r.block, r.pack) for r in got)
    ends = {b: [k for c, k in last if c == b] for b, _ in last}
    order = sorted(ends)
    assert all(max(ends[a]) <= min(ends[b]) for a, b in zip(order, order[1:]))
    again = {(r.id, r.pack) for r in placed.repartition(7).select("id", "pack").collect()}
    assert again == {(r.id, r.pack) for r in got}


@pytest.mark.parametrize("most", [0, 1 << 17])
def test_only_copied_vectors_meet_their_rows(spark, monkeypatch, most):
    monkeypatch.setattr(neighbours, "SHARED", most)
    rows = [(1, [0.0, 1.0]), (2, [-0.0, 1.0]), (3, [1.0, 0.0]), (4, [2.0, 2.0]), (5, [0.0, 1.0]),
            (7, [2.0, 2.0]), (7, [2.0, 2.0]), (None, [1.0, 0.0]), (8, None), (9, [float("nan"), 1.0])]
    p = neighbours.distinct_points(spark.createDataFrame(rows, "id bigint, v array<double>"),
                                   "id", "v", "euclidean")
    assert sorted(tuple(r) for r in p.members.select("id", "point").collect()) == [
        (1, 1), (2, 1), (3, 3), (4, 4), (5, 1), (7, 4), (7, 4), (9, 1)]
    # Written once, however often the rows are looked up.
    assert spark.read.parquet(*p.members.inputFiles()).columns == ["id", "point"]


@pytest.mark.parametrize("n", [600, 1800])
def test_forests_of_packs_hold_a_few_edges_a_point(spark, n):
    """All pairs count, so pairs of blocks would give edges that grow with the square."""
    v = np.random.default_rng(9).normal(size=(n, 4)) + 3
    p = neighbours.distinct_points(vectors(spark, v), "id", "v")
    found = neighbours.pairs_within(p, neighbours.cosine_limit(0.01), "forest", 16)
    assert n - 1 <= found.count() <= neighbours.PACKS * n


def test_forest_looks_at_few_pairs(monkeypatch):
    """Most of 2,000 points are within the limit of each other, but few pairs may join anything."""
    from topicloom.functions import tiles
    from topicloom.functions.matrices import spanning_forest
    measured = []
    real = tiles.exact
    monkeypatch.setattr(tiles, "exact", lambda x, y, row, col, metric: (
        measured.append(len(row)), real(x, y, row, col, metric))[1])
    rng = np.random.default_rng(8)
    v = 0.1 * rng.normal(size=(2000, 8)) + rng.normal(size=(3, 8))[rng.integers(3, size=2000)]
    meet = Meeting([v], 512)
    cores = rng.uniform(0, 0.1, size=(2000, 1))
    for flat in (False, True):
        measured.clear()
        found, = grow_forests(meet, "euclidean", [3.0], cores, flat)
        assert sum(measured) < 100 * 2000
        d = np.sqrt(((meet.v[:, None] - meet.v[None]) ** 2).sum(2))
        w = np.round(np.maximum(d, np.maximum(cores, cores.T)), 10)
        i, j = np.nonzero(np.triu(w <= 3.0, 1))
        kept, _ = spanning_forest(i, j, w[i, j], 2000)
        assert len(found.weight) == len(kept)
        if not flat:
            assert np.allclose(np.sort(found.weight), np.sort(w[i, j][kept]), atol=1e-9)


def test_a_token_is_hashed_once_a_batch(monkeypatch):
    from topicloom.functions import vectors as V
    hashed = []
    real = V.hashlib.md5
    monkeypatch.setattr(V.hashlib, "md5", lambda word: (hashed.append(word), real(word))[1])
    monkeypatch.setattr(V, "TOKENS", 3)
    got = V._hashed(4)(pa.array([["a", "b", "a"], None, [], ["b", "c", "a", "a"], ["論文"]]))
    assert sorted(hashed) == sorted(["a".encode(), b"b", b"c", "論文".encode()])
    want = []
    for words in (["a", "b", "a"], [], [], ["b", "c", "a", "a"], ["論文"]):
        row = [0.0] * 4
        for word in words:
            h = real(word.encode()).hexdigest()
            row[int(h[:8], 16) % 4] += 1 if h[15] in "13579bdf" else -1
        norm = sum(x * x for x in row) ** 0.5
        want.append([x / norm if norm else x for x in row])
    assert got.to_pylist() == want


def test_one_comparison_for_all_radii(spark, monkeypatch):
    """density_leaves compares its points for neighbours and once more, not once a radius; a
    sweep searches neighbours once for its configurations."""
    from topicloom.operators import density
    searched, met = [], []
    real, meet = density.nearest_points, neighbours._meet
    monkeypatch.setattr(density, "nearest_points", lambda *a: (searched.append(1), real(*a))[1])
    monkeypatch.setattr(neighbours, "_meet", lambda *a: (met.append(1), meet(*a))[1])
    rng = np.random.default_rng(4)
    v = rng.normal(size=(3, 4))[rng.integers(3, size=90)] + 0.05 * rng.normal(size=(90, 4))
    rows = vectors(spark, v)
    found = density.density_leaves(rows, "id", "v", [1.5, 0.8, 0.3, 0.2])
    assert found.where("cluster_id >= 0").select("cluster_id").distinct().count() == 3
    assert (len(searched), len(met)) == (1, 3)
    configs = [{"epsilon": 0.3}, {"epsilon": 0.2, "min_samples": 3, "min_cluster_size": 5}]
    swept = density.sweep(rows, "id", "v", configs)
    assert len(searched) == 2
    for n, c in enumerate(configs):
        alone = density.density_clusters(rows, "id", "v", **c)
        mine = swept.where(f"config = {n}").select("id", "cluster_id")
        assert mine.exceptAll(alone).isEmpty() and alone.exceptAll(mine).isEmpty()


def test_listed_pairs_are_not_moved(spark):
    """Copies go along with the points: the plan has no join of pairs."""
    rows = vectors(spark, np.array([[1.0, 0], [1, 0], [1, 0.1], [1, 0.1], [1, 0.1], [0, 1]]))
    found = neighbours.cosine_pairs(rows, "id", "v", 0.9)
    assert [(r.i, r.j, r.copies_i, r.copies_j) for r in found.collect()] == [(0, 2, 2, 3)]
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Join")


def test_a_vector_goes_once_to_a_part():
    """Meetings and the rows that take part, each sent once, give what whole meetings give."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(40, 3))
    worst = rng.choice([1.0, np.inf], 40)
    meet = [(at, int(k), bool(rng.integers(2))) for at in range(30)
            for k in rng.choice(40, rng.integers(1, 9), replace=False)]
    at, who, new = (list(x) for x in zip(*meet))
    meetings = pa.table({"part": [0] * len(meet), "at": at, "id": who, "new": new})
    used = sorted(set(who), reverse=True)
    rows = pa.table({"id": used, "v": pa.array(v[used].tolist(), pa.list_(pa.float64())),
                     "worst": worst[used]})
    whole = meetings.append_column("v", pa.array(v[who].tolist(), pa.list_(pa.float64())))
    got = descent._in_part("euclidean", 3)(meetings, rows)
    assert got.num_rows and got.equals(descent._at_points("euclidean", 3)(
        whole.append_column("worst", pa.array(worst[who]))))

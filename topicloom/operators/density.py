"""Density clusters: core distances, mutual reachability, flat and leaf cuts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, cut_with
from .forest import (Levels, MergeTree, cuts, leaf_groups, levels, merge_tree,
                     spanning_forest)
from .graph import connected_components
from .neighbours import (BLOCK_ROWS, Points, cosine_limit, distinct_points, linked_points,
                         nearest_points, pairs_in_trees, pairs_within, with_components)
from .ranking import ordinal
from .reduction import reduce_dims

NOISE = -1
# --- Fixed values: they decide results and must stay as they are. -------------
MIN_SAMPLES = 5
MIN_CLUSTER_SIZE = 10
EPSILON = 0.3
# ------------------------------------------------------------------------------


def _core_table(p: Points, every: Sequence[int], block_rows: int) -> DataFrame:
    """(point, k, core): the distance at which a point has seen k rows, itself included, for
    each k of ``every``, from one search for neighbours.

    Copies of a vector count as rows at distance 0, so a point whose copies
    alone suffice has core distance 0.
    """
    itself = p.points.select(F.col("id").alias("i"), F.lit(0.0).alias("measure"),
                             F.col("copies").alias("rows"))
    seen, most = itself, max(every)
    if most > 1:
        near = nearest_points(p, most - 1, block_rows).select("i", "j", "measure")
        counts = p.points.select(F.col("id").alias("j"), F.col("copies").alias("rows"))
        seen = itself.unionByName(near.join(counts, "j").drop("j"))
    # At most max(every) rows per point.
    so_far = F.sum("rows").over(Window.partitionBy("i").orderBy("measure")
                                .rangeBetween(Window.unboundedPreceding, 0))
    reached = F.explode(F.filter(F.array(*[F.lit(k) for k in sorted(set(every))]),
                                 lambda k: k <= F.col("seen")))
    return (seen.withColumn("seen", so_far).select(F.col("i").alias("point"), "measure",
                                                   reached.alias("k"))
            .groupBy("point", "k").agg(F.min("measure").alias("core")))


def _point_cores(p: Points, min_samples: int, block_rows: int) -> DataFrame:
    """(point, core) for one number of rows."""
    return _core_table(p, [min_samples], block_rows).select("point", "core")


def core_distance(df: DataFrame, node: str, vec: str, min_samples: int = MIN_SAMPLES,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, core): Euclidean distance to the ``min_samples``-th row, oneself first."""
    p = distinct_points(df, node, vec, "euclidean")
    cores = _point_cores(p, min_samples, block_rows)
    return (p.members.join(cores, "point")
            .select(F.col("id").alias(node), "core"))


def mutual_reachability(pairs: DataFrame, cores: DataFrame, node: str) -> DataFrame:
    """(i, j, reach) = the largest of the two core distances and the distance."""
    a = cores.select(F.col(node).alias("i"), F.col("core").alias("core_i"))
    b = cores.select(F.col(node).alias("j"), F.col("core").alias("core_j"))
    return (pairs.join(a, "i").join(b, "j")
            .select("i", "j", F.greatest("core_i", "core_j", "distance").alias("reach")))


def euclidean_pairs(df: DataFrame, node: str, vec: str, epsilon: float,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs of distinct vectors no farther apart than ``epsilon``."""
    p = distinct_points(df, node, vec, "euclidean")
    return (pairs_within(p, epsilon, block_rows=block_rows)
            .select("i", "j", F.col("measure").alias("distance")))


def threshold_groups(df: DataFrame, node: str, vec: str, threshold: float,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, component): groups joined by cosine >= ``threshold``, transitively.

    Rows without a partner are their own component.
    """
    p = distinct_points(df, node, vec)
    return spread_components(df, node, p,
                             linked_points(p, cosine_limit(threshold), block_rows))


def spread_components(df: DataFrame, node: str, p: Points,
                      linked: DataFrame | None) -> DataFrame:
    """From components of points to components of all rows."""
    by_row = with_components(p, linked).select(F.col("id").alias(node),
                                               F.col("component").alias("_c"))
    return (df.select(F.col(node).cast("bigint").alias(node)).join(by_row, node, "left")
            .select(node, F.coalesce("_c", node).alias("component")))


def threshold_cuts(df: DataFrame, node: str, vec: str, thresholds: Sequence[float],
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(threshold, node, component): the groups at several thresholds.

    Similarities are computed once, at the lowest threshold. Their lightest forest
    becomes a tree of merges, in which a row looks up its group at every threshold at
    once, so the number of thresholds adds no passes.
    """
    p = distinct_points(df, node, vec)
    near = pairs_within(p, cosine_limit(min(thresholds)), "forest", block_rows)
    tree = merge_tree(spanning_forest(near, weight="measure"))
    limits = {cosine_limit(t): float(t) for t in thresholds}
    found = cuts(tree, p.points.select(F.col("id").alias("node")), list(limits))
    shown = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    by_row = (p.members.join(found.withColumnRenamed("node", "point"), "point")
              .select(F.col("id").alias("_id"), F.element_at(shown, F.col("threshold")).alias("_t"),
                      F.col("component").alias("_c")))
    every = F.explode(F.array(*[F.lit(t) for t in sorted(set(limits.values()))]))
    rows = df.select(F.col(node).cast("bigint").alias(node), every.alias("threshold"))
    return (rows.join(by_row, (F.col(node) == F.col("_id")) & (F.col("threshold") == F.col("_t")),
                      "left").select("threshold", node, F.coalesce("_c", node).alias("component")))


def _dense_groups(p: Points, cores: DataFrame, epsilon: float, block_rows: int) -> DataFrame:
    """(point, component) of the points that are dense at ``epsilon``."""
    dense = cores.where(F.col("core") <= epsilon).select(F.col("point").alias("id"))
    # Points that were packed to search neighbours keep their packs.
    balls, placed, packed = p.packed or (None, None, 0)
    rows = p.points if placed is None else placed
    points, seen = cut_with(rows.join(dense, "id"), "dense", count=F.count(F.lit(1)))
    identity = points.select("id", F.col("id").alias("point"))
    inner = Points(points, identity, p.metric, seen["count"], p.has_copies,
                   None if placed is None else (balls, points, packed))
    return (with_components(inner, linked_points(inner, epsilon, block_rows))
            .withColumnRenamed("id", "point"))


def _sized(p: Points, groups: DataFrame, min_size: int) -> DataFrame:
    """Components that hold at least ``min_size`` rows."""
    rows = p.points.select(F.col("id").alias("point"), "copies")
    return (groups.join(rows, "point").groupBy("component").agg(F.sum("copies").alias("size"))
            .where(F.col("size") >= min_size))


def _labelled(df: DataFrame, node: str, p: Points, groups: DataFrame,
              kept: DataFrame) -> DataFrame:
    """Number the kept components from 0 and give every other row the noise label."""
    numbered = ordinal(kept.select("component"), ["component"], "cluster_id")
    by_point = groups.join(numbered, "component").select("point", "cluster_id")
    by_row = p.members.join(by_point, "point").select(F.col("id").alias("_n"), "cluster_id")
    return (df.select(node).join(by_row, F.col(node) == F.col("_n"), "left")
            .select(node, F.coalesce("cluster_id", F.lit(NOISE)).cast("bigint")
                    .alias("cluster_id")))


def density_clusters(df: DataFrame, node: str, vec: str, epsilon: float = EPSILON,
                     min_samples: int = MIN_SAMPLES, min_cluster_size: int = MIN_CLUSTER_SIZE,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, cluster_id): density clusters at one radius, -1 for noise.

    Dense rows (core distance <= epsilon) that lie within epsilon of each other
    belong together; groups below the minimum size are noise.
    """
    p = distinct_points(df, node, vec, "euclidean")
    cores = _point_cores(p, min_samples, block_rows)
    return _flat_clusters(df, node, p, cores, epsilon, min_cluster_size, block_rows)


def _flat_clusters(df: DataFrame, node: str, p: Points, cores: DataFrame, epsilon: float,
                   min_cluster_size: int, block_rows: int) -> DataFrame:
    groups = cut(_dense_groups(p, cores, epsilon, block_rows), "groups")
    return _labelled(df, node, p, groups, _sized(p, groups, min_cluster_size))


def density_leaves(df: DataFrame, node: str, vec: str, radii: Sequence[float],
                   min_samples: int = MIN_SAMPLES, min_cluster_size: int = MIN_CLUSTER_SIZE,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, cluster_id): the leaves of the density hierarchy over a grid of radii.

    Going from the largest radius down, a cluster is replaced by its parts when
    at least two parts of sufficient size remain at the next radius. A cluster
    that never splits keeps all rows it had when it appeared. The smallest
    radius is the floor below which nothing is split. One tree holds all radii.
    """
    found = density_tree(df, node, vec, max(radii), min_samples, block_rows)
    p = found.points
    groups = cut(_groups_at(found, radii), "groups")
    big = _sized_at(p, groups, min_cluster_size)
    every = cut(groups.join(big.select("radius", "component"), ["radius", "component"]), "kept")
    state = None
    for radius in sorted({float(r) for r in radii}, reverse=True):
        kept = every.where(F.col("radius") == radius).select("point", "component")
        if state is None:
            state = kept.select("point", F.col("component").alias("leaf"))
            continue
        parts = (state.join(kept, "point").groupBy("leaf")
                 .agg(F.count_distinct("component").alias("parts")))
        split = F.coalesce("parts", F.lit(0)) >= 2
        # On a split, points outside every part become noise; else nothing changes.
        state = cut(state.join(kept, "point", "left").join(parts, "leaf", "left")
                    .select("point", F.when(split, F.col("component"))
                            .otherwise(F.col("leaf")).alias("leaf"))
                    .where(F.col("leaf").isNotNull()), "leaves")
    return _labelled(df, node, p,
                     state.select("point", F.col("leaf").alias("component")),
                     state.select(F.col("leaf").alias("component")).distinct())


@dataclass
class DensityTree:
    """The whole density hierarchy of a table's vectors, up to the distance ``largest``."""

    points: Points
    cores: DataFrame  # point, core
    tree: MergeTree
    largest: float


def density_tree(df: DataFrame, node: str, vec: str, largest: float | None = None,
                 min_samples: int = MIN_SAMPLES, block_rows: int = BLOCK_ROWS) -> DensityTree:
    """Merges of the rows by mutual reachability, the largest of two rows' core distances and
    their distance, at all distances up to ``largest`` (all there are, when None).

    Blocks of points give the lightest forests of their own pairs, rounds of joins the forest
    of all, and its rounds the order of all merges. Any radius is a look-up afterwards.
    """
    p = distinct_points(df, node, vec, "euclidean")
    limit = math.inf if largest is None else float(largest)
    cores = cut(_point_cores(p, min_samples, block_rows), "cores")
    near = pairs_within(p, limit, "forest", block_rows, cores)
    return DensityTree(p, cores, merge_tree(spanning_forest(near, weight="measure")), limit)


def _groups_at(found: DensityTree, radii: Sequence[float]) -> DataFrame:
    """(radius, point, component) of the points that are dense at each of the radii."""
    return (cuts(found.tree, found.points.points.select(F.col("id").alias("node")), radii)
            .join(found.cores, F.col("node") == F.col("point"))
            .where(F.col("core") <= F.col("threshold"))
            .select(F.col("threshold").alias("radius"), "point", "component"))


def _sized_at(p: Points, groups: DataFrame, min_size: int) -> DataFrame:
    """Components of each radius that hold at least ``min_size`` rows."""
    rows = p.points.select(F.col("id").alias("point"), "copies")
    return (groups.join(rows, "point").groupBy("radius", "component")
            .agg(F.sum("copies").alias("size")).where(F.col("size") >= min_size))


def clusters_at(found: DensityTree, radii: Sequence[float],
                min_cluster_size: int = MIN_CLUSTER_SIZE) -> DataFrame:
    """(radius, node, cluster_id): what `density_clusters` gives at each of the radii, for all
    of them at once. ``node`` is the row's id; rows without a usable vector have no line."""
    if max(radii) > found.largest:
        raise ValueError("a radius lies beyond the tree")
    p = found.points
    inside = F.array(*[F.lit(float(r)) for r in sorted(set(radii))])
    groups = cut(_groups_at(found, radii), "groups")
    big = _sized_at(p, groups, min_cluster_size)
    numbered = cut(ordinal(big.select("radius", "component"), ["radius", "component"], "place"),
                   "numbered")
    first = numbered.groupBy("radius").agg(F.min("place").alias("first"))
    numbered = numbered.join(first, "radius").select(
        "radius", "component", (F.col("place") - F.col("first")).alias("cluster_id"))
    by_point = groups.join(numbered, ["radius", "component"]).select("radius", "point",
                                                                     "cluster_id")
    return (p.members.withColumn("radius", F.explode(inside))
            .join(by_point, ["radius", "point"], "left")
            .select("radius", F.col("id").alias("node"),
                    F.coalesce("cluster_id", F.lit(NOISE)).cast("bigint").alias("cluster_id")))


def tree_leaves(found: DensityTree, floor: float = EPSILON,
                min_cluster_size: int = MIN_CLUSTER_SIZE) -> DataFrame:
    """(node, cluster_id): the leaves of the density hierarchy, over all distances.

    Going down from the largest distance, a cluster is replaced by its parts where at least two
    of sufficient size come apart, at distances of ``floor`` or more. A cluster that never
    splits keeps all rows it had when it appeared; parts that are too small are noise. When
    the tree has no largest distance, everything together is no cluster, and its first split
    counts also below the floor.
    """
    p = found.points
    rows = p.points.select(F.col("id").alias("point"), F.col("copies").alias("rows"))
    if math.isfinite(found.largest):
        # A point belongs to what is dense at the largest distance.
        rows = rows.join(found.cores.where(F.col("core") <= found.largest).select("point"), "point")
    lv = levels(found.tree, rows)
    groups = cut(leaf_groups(lv, min_cluster_size, floor, math.isfinite(found.largest)), "leaves")
    first = groups.groupBy("group").agg(F.min("point").alias("first"))
    numbered = ordinal(first, ["first"], "cluster_id").select("group", "cluster_id")
    by_point = groups.join(numbered, "group").select("point", "cluster_id")
    return (p.members.join(by_point, "point", "left")
            .select(F.col("id").alias("node"), F.coalesce("cluster_id", F.lit(NOISE)).cast("bigint")
                    .alias("cluster_id")))


def score_configs(labels: DataFrame, config: str, cluster: str) -> DataFrame:
    """Clusters found, discounted by the share of noise, per configuration."""
    n_clusters = F.count_distinct(F.when(F.col(cluster) != NOISE, F.col(cluster)))
    outliers = F.count_if(F.col(cluster) == NOISE)
    share = outliers / F.greatest(F.lit(1), F.count("*"))
    return labels.groupBy(config).agg(
        n_clusters.alias("n_clusters"), outliers.alias("n_outliers"),
        F.round(n_clusters / (1 + share), 6).alias("score"))


def pick_best(scores: DataFrame, config: str) -> DataFrame:
    """The best-scored configuration; the first one wins a tie."""
    return scores.orderBy(F.desc("score"), F.asc(config)).limit(1)


def sweep(df: DataFrame, node: str, vec: str, configs: Sequence[dict],
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(config, node, cluster_id) for a short list of `density_clusters` arguments. Neighbours
    are searched once, for every ``min_samples``."""
    settings = [{"epsilon": EPSILON, "min_samples": MIN_SAMPLES,
                 "min_cluster_size": MIN_CLUSTER_SIZE} | c for c in configs]
    p = distinct_points(df, node, vec, "euclidean")
    cores = cut(_core_table(p, [c["min_samples"] for c in settings], block_rows), "cores")
    runs = []
    for number, c in enumerate(settings):
        mine = cores.where(F.col("k") == c.pop("min_samples")).select("point", "core")
        runs.append(_flat_clusters(df, node, p, mine, block_rows=block_rows, **c)
                    .select(F.lit(number).alias("config"), node, "cluster_id"))
    return cut(reduce(DataFrame.unionByName, runs), "sweep")


def sweep_leaves(df: DataFrame, node: str, vec: str, configs: Sequence[dict],
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(config, node, cluster_id): the leaves of the density hierarchy for each of a short list
    of configurations, numbered from 0.

    A configuration may set ``min_samples``, ``min_cluster_size``, ``floor``, ``largest`` and
    ``components``, the number of principal components that take the place of the vectors.
    Neighbours are searched once for each number of components, at the largest
    ``min_samples``; one comparison of blocks gives the edges for every ``min_samples``, and
    one forest and one merge tree hold all of them side by side.
    """
    runs = []
    for components in {c.get("components") for c in configs}:
        chosen = [(n, c) for n, c in enumerate(configs) if c.get("components") == components]
        rows, used = df.select(node, vec), vec
        if components:
            rows = cut(reduce_dims(rows, vec, components, "_reduced").select(node, "_reduced"),
                       "reduced")
            used = "_reduced"
        runs.append(_sweep_leaves(rows, node, used, chosen, block_rows))
    return cut(reduce(DataFrame.unionByName, runs), "sweep")


def _sweep_leaves(df: DataFrame, node: str, vec: str, chosen: list[tuple[int, dict]],
                  block_rows: int) -> DataFrame:
    settings = [(n, {"min_samples": MIN_SAMPLES, "min_cluster_size": MIN_CLUSTER_SIZE,
                     "floor": EPSILON, "largest": None} | c) for n, c in chosen]
    # A tree for each pair of min_samples and largest distance.
    kinds = sorted({(c["min_samples"], math.inf if c["largest"] is None else float(c["largest"]))
                    for _, c in settings})
    p = distinct_points(df, node, vec, "euclidean")
    cores = cut(_core_table(p, [k for k, _ in kinds], block_rows), "cores")
    numbered = cut(ordinal(p.points, ["id"], "number"), "numbered")
    own = numbered.select(F.col("id").alias("point"), "number", F.col("copies").alias("rows"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.lit(k).alias("k"),
                                        F.lit(far).alias("far")) for n, (k, far) in
                               enumerate(kinds)]))
    member = (own.select("*", each.alias("e")).select("point", "number", "rows", "e.*")
              .join(cores, ["point", "k"]).where(F.col("core") <= F.col("far")))
    # One number for a point in a tree, so that all trees are one graph.
    number = (F.col("number") * len(kinds) + F.col("kind"))
    member = cut(member.select("point", "kind", "rows", "core", number.alias("number")), "members")
    limits = [far for _, far in kinds]
    near = pairs_in_trees(p, member.select("point", "kind", "core"), limits, block_rows)
    names = member.select(F.col("point").alias("i"), "kind", F.col("number").alias("a"))
    edges = (near.join(names, ["i", "kind"])
             .join(names.select(F.col("i").alias("j"), "kind", F.col("a").alias("b")),
                   ["j", "kind"]).select("a", "b", "measure"))
    tree = merge_tree(spanning_forest(edges, "a", "b", "measure"))
    lv = levels(tree, member.select(F.col("number").alias("point"), "rows"))
    runs = []
    for n, c in settings:
        kind = kinds.index((c["min_samples"], math.inf if c["largest"] is None
                            else float(c["largest"])))
        mine = Levels(lv.nodes.where(F.pmod("i", F.lit(len(kinds))) == kind),
                      lv.leaves.where(F.pmod("point", F.lit(len(kinds))) == kind))
        groups = cut(leaf_groups(mine, c["min_cluster_size"], c["floor"],
                                 math.isfinite(kinds[kind][1])), "leaves")
        first = groups.groupBy("group").agg(F.min("point").alias("first"))
        by_point = (groups.join(ordinal(first, ["first"], "cluster_id")
                                               .select("group", "cluster_id"), "group")
                    .select(F.col("point").alias("number"), "cluster_id"))
        found = member.where(F.col("kind") == kind).join(by_point, "number").select(
            "point", "cluster_id")
        runs.append(p.members.join(found, "point", "left").select(
            F.lit(n).alias("config"), F.col("id").alias(node),
            F.coalesce("cluster_id", F.lit(NOISE)).cast("bigint").alias("cluster_id")))
    return reduce(DataFrame.unionByName, runs)

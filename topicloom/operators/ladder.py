"""The merge ladder: similar cluster centroids become one, at falling thresholds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import as_vector
from ..session import cut, cut_with
from .centroids import mean_vectors
from .graph import connected_components
from .labels import merged_names
from .neighbours import (BLOCK_ROWS, Points, cosine_limit, distinct_points, linked_points,
                         pairs_within, with_components)

# --- Fixed values: they decide results and must stay as they are. -------------
TOP_THRESHOLD, LOW_THRESHOLD, THRESHOLD_STEP = 0.95, 0.5, 0.03
# ------------------------------------------------------------------------------

NODES = ["node_id", "name", "leaves", "vec", "configs"]
HISTORY = ("level double, round int, child_id bigint, parent_id bigint, new_name string")


def default_levels() -> list[float]:
    steps = round((TOP_THRESHOLD - LOW_THRESHOLD) / THRESHOLD_STEP)
    return [round(TOP_THRESHOLD - THRESHOLD_STEP * k, 2) for k in range(steps + 1)]


def as_nodes(df: DataFrame, node: str, vec: str, name: str,
             config: str | None = None) -> DataFrame:
    """Bring a centroid table to the columns the ladder works on. ``configs`` lists the
    configurations that a node's leaves come from."""
    configs = F.array(F.col(config)) if config else F.array().cast("array<string>")
    return df.select(F.col(node).cast("bigint").alias("node_id"), F.col(name).alias("name"),
                     F.lit(1).cast("bigint").alias("leaves"), as_vector(F.col(vec)).alias("vec"),
                     configs.alias("configs"))


def _complete(nodes: DataFrame) -> DataFrame:
    """The ladder's columns of a node table, which may lack ``configs``."""
    if "configs" not in nodes.columns:
        nodes = nodes.withColumn("configs", F.array().cast("array<string>"))
    return nodes.select(*NODES)


@dataclass
class Round:
    nodes: DataFrame    # what is left
    history: DataFrame  # child_id, parent_id, new_name


def _merge(nodes: DataFrame, p: Points, linked: DataFrame | None, round_no: int, stride: int,
           weight: str | None, namer: Callable[[DataFrame, str, str], DataFrame]) -> Round:
    """Replace every group of two or more nodes by its mean.

    A new node's number is round * stride + its smallest leaf: unique, larger
    than any before it, and the same however the rows are partitioned.
    """
    groups = with_components(p, linked).withColumnRenamed("id", "node_id")
    parents = (groups.groupBy("component")
               .agg(F.count("*").alias("n"),
                    (F.min(F.pmod("node_id", F.lit(stride))) + round_no * stride)
                    .alias("parent_id"))
               .where("n > 1").select("component", "parent_id"))
    members = cut(groups.join(parents, "component").join(nodes, "node_id")
                  .select("parent_id", *NODES), "members")
    # There are few configurations, however many members.
    leaves = members.select("parent_id", "leaves", F.explode_outer("configs").alias("_c")).groupBy(
        "parent_id").agg(F.array_sort(F.collect_set("_c")).alias("configs")).join(
        members.groupBy("parent_id").agg(F.sum("leaves").alias("leaves")), "parent_id")
    created = cut(mean_vectors(members, ["parent_id"], "vec", weight)
                  .join(leaves, "parent_id").join(namer(members, "parent_id", "name"), "parent_id")
                  .select(F.col("parent_id").alias("node_id"), *NODES[1:]), "merged")
    left = nodes.join(members.select("node_id"), "node_id", "left_anti").select(*NODES)
    named = created.select(F.col("node_id").alias("parent_id"), F.col("name").alias("new_name"))
    history = (members.select(F.col("node_id").alias("child_id"), "parent_id")
               .join(named, "parent_id").select("child_id", "parent_id", "new_name"))
    return Round(cut(left.unionByName(created), "nodes"), history)


def merge_round(nodes: DataFrame, threshold: float, weight: str | None = None,
                namer=merged_names, block_rows: int = BLOCK_ROWS) -> Round:
    """One round at one threshold."""
    nodes = _complete(nodes)
    stride = _stride(nodes)
    p = distinct_points(nodes, "node_id", "vec")
    linked = linked_points(p, cosine_limit(threshold), block_rows)
    return _merge(nodes, p, linked, 1, stride, weight, namer)


def _stride(nodes: DataFrame) -> int:
    low, high = nodes.agg(F.min("node_id"), F.max("node_id")).first()
    if low is not None and low < 0:
        raise ValueError("node ids must not be negative")
    return (high or 0) + 1


@dataclass
class Ladder:
    final: DataFrame    # nodes after the last level
    levels: DataFrame   # level, node_id, name, leaves, vec: nodes after each level with merges
    history: DataFrame  # level, round, child_id, parent_id, new_name
    summary: DataFrame  # level, iteration, n_merges, n_clusters_remaining


def merge_ladder(nodes: DataFrame, levels: Sequence[float] | None = None,
                 weight: str | None = None, namer=merged_names,
                 block_rows: int = BLOCK_ROWS) -> Ladder:
    """Merge to a fixpoint at each level, from the highest threshold down.

    Means move, so a level is repeated until no group forms. Nodes are compared once
    per set of nodes, at the lowest level: a spanning forest there says which groups
    form at any level above, and its best similarity which level is next. Every
    round's tables are written before the next one starts; the driver sees one
    number per round.
    """
    spark: SparkSession = nodes.sparkSession
    every = sorted(set(default_levels() if levels is None else levels), reverse=True)
    levels = every
    nodes = cut(_complete(nodes), "nodes")
    stride = _stride(nodes)
    p = distinct_points(nodes, "node_id", "vec")
    start, round_no = nodes.count(), 0
    history, after_level = [], {}

    while levels:
        forest, seen = cut_with(pairs_within(p, cosine_limit(levels[-1]), "forest", block_rows),
                                "forest", best=F.min("measure"))
        # Copies of a vector merge at once, else the first level that has a pair.
        best = float("-inf") if p.has_copies else seen["best"]
        levels = [t for t in levels if best is not None and cosine_limit(t) >= best]
        if not levels:
            break
        close = forest.where(F.col("measure") <= cosine_limit(levels[0]))
        linked = connected_components(close)
        round_no += 1
        done = _merge(nodes, p, linked, round_no, stride, weight, namer)
        nodes, p = done.nodes, distinct_points(done.nodes, "node_id", "vec")
        history.append(done.history.select(
            F.lit(levels[0]).alias("level"), F.lit(round_no).alias("round"), "child_id",
            "parent_id", "new_name"))
        after_level[levels[0]] = nodes.withColumn("level", F.lit(levels[0]))

    empty = nodes.limit(0).withColumn("level", F.lit(0.0))
    # Every part is a written table, so these unions only read files.
    merges = cut(reduce(DataFrame.unionByName, history), "history") if history else (
        spark.createDataFrame([], HISTORY))
    return Ladder(nodes, reduce(DataFrame.unionByName, after_level.values(), empty), merges,
                  merge_summary(merges, start, every))


def merge_summary(history: DataFrame, start: int, levels: Sequence[float]) -> DataFrame:
    """Per level: merges and clusters left, from the history and the node count
    at the start. At most one row per level."""
    steps = history.groupBy("level").agg(
        F.count_distinct("parent_id").alias("n_merges"), F.count("*").alias("gone"))
    ordered = sorted(set(levels), reverse=True)
    place = F.array_position(F.array(*[F.lit(float(t)) for t in ordered]), F.col("level"))
    # One row per level, so one task is enough for the running sum.
    so_far = F.sum(F.col("gone") - F.col("n_merges")).over(Window.orderBy(F.desc("level")))
    return steps.select("level", (place - 1).cast("int").alias("iteration"), "n_merges",
                        (F.lit(start) - so_far).alias("n_clusters_remaining"))


def lineage(leaves: DataFrame, history: DataFrame, node: str = "node_id") -> DataFrame:
    """(leaf_id, level, round, node_id): every node a leaf passes through.

    A leaf starts as itself, with null level. Steps double: after each pass a node knows the
    node twice as many merges above, and every leaf's known path gets twice as long, so
    the passes are the logarithm of the longest chain of merges.
    """
    parts = [cut(leaves.select(F.col(node).alias("leaf_id"),
                               F.lit(None).cast("double").alias("level"),
                               F.lit(0).alias("round"), F.col(node).alias("node_id")), "lineage")]
    jump = history.select(F.col("child_id").alias("at"), F.col("parent_id").alias("to"),
                          F.col("level").alias("l"), F.col("round").alias("r"))
    while True:
        known = reduce(DataFrame.unionByName, parts)
        longer, seen = cut_with(
            known.join(jump, F.col("node_id") == F.col("at")).select(
                "leaf_id", F.col("l").alias("level"), F.col("r").alias("round"),
                F.col("to").alias("node_id")), "lineage", count=F.count(F.lit(1)))
        if not seen["count"]:
            return known
        parts.append(longer)
        ahead = jump.select(F.col("at").alias("_at"), F.col("to").alias("_to"),
                            F.col("l").alias("_l"), F.col("r").alias("_r"))
        jump = cut(jump.join(ahead, F.col("to") == F.col("_at")).select(
            "at", F.col("_to").alias("to"), F.col("_l").alias("l"), F.col("_r").alias("r")), "jump")


def members_at(lineage_rows: DataFrame, level: float) -> DataFrame:
    """(leaf_id, node_id): where every leaf sits once ``level`` is done."""
    reached = lineage_rows.where(F.col("level").isNull() | (F.col("level") >= level))
    # Node numbers grow with every merge, so the last node is the largest.
    return reached.groupBy("leaf_id").agg(F.max("node_id").alias("node_id"))

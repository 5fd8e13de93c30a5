"""Lightest spanning forests of edge tables, and the tree in which their parts merge.

The forest grows in rounds (Borůvka): every part takes its lightest edge to another
part, and parts that took a common edge become one. Edges are ordered by weight, then
by their ends, so equal weights form no cycle. There are at most log2(nodes) rounds, and
each reads only the edges still between two parts, one for each pair of parts.

What the rounds chose is also enough to say in which order all parts merge, without
going through the edges one by one. An edge inside a part that is lighter than the
part's lightest way out is used while the part is still alone: such edges, sorted, are
the part's own chain of merges. Every edge finds its chain by going up through the parts
that hold it, at most one step a round. The chain's last merge is followed by the edge
that leads out of the part.

So any question about one threshold, or about all of them, becomes a walk up through
parts: no loop over thresholds, and no component search for each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, cut_with
from .ranking import ordinal

RUN = 1 << 16  # nodes summed in one window


def _order(alias: str = "") -> Column:
    return F.struct(*[F.col(f"{alias}{c}") for c in ("weight", "i", "j")])


@dataclass
class Forest:
    """``steps``: round, part, next, weight, i, j. In ``round``, ``part`` left by the edge
    (i, j) and went into ``next``. Parts are named by one of their nodes; in round 0 each
    node with an edge is a part."""

    steps: DataFrame
    rounds: int

    def edges(self) -> DataFrame:
        """(i, j, weight, round, next): the forest's edges, the round that took them and the
        part that then held them."""
        return self.steps.groupBy("i", "j", "weight").agg(F.min("round").alias("round"),
                                                          F.min("next").alias("next"))

    def at(self, round_no: int) -> DataFrame:
        return self.steps.where(F.col("round") == round_no).drop("round")


def _lightest(edges: DataFrame) -> DataFrame:
    """One edge for each pair of parts."""
    return (edges.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .agg(F.min(_order()).alias("e")).select("a", "b", "e.*"))


def spanning_forest(edges: DataFrame, i: str = "i", j: str = "j",
                    weight: str = "weight") -> Forest:
    """The lightest spanning forest of an edge table with bigint ends."""
    low, high = F.least(i, j), F.greatest(i, j)
    live, seen = cut_with(_lightest(
        edges.where(F.col(i) != F.col(j))
        .select(low.alias("a"), high.alias("b"), F.col(weight).cast("double").alias("weight"),
                low.alias("i"), high.alias("j"))), "edges", rows=F.count(F.lit(1)))
    steps = []
    while seen["rows"]:
        ways = live.select(F.col("a").alias("part"), F.col("b").alias("other"), "weight", "i", "j")
        ways = ways.unionByName(live.select(F.col("b").alias("part"), F.col("a").alias("other"),
                                            "weight", "i", "j"))
        picks = cut(ways.groupBy("part").agg(F.min(F.struct(*_order_fields(), "other")).alias("e"))
                    .select("part", "e.*"), "picks")
        # Two parts that took the same edge point at each other: the smaller one is the root.
        back = picks.select(F.col("part").alias("_part"), F.col("other").alias("_other"))
        hooks, moved = cut_with(
            picks.join(back, F.col("other") == F.col("_part")).select(
                "part", F.when((F.col("_other") == F.col("part")) & (F.col("part") < F.col("other")),
                               F.col("part")).otherwise(F.col("other")).alias("next")),
            "hooks", rows=F.count_if(F.col("part") != F.col("next")))
        while moved["rows"]:
            far = hooks.select(F.col("part").alias("_part"), F.col("next").alias("_next"))
            hooks, moved = cut_with(
                hooks.join(far, F.col("next") == F.col("_part"))
                .select("part", F.col("_next").alias("next"),
                        (F.col("_next") != F.col("next")).alias("moved")),
                "hooks", rows=F.count_if("moved"))
            hooks = hooks.drop("moved")
        steps.append(picks.join(hooks, "part").select(
            F.lit(len(steps)).alias("round"), "part", "next", "weight", "i", "j"))
        a = hooks.select(F.col("part").alias("a"), F.col("next").alias("_a"))
        b = hooks.select(F.col("part").alias("b"), F.col("next").alias("_b"))
        live, seen = cut_with(_lightest(
            live.join(a, "a").join(b, "b").where(F.col("_a") != F.col("_b"))
            .select(F.col("_a").alias("a"), F.col("_b").alias("b"), "weight", "i", "j")),
            "edges", rows=F.count(F.lit(1)))
    empty = live.limit(0).select(F.lit(0).alias("round"), F.col("a").alias("part"),
                                 F.col("b").alias("next"), "weight", "i", "j")
    return Forest(cut(reduce(DataFrame.unionByName, steps, empty), "steps"), len(steps))


def _order_fields() -> list[Column]:
    return [F.col(c) for c in ("weight", "i", "j")]


@dataclass
class MergeTree:
    """``merges``: node, level, chain, weight, i, j, parent. One node for each edge of the
    forest: the merge that it makes. Nodes of a chain are numbered without gaps in the order
    of their merges; ``parent`` is the next merge of what this one made, null at the top."""

    forest: Forest
    merges: DataFrame


def merge_tree(forest: Forest) -> MergeTree:
    """The order in which the parts of a forest merge."""
    edges = cut(forest.edges(), "forest")
    placed, pending = [], None
    for level in range(1, forest.rounds + 1):
        held = edges.where(F.col("round") == level - 1).select("i", "j", "weight",
                                                               F.col("next").alias("chain"))
        held = held if pending is None else held.unionByName(pending)
        out = forest.at(level).select(F.col("part").alias("chain"), "next",
                                      _order().alias("way"))
        met = cut(held.join(out, "chain", "left"), "met")
        stays = F.col("way").isNull() | (_order() < F.col("way"))
        placed.append(met.where(stays).select(F.lit(level).alias("level"), "chain", "weight",
                                              "i", "j"))
        pending = met.where(~stays).select("i", "j", "weight", F.col("next").alias("chain"))
    if not placed:
        nothing = edges.select(F.lit(0).cast("bigint").alias("node"), F.lit(1).alias("level"),
                               F.col("next").alias("chain"), "weight", "i", "j",
                               F.lit(0).cast("bigint").alias("parent"))
        return MergeTree(forest, nothing)
    nodes = cut(ordinal(reduce(DataFrame.unionByName, placed),
                        ["level", "chain", "weight", "i", "j"], "node"), "merges")
    following = nodes.select((F.col("node") - 1).alias("node"), "level", "chain",
                             F.col("node").alias("following"))
    # After the last merge of a part's chain comes the edge that leads out of the part.
    out = forest.steps.select(F.col("round").alias("level"), F.col("part").alias("chain"), "i", "j")
    leads = out.join(nodes.select("i", "j", F.col("node").alias("out")), ["i", "j"]).select(
        "level", "chain", "out")
    merges = (nodes.join(following, ["node", "level", "chain"], "left")
              .join(leads, ["level", "chain"], "left")
              .select("node", "level", "chain", "weight", "i", "j",
                      F.coalesce("following", "out").alias("parent")))
    return MergeTree(forest, cut(merges, "merge-tree"))


def cuts(tree: MergeTree, nodes: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, node, component) for each node of ``nodes`` (node) and each threshold: the
    parts joined by edges of at most that weight, named by their smallest node.

    A node goes up through the parts that held it until a part's way out is heavier than the
    threshold; the last merge of that part's chain within the threshold made the component.
    """
    every = F.array(*[F.lit(float(t)) for t in sorted(set(thresholds))])
    asking = nodes.select("node", F.col("node").alias("part"), every.alias("left"))
    found = []
    for level in range(tree.forest.rounds + 1):
        out = tree.forest.at(level).select("part", "next", F.col("weight").alias("way"))
        met = asking.join(out, "part", "left")
        done = F.when(F.col("way").isNull(), F.col("left")).otherwise(
            F.filter("left", lambda t: t < F.col("way")))
        met = cut(met.select("node", "part", "next", done.alias("done"),
                             F.array_except("left", done).alias("left")), "asked")
        found.append(met.select(F.lit(level).alias("level"), F.col("part").alias("chain"), "node",
                                F.explode("done").alias("threshold")))
        asking = met.where(F.size("left") > 0).select("node", F.col("next").alias("part"), "left")
    placed = reduce(DataFrame.unionByName, found)
    tops = (tree.merges.select("level", "chain", "node", F.explode(
        F.filter(every, lambda t: t >= F.col("weight"))).alias("threshold"))
        .groupBy("level", "chain", "threshold").agg(F.max("node").alias("top")))
    placed = cut(placed.join(tops, ["level", "chain", "threshold"], "left"), "placed")
    names = placed.where("top IS NOT NULL").groupBy("top", "threshold").agg(
        F.min("node").alias("first"))
    return placed.join(names, ["top", "threshold"], "left").select(
        "threshold", "node", F.coalesce("first", "node").alias("component"))


@dataclass
class Levels:
    """A merge tree in which merges of one weight that meet are one node.

    ``nodes``: node, weight, size (rows below), parent, i (one of its points). ``leaves``: point,
    rows, parent (null for a point that never merges)."""

    nodes: DataFrame
    leaves: DataFrame


def _sizes(tree: MergeTree, points: DataFrame) -> DataFrame:
    """(node, size): rows below each merge. ``points``: point, rows.

    What joins a part's chain from outside comes by the ways out of smaller parts, whose
    rows are known a round earlier; along the chain they add up. The running sum goes over
    runs of a bounded number of nodes, then over the runs' totals.
    """
    rows = points.select(F.col("point").alias("part"), "rows")
    joins = []
    for level in range(tree.forest.rounds):
        # All rows that an edge brings in come by the round that took it.
        joins.append(cut(rows.join(tree.forest.at(level), "part").groupBy("i", "j")
                         .agg(F.sum("rows").alias("rows")), "rows"))
        rows = (tree.merges.where(F.col("level") == level + 1)
                .join(reduce(DataFrame.unionByName, joins), ["i", "j"])
                .groupBy(F.col("chain").alias("part")).agg(F.sum("rows").alias("rows")))
    joined = reduce(DataFrame.unionByName, joins)
    merges = cut(tree.merges.join(joined, ["i", "j"]).select("node", "level", "chain", "rows")
                 .withColumn("run", F.expr(f"node div {RUN}")), "joined")
    totals = merges.groupBy("run").agg(F.sum("rows").alias("total"))
    # One row for each run, so one task is enough for the running sum.
    before = totals.select("run", (F.sum("total").over(Window.orderBy("run")) - F.col("total"))
                           .alias("before"))
    so_far = F.sum("rows").over(Window.partitionBy("run").orderBy("node"))
    summed = cut(merges.withColumn("so_far", so_far).join(before, "run")
                 .withColumn("so_far", F.col("so_far") + F.col("before")), "summed")
    start = summed.groupBy("level", "chain").agg(
        F.min_by(F.col("so_far") - F.col("rows"), "node").alias("start"))
    return summed.join(start, ["level", "chain"]).select(
        "node", (F.col("so_far") - F.col("start")).alias("size"))


def levels(tree: MergeTree, points: DataFrame) -> Levels:
    """Sizes of all merges of ``points`` (point, rows), equal weights that meet as one node."""
    first = tree.forest.at(0).select(F.col("part").alias("point"), "i", "j")
    if not tree.forest.rounds:
        none = tree.merges.select("node", "weight", F.lit(0).cast("bigint").alias("size"), "parent",
                                  "i")
        return Levels(none, points.select("point", "rows", F.lit(None).cast("bigint")
                                          .alias("parent")))
    nodes = tree.merges.select("node", "weight", "parent", "i").join(_sizes(tree, points), "node")
    nodes = cut(nodes, "sized")
    # A node whose parent has its weight stands for the same level: the topmost of them counts.
    above = nodes.select(F.col("node").alias("parent"), F.col("weight").alias("_w"))
    same, seen = cut_with(
        nodes.join(above, "parent", "left").select(
            "node", F.when(F.col("weight") == F.col("_w"), F.col("parent"))
            .otherwise(F.col("node")).alias("top")),
        "tops", rows=F.count_if(F.col("top") != F.col("node")))
    while seen["rows"]:
        far = same.select(F.col("node").alias("_n"), F.col("top").alias("_top"))
        same, seen = cut_with(same.join(far, F.col("top") == F.col("_n")).select(
            "node", F.col("_top").alias("top"), (F.col("_top") != F.col("top")).alias("moved")),
            "tops", rows=F.count_if("moved"))
        same = same.drop("moved")
    up = same.select(F.col("node").alias("parent"), F.col("top").alias("_parent"))
    tops = same.where("node = top").select("node")
    kept = (nodes.join(tops, "node").join(up, "parent", "left")
            .select("node", "weight", "size", F.col("_parent").alias("parent"), "i"))
    held = (first.join(tree.merges.select("i", "j", F.col("node").alias("parent")), ["i", "j"])
            .join(up, "parent").select("point", F.col("_parent").alias("parent")))
    return Levels(cut(kept, "levels"), cut(points.join(held, "point", "left")
                                           .select("point", "rows", "parent"), "leaves"))


def leaf_groups(lv: Levels, min_size: int, floor: float = 0.0,
                roots_count: bool = True) -> DataFrame:
    """(point, group): the leaves of the tree of groups of at least ``min_size`` rows.

    Going down, a group is replaced by its parts where at least two parts of that size come
    apart, at weights of ``floor`` or more; parts that are smaller are dropped. A group
    that never comes apart keeps all points it had when it appeared. ``group`` is a node,
    or minus one less the point where the group is one point's copies.

    ``roots_count``: whether a tree that never comes apart is a group. If not, its
    heaviest split counts also below the floor.
    """
    big = F.col("size") >= min_size
    point = lv.leaves.select((-F.col("point") - 1).alias("node"), F.col("rows").alias("size"),
                             "parent")
    children = lv.nodes.select("node", "size", "parent").unionByName(point)
    splits = (children.where(big & F.col("parent").isNotNull()).groupBy("parent")
              .agg(F.count("*").alias("parts")).where("parts > 1")
              .select(F.col("parent").alias("node")))
    splits = splits.join(lv.nodes.select("node", "weight"), "node")
    if not roots_count:
        heaviest = splits.agg(F.max("weight")).first()[0]
        floor = min(floor, heaviest if heaviest is not None else floor)
    splits = cut(splits.where(F.col("weight") >= floor).select("node"), "splits")

    # For every node the closest split above it, and the node just below that split.
    marked = splits.select(F.col("node").alias("parent"), F.lit(True).alias("is_split"))
    at = lv.nodes.select("node", "parent").join(marked, "parent", "left").select(
        "node", F.col("parent").alias("to"), F.col("node").alias("below"),
        F.coalesce("is_split", F.lit(False)).alias("found"))
    open_ = ~F.col("found") & F.col("to").isNotNull()
    at, seen = cut_with(at, "above", rows=F.count_if(open_))
    while seen["rows"]:
        far = at.select(F.col("node").alias("_n"), F.col("to").alias("_to"),
                        F.col("below").alias("_below"), F.col("found").alias("_found"))
        hit = F.col("_n").isNotNull()
        at, seen = cut_with(
            at.join(far, open_ & (F.col("to") == F.col("_n")), "left").select(
                "node", F.when(hit, F.col("_to")).otherwise(F.col("to")).alias("to"),
                # Without a split above, the topmost node is the one below nothing.
                F.when(hit, F.col("_below")).otherwise(F.col("below")).alias("below"),
                F.when(hit, F.col("_found")).otherwise(F.col("found")).alias("found")),
            "above", rows=F.count_if(open_))
    counts = F.col("found") | F.lit(roots_count)
    heads = at.select("node", F.when(counts, F.col("below")).alias("head"))
    # A head above a split is no leaf, and neither is one that is too small.
    parted = heads.join(splits, "node").select(F.col("head").alias("group"),
                                               F.lit(True).alias("parted"))
    parted = parted.unionByName(splits.select(F.col("node").alias("group"),
                                              F.lit(True).alias("parted"))).distinct()
    own = (-F.col("point") - 1)
    of_points = (lv.leaves.join(splits.select(F.col("node").alias("parent"),
                                              F.lit(True).alias("is_split")), "parent", "left")
                 .join(heads.withColumnRenamed("node", "parent"), "parent", "left")
                 .select("point", F.when(F.col("is_split"), own).when(
                     F.col("parent").isNull(), F.when(F.lit(roots_count), own))
                     .otherwise(F.col("head")).alias("group")))
    sizes = children.where(big).select(F.col("node").alias("group"))
    return (of_points.where(F.col("group").isNotNull()).join(sizes, "group", "left_semi")
            .join(parted, "group", "left_anti").select("point", "group"))

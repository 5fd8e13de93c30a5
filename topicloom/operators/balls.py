"""A tree of balls over vectors, and the pairs of its blocks that can hold close points.

Points are dealt to the closest of a node's pivots, level by level, until a node has at
most ``block_rows`` of them and is a block. A node's ball has its pivot as centre and
reaches its farthest point. By the triangle inequality no point of one ball is closer to
a point of another than the distance of the centres less both radii, so going down from
the root only the pairs of nodes that could hold a pair within reach are followed.

Levels are tables and steps are joins: the driver sees one count a level. A node that
`PIVOT_LEVELS` levels did not part, because its points are too alike, goes on to be
parted by a hash; its children have its ball.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, cut_with
from .ranking import top_k

FAN = 16           # children of a node
PIVOT_LEVELS = 8   # FAN ** PIVOT_LEVELS blocks
SLACK = 1e-9

_HASH = 1 << 32


@dataclass
class Balls:
    """``rows``: the points with their ``block``. ``nodes``: node, parent, centre, radius, low,
    leaf; the root, 0, is not listed. ``low`` is the least core of a node's points."""

    rows: DataFrame
    nodes: DataFrame | None
    levels: int  # below the root


def _distance(a: str | Column, b: str | Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                              lambda acc, x: acc + x))


def _pivots(rows: DataFrame, sizes: DataFrame, level: int, block_rows: int) -> DataFrame:
    """(node, pivots): up to FAN points of each node, by a hash, fewer where half-full blocks
    need fewer. Only points below a bound that some 8 * FAN of a node's are under compete,
    so no node is sorted whole."""
    wanted = F.greatest(F.lit(2), F.ceil(2 * F.col("size") / block_rows))
    draw = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(_HASH))
    bound = F.lit(float(_HASH)) * (8 * FAN) / F.col("size")
    drawn = (rows.join(sizes.select("node", "size", wanted.alias("wanted")), "node")
             .withColumn("draw", draw).where(F.col("draw") < bound))
    few = top_k(drawn.select("node", "wanted", "draw", "id", "v"), ["node"],
                [F.asc("draw"), F.asc("id")], FAN).where(F.col("rank") <= F.col("wanted"))
    return few.groupBy("node").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "v"))), lambda p: p["v"]).alias("pivots"))


def ball_blocks(points: DataFrame, count: int, block_rows: int, *more: str) -> Balls:
    """Blocks of at most ``block_rows`` of the ``count`` ``points`` (id, v, core, ``more``...)."""
    root = points.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("node"), F.lit(count).cast("bigint").alias("size"))
    open_ = points.select("id", "v", "core", *more, F.lit(0).cast("bigint").alias("node"))
    done, nodes, full, level = [], [], root, 0
    crowded = count > block_rows
    while crowded:
        level += 1
        by_pivot = level <= PIVOT_LEVELS
        if by_pivot:
            pivots = cut(_pivots(open_, full, level, block_rows), "pivots")
            far = F.transform("pivots", lambda p: _distance(p, F.col("v")))
            dealt = open_.join(pivots, "node").withColumn("all", far).withColumns({
                "far": F.array_min("all"),
                "k": F.array_position("all", F.array_min("all")).cast("bigint")})
            balls = pivots.select(F.col("node").alias("parent"), F.posexplode("pivots")).select(
                (F.col("parent") * FAN + F.col("pos") + 1).alias("node"), F.col("col").alias("centre"))
        else:
            dealt = open_.withColumns({
                "far": F.lit(0.0), "k": F.pmod(F.xxhash64("id", F.lit(level)), F.lit(FAN)) + 1})
            balls = full.select("node", "centre", F.col("radius").alias("outer"), F.explode(
                F.sequence(F.lit(1), F.lit(FAN))).alias("k")).select(
                (F.col("node") * FAN + F.col("k")).alias("node"), "centre", "outer")
        dealt = cut(dealt.select("id", "v", "core", *more, F.col("node").alias("parent"),
                                 (F.col("node") * FAN + F.col("k")).alias("node"), "far"), "dealt")
        radius = F.max("far") if by_pivot else F.lit(0.0)
        sized = dealt.groupBy("node").agg(F.first("parent").alias("parent"),
                                          radius.alias("radius"), F.min("core").alias("low"),
                                          F.count("*").alias("size")).join(balls, "node")
        if not by_pivot:
            sized = sized.withColumn("radius", F.col("outer")).drop("outer")
        is_full = F.col("size") > block_rows
        found, seen = cut_with(sized.withColumn("leaf", ~is_full), "balls",
                               full=F.count_if(is_full))
        nodes.append(found)
        full, crowded = found.where(is_full), seen["full"] > 0
        rows = dealt.select("id", "v", "core", *more, "node")
        done.append(rows.join(full.select("node"), "node", "left_anti") if crowded else rows)
        open_ = rows.join(full.select("node"), "node", "left_semi")
    rows = reduce(DataFrame.unionByName, done) if done else open_
    listed = [n.select("node", "parent", "centre", "radius", "low", "leaf") for n in nodes]
    return Balls(rows.withColumnRenamed("node", "block"),
                 reduce(DataFrame.unionByName, listed) if listed else None, level)


def block_pairs(balls: Balls, reach: float) -> DataFrame:
    """(a, b), a <= b: the blocks that may hold points within ``reach`` of each other, or whose
    cores do not exceed it."""
    spark = balls.rows.sparkSession
    pairs = spark.range(1).select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint")
                                  .alias("b"))
    if not balls.levels:
        return pairs
    # A leaf stands for itself on the levels below it.
    kids = balls.nodes.select("parent", "node", "centre", "radius", "low")
    stay = balls.nodes.where("leaf").select(F.col("node").alias("parent"), "node", "centre",
                                            "radius", "low")
    below = cut(kids.unionByName(stay), "below")
    for _ in range(balls.levels):
        a, b = (below.select(F.col("parent").alias(f"p{s}"), F.col("node").alias(f"n{s}"),
                             F.col("centre").alias(f"c{s}"), F.col("radius").alias(f"r{s}"),
                             F.col("low").alias(f"l{s}")) for s in "ab")
        met = pairs.join(a, F.col("a") == F.col("pa")).join(b, F.col("b") == F.col("pb"))
        near = (_distance("ca", "cb") - F.col("ra") - F.col("rb") <= reach + SLACK) | (
            F.col("na") == F.col("nb"))
        met = met.where((F.col("a") != F.col("b")) | (F.col("na") <= F.col("nb")))
        pairs = cut(met.where((F.greatest("la", "lb") <= reach + SLACK) & near)
                    .select(F.col("na").alias("a"), F.col("nb").alias("b")), "block-pairs")
    return pairs


def dealt_to_pairs(balls: Balls, pairs: DataFrame, *together: str) -> DataFrame:
    """(a, b, side, id, v, core...): each row once for every pair of blocks that its own is in.
    side 0 and 1 are the two blocks of a pair, 2 is a block against itself.

    With ``together``, columns of ``pairs`` that name the sets of pairs that one task takes:
    (block, together..., id, v, core...), each row once for every set that its own block is in.
    """
    if together:
        # Written, so that its size is known and the rows need not be sent to meet it.
        held = cut(pairs.select(F.col("a").alias("block"), *together)
                   .union(pairs.select("b", *together)).distinct(), "held")
        return balls.rows.join(held, "block")
    left = pairs.select(F.col("a").alias("block"), "a", "b", F.when(
        F.col("a") == F.col("b"), 2).otherwise(0).cast("tinyint").alias("side"))
    right = pairs.where("a <> b").select(F.col("b").alias("block"), "a", "b",
                                         F.lit(1).cast("tinyint").alias("side"))
    return balls.rows.join(left.unionByName(right), "block").drop("block")

"""Top-k per group, ordinals and exact samples that never sort in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
          rank: str = "rank", salt: Column | None = None, salts: int = 64) -> DataFrame:
    """The first ``k`` rows of every group in a total order, ranked from 1.

    Where ``k`` is large and a group may hold a third of all rows, pass ``salt``:
    each salted part is cut to ``k`` first, then the parts compete. The result is
    the same, the last step sees at most ``salts * k`` rows.
    """
    if salt is not None:
        part = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)))
              .withColumn("_r", F.row_number().over(part))
              .where(F.col("_r") <= k).drop("_salt", "_r"))
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def ordinal(df: DataFrame, order: Sequence[str], out: str, start: int = 0) -> DataFrame:
    """Number the rows in the order of ``order``, from ``start``.

    Range partitions are sorted on their own; a row's place inside its partition
    plus the sizes of the partitions before it is its number. The partitioned rows
    are written once, so both uses see the same partitions.
    """
    placed = cut(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), "ordinal")
    part = F.shiftright("_place", 33)
    placed = placed.withColumn("_part", part)
    # One row per partition, so one task is enough for the running sum.
    before = (placed.groupBy("_part").agg(F.count("*").alias("_n"))
              .select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
                      .alias("_before")))
    local = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(before, "_part")
            .withColumn(out, F.col("_before") + local + start)
            .drop("_part", "_place", "_before"))


def sample_n(df: DataFrame, key: str, n: int | None, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, repeatable for a seed; all rows when there are fewer.

    The order is the MD5 of seed and key, so it does not depend on how the rows are
    partitioned. Only keys below a bound that some more than ``n`` of them are under
    are numbered; the rows follow by key. Rows that repeat with their key are drawn
    together, in the place of the first.
    """
    if n is None:
        return df
    draw = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(key).cast("string")))
    keys = df.select(F.col(key).alias("_key"), draw.alias("_draw")).where(
        F.col(key).isNotNull()).distinct()
    total = keys.count()
    share = (n + 10 * math.sqrt(n) + 20) / max(1, total)
    while True:
        low = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("bigint")
        drawn = cut(ordinal(keys.where(low < math.ceil(min(1.0, share) * (1 << 32))),
                            ["_draw", "_key"], "_place").where(F.col("_place") < n), "sample")
        if share >= 1 or drawn.count() == min(n, total):
            break
        share *= 2
    return df.join(drawn.select("_key"), F.col(key) == F.col("_key"), "left_semi")

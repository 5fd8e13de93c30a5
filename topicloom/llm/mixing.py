"""Mixing sources to target weights, with DataFrame functions only.

A document's size is its number of words. Sources in code point order, null last,
take the weights in turn. Targets share the total of all sizes by weight; a target
stops at ``most`` times its source's size, and the excess is shared again by weight
until none is above. A source repeats its documents at rate target / size: each is
emitted floor(rate) times, and once more when its hash-seeded draw is below the
fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordinal
from ..session import cut
from .sharing import fresh

WORD = r"[^\x20\x09-\x0D]+"
# Eight draws fit one digest, eight hexadecimal digits each.
DRAWS = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """(source, source_size, target) for each source of ``sizes`` (source, size).

    The level of words per unit of weight rises until the sources that are not at
    their limit take all the rest. Each step moves two sums to the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ordinal(totals.withColumn("absent", F.col("source").isNull()),
                     ["absent", "source"], "rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    per = cut(ranked.select("source", "source_size", weight.cast("bigint").alias("weight"),
                            (F.col("source_size") * most).alias("limit")), "sources")
    total, units = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)),
                           F.coalesce(F.sum("weight"), F.lit(0))).first()
    level, last = (total / units if units else 0.0), None
    while True:
        open_ = F.col("limit") > F.col("weight") * F.lit(float(level))
        full, units = per.agg(F.coalesce(F.sum(F.when(~open_, F.col("limit"))), F.lit(0)),
                              F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0))).first()
        if units == 0 or (full, units) == last:
            break
        level, last = (total - full) / units, (full, units)
    return per.select("source", "source_size", F.least(
        F.col("limit").cast("double"), F.col("weight") * F.lit(float(level))).alias("target"))


def draws(key: Column, seed: int) -> list[Column]:
    """Eight numbers in [0, 1) from the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
            for k in range(DRAWS)]


def copies_of(draw: Column, rate: Column, most: int) -> Column:
    whole = F.floor(rate)
    return F.least(whole + F.when(draw < rate - whole, 1).otherwise(0), F.lit(most)).cast("bigint")


def mix_plan(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
             weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: key, source, size, source_size, target, copies.

    Of its eight draws each source uses the one whose total comes nearest to the
    target, the first among equals; a document's draw depends on its key alone, so
    reruns agree and rows that repeat with their key share a draw. A null text has
    size 0, a null source is a source of its own, a null key draws like an empty
    one. A source without words has target 0 and emits nothing. Targets are one row
    per source; the optimizer sees their size and decides how to join them.
    """
    sizes = cut(docs.select(F.col(key).alias("key"), F.col(source).alias("source"),
                            word_count(F.col(text)).alias("size")), "sizes")
    targets = cut(source_targets(sizes.select("source", "size"), weights, most)
                  .withColumnRenamed("source", "of"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = (sizes.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
               .withColumn("rate", rate))
    tried = planned.groupBy("source").agg(F.first("target").alias("target"), *[
        F.sum(F.col("size") * copies_of(d, F.col("rate"), most)).alias(f"taken{k}")
        for k, d in enumerate(draws(F.col("key"), seed))])
    miss = [F.struct(F.abs(F.col(f"taken{k}") - F.col("target")).alias("miss"),
                     F.lit(k).alias("draw")) for k in range(DRAWS)]
    chosen = cut(tried.select(F.col("source").alias("of"), F.least(*miss)["draw"].alias("draw")),
                 "draws")
    return (planned.join(chosen, F.col("source").eqNullSafe(F.col("of")))
            .select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size",
                    "target", copies_of(F.element_at(F.array(*draws(F.col("key"), seed)),
                                                     F.col("draw") + 1), F.col("rate"), most)
                    .alias("copies")))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: int = 42,
        copy: str = "copy") -> DataFrame:
    """The mixed documents: every row as often as it is emitted, numbered from 1 in ``copy``.

    The rate and the draw are properties of the source, so documents meet one row
    per source and their texts stay where they are when that table is small. A column
    that is already called ``copy`` is replaced; other names may clash with nothing.
    """
    plan = mix_plan(docs, key, source, text, weights, most, seed)
    of_key, of_source, times = (fresh(docs, c) for c in ("of_key", "of_source", "times"))
    by_key = plan.select(F.col(key).alias(of_key), F.col(source).alias(of_source),
                         F.col("copies").alias(times)).where(F.col(times) > 0).distinct()
    rows = docs.withColumn(copy, F.lit(0)).join(
        by_key, F.col(key).eqNullSafe(F.col(of_key))
        & F.col(source).eqNullSafe(F.col(of_source)))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).drop(
        of_key, of_source, times)

"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Texts are equal when identical; null counts as the empty text. Of equal texts the
row with the largest key stays; rows without a key rank below all others.

* Locally: copies inside one task collapse before anything is shuffled.
* Salted: what is left of a digest meets in up to ``salts`` groups, one for each
  residue of the task's number, so copies that fill a third of the table never
  meet in one task.
* Globally: the winners of the salts, at most ``salts`` rows a text, are combined.

Digest and full text are grouping keys at every step, so texts that only share a
digest never merge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def content_winners(docs: DataFrame, order: Sequence[str], text: str = "text",
                    digest: Callable[[Column], Column] = sha256, salts: int = 16) -> DataFrame:
    """(digest, content, best, rows) for each distinct text of ``docs``.

    ``best`` is the largest struct of the columns ``order``, ``rows`` the number of
    rows with the text. An empty table gives no rows.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    best = F.struct(*order) if len(order) > 1 else F.col(order[0])
    rows = docs.select(digest(content).alias("digest"), content.alias("content"),
                       best.alias("best"),
                       F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "salt", "content").agg(
        F.max("best").alias("best"), F.count("*").alias("rows"))
    return salted.groupBy("digest", "content").agg(
        F.max("best").alias("best"), F.sum("rows").alias("rows"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256, salts: int = 16) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, digest.

    ``kept`` is true for exactly one row of each text, also when rows repeat with
    the same key. A group without any key keeps one row and has a null keep_id.
    Other columns are not read. Rows meet their winner by digest alone where the
    combining proved that the digest has one text, else by digest and text.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = content_winners(docs, [key], text, digest, salts)
    groups = cut(found.select("digest", F.col("best").alias("keep_id"),
                              F.col("rows").alias("group_size")), "exact")
    clashing = groups.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select(
        "digest")
    members = docs.select(F.col(key).alias("key"), digest(content).alias("digest"),
                          content.alias("content"))
    salt = F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))

    def joined(rows: DataFrame, winners: DataFrame, on: list[str]) -> DataFrame:
        # Rows that repeat with their key are counted, then numbered from 1.
        counted = rows.groupBy("key", *on).agg(F.count("*").alias("times"))
        return (counted.withColumn("salt", salt)
                .join(winners.withColumn("salt", every_salt), [*on, "salt"])
                .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
                .select("key", "keep_id", "group_size",
                        (F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
                        .alias("kept"), "digest"))

    if clashing.isEmpty():
        out = joined(members.select("key", "digest"), groups, ["digest"])
    else:
        out = joined(members, found.select("digest", "content", F.col("best").alias("keep_id"),
                                           F.col("rows").alias("group_size")),
                     ["digest", "content"])
    return out.withColumnRenamed("key", key)


def keep_distinct(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The winning row travels with its text, so nothing is joined afterwards. Among
    rows with equal text and key the largest of the other columns, in their order,
    stays.
    """
    rest = [c for c in docs.columns if c not in (key, text)]
    numbered = docs.select(F.col(text).alias("text"), F.col(key).alias("key"),
                           *[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(rest)],
                           F.col(text).isNotNull().alias("given"))
    found = content_winners(numbered, ["key", *[f"c{n}" for n in range(len(rest))], "given"],
                            "text", salts=salts)
    columns = {key: F.col("best.key"), text: F.when(F.col("best.given"), F.col("content"))}
    columns |= {c: F.col(f"best.c{n}") for n, c in enumerate(rest)}
    return found.select(*[columns[c].alias(c) for c in docs.columns])

"""WARC files, and a Merkle fixity audit of their replicas.

A record's place is its file and the offset of its first byte there. Its leaf hashes
file, offset, length and content. Leaves of one range of offsets form a node, ``FAN``
ranges that lie side by side form a node of the level above, up to the root of the
file; a node hashes its children in the order of their offsets. The audit compares the
roots of two replicas and goes down only where they differ, so files that agree cost
one row each, and damage is located among the leaves of its own range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut

VERSION = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
NO_DATE = "1970-01-01T00:00:00Z"  # of pages that were kept without a date
# Bits of the offset inside the lowest range, and bits that each level adds.
RANGE_BITS, FAN_BITS, LEVELS = 18, 4, 4


def record(url: Column, name: Column, body: Column) -> Column:
    """A resource record without its version line: headers, empty line, body, two line ends.

    Readers cut files at version lines, so a body that holds one is written as base64,
    and a header says so. A null body is empty.
    """
    plain = F.coalesce(body, F.lit(""))
    encoded = plain.contains(VERSION)
    content = F.when(encoded, F.base64(F.encode(plain, "UTF-8"))).otherwise(plain)
    return F.concat(
        F.lit("WARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(name, F.lit("")),
        F.lit(f">\r\nWARC-Date: {NO_DATE}\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", ""),
        F.lit("\r\nContent-Type: text/html\r\n"),
        F.when(encoded, F.lit("Content-Transfer-Encoding: base64\r\n")).otherwise(F.lit("")),
        F.lit("Content-Length: "),
        F.octet_length(content).cast("string"), F.lit("\r\n\r\n"), content, F.lit("\r\n\r\n"))


def records(pages: DataFrame, key: str, url: str, body: str, per_file: int) -> DataFrame:
    """(key, file, length, digest, record): the records in files of ``per_file`` keys.

    A file holds the keys of one interval in their order, rows that repeat by their
    digest; rows without key are dealt by a hash to files of their own, of about as many.
    """
    name = F.col(key).cast("string")
    loose = max(1, -(-pages.where(F.col(key).isNull()).count() // per_file))
    spread = -1 - F.pmod(F.xxhash64(url, body), F.lit(loose))
    rows = pages.select(F.col(key).cast("bigint").alias("key"), F.coalesce(
        F.floor(F.col(key) / per_file), spread).cast("bigint").alias("file"),
        record(F.col(url).cast("string"), name, F.col(body).cast("string")).alias("record"))
    return rows.select("key", "file", (F.octet_length("record") + len(VERSION)).cast("bigint")
                       .alias("length"), F.md5("record").alias("digest"), "record")


def index_of(rows: DataFrame) -> DataFrame:
    """(key, file, offset, length) of `records`; their contents are not moved."""
    before = Window.partitionBy("file").orderBy("key", "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.select("key", "file", "length", "digest").select(
        "key", "file", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length")


def _without_end(held: Column) -> Column:
    return F.when(held.endswith(RECORD_END), held.substr(F.lit(1), F.length(held) - len(RECORD_END))
                  ).otherwise(held)


def write_warc(rows: DataFrame, path: str, replicas: Sequence[Column] | None = None,
               mode: str = "error") -> None:
    """Write `records` as gzip files of whole records, one per replica and ``file``, in order.

    A replica is a column that gives the record it holds, null for none; without any
    there is one, of all records as they are. Replica k goes to ``path``/replica=k. The
    contents are shuffled once for all of them. Every record ends in two line ends, which
    are written as the end of its "line"; a replica's record that lacks them gets them.
    """
    replicas = [F.col("record")] if replicas is None else replicas
    held = F.explode(F.array(*[F.struct(F.lit(k).alias("replica"), r.alias("held"))
                               for k, r in enumerate(replicas)]))
    (rows.repartition("file").select("key", "file", "digest", held.alias("r"))
     .where("r.held IS NOT NULL")
     .sortWithinPartitions("r.replica", "file", "key", "digest")
     .select("r.replica", "file", F.concat(F.lit(VERSION), _without_end(F.col("r.held")))
             .alias("value"))
     .write.mode(mode).option("lineSep", RECORD_END).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").partitionBy("replica", "file").text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, seat, name, url, length, announced, record) per record found below ``path``.

    ``record`` is what stands after the version line; ``seat`` grows with its place in the
    file, which one task reads from start to end. ``announced`` is the length of the body
    that its headers state, which a cut or overwritten record does not keep.
    """
    rows = spark.read.option("lineSep", VERSION).schema("value string, file bigint").text(path)
    rows = rows.select("file", F.monotonically_increasing_id().alias("seat"),
                       F.col("value").alias("record")).where("record <> ''")
    head = F.substring_index("record", "\r\n\r\n", 1)
    return rows.select(
        "file", "seat",
        F.regexp_extract(head, r"WARC-Record-ID: <urn:page:([^>]*)>", 1).alias("name"),
        F.regexp_extract(head, r"WARC-Target-URI: ([^\r\n]*)", 1).alias("url"),
        (F.octet_length("record") + len(VERSION)).cast("bigint").alias("length"),
        F.regexp_extract(head, r"Content-Length: (\d+)", 1).try_cast("bigint").alias("announced"),
        "record")


def leaves(rows: DataFrame) -> DataFrame:
    """(file, offset, length, hash) for ``rows`` (file, offset, length, digest of the record).

    Several records at one place, which no intact replica has, are one leaf.
    """
    by_place = rows.groupBy("file", "offset").agg(
        F.max("length").alias("length"),
        F.concat_ws(":", F.sort_array(F.collect_list("digest"))).alias("content"))
    return by_place.select("file", "offset", "length", F.sha2(F.concat_ws(
        "|", "file", "offset", "length", "content"), 256).alias("hash"))


def tree(leaf: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The levels of the trees over ``leaf``, roots first: (file, node, hash, n).

    The ranges of a level are 16 times as long as those below it; the root covers all
    of its file. A node gathers at most the leaves of one range or 16 nodes, the root
    those of the last level.
    """
    at, built = leaf.select("file", "offset", F.col("hash"), F.lit(1).alias("n")), []
    for k in range(levels + 1):
        bits = RANGE_BITS + FAN_BITS * k
        node = F.lit(0).cast("bigint") if k == levels else F.shiftright("offset", bits)
        up = at.groupBy("file", node.alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("offset", "hash"))).alias("children"),
            F.sum("n").alias("n"))
        up = cut(up.select("file", "node", F.sha2(F.concat_ws(
            "|", F.col("children.hash")), 256).alias("hash"), "n"), "merkle")
        built.insert(0, up)
        at = up.select("file", F.shiftleft("node", bits).alias("offset") if k < levels
                       else F.col("node").alias("offset"), "hash", "n")
    return built


def audit(left: DataFrame, right: DataFrame, levels: int = LEVELS,
          trees: Sequence[list[DataFrame]] | None = None) -> DataFrame:
    """(file, offset, status) of every leaf in which the replicas differ.

    ``left`` and ``right`` are leaves; status is changed, missing (not in ``right``) or
    extra (only in ``right``). Equal replicas, empty ones too, give no rows.
    """
    a, b = trees or (tree(left, levels), tree(right, levels))

    def differing(x: DataFrame, y: DataFrame, on: list[str]) -> DataFrame:
        both = x.select(*on, F.col("hash").alias("l")).join(
            y.select(*on, F.col("hash").alias("r")), on, "full_outer")
        return both.where(~F.col("l").eqNullSafe(F.col("r")))

    suspects = differing(a[0], b[0], ["file", "node"]).select("file", "node")
    for k, (x, y) in enumerate(zip(a[1:], b[1:]), 1):
        parent = F.lit(0).cast("bigint") if k == 1 else F.shiftright("node", FAN_BITS)
        above = cut(suspects.withColumnRenamed("node", "parent"), "suspects")
        below = [t.withColumn("parent", parent).join(above, ["file", "parent"], "left_semi")
                 for t in (x, y)]
        suspects = differing(*below, ["file", "node"]).select("file", "node")
    above = cut(suspects, "suspects")
    found = [t.withColumn("node", F.shiftright("offset", RANGE_BITS)).join(
        above, ["file", "node"], "left_semi") for t in (left, right)]
    return differing(*found, ["file", "offset"]).select("file", "offset", F.when(
        F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra").otherwise("changed")
        .alias("status"))


def fixity(index: DataFrame, replica: DataFrame, against: DataFrame) -> DataFrame:
    """(key, file, offset, length, status) per record of ``index`` (key, file, offset, length).

    Both replicas are as `read_warc` gives them. Their records are digested where they
    are read and find their offsets by file and name in the index, repeats of one name in
    the order in which they stand. A record that stands elsewhere among the file's records
    than the index says is changed, also if its content is not. A record that the index
    does not know is placed after all offsets and reported as extra or missing with a null
    key. Status is ok, changed, missing or extra.
    """
    numbered = Window.partitionBy("file", "name").orderBy("offset")
    places = cut(index.select("key", "file", "offset", F.col("length").alias("stated"), F.coalesce(
        F.col("key").cast("string"), F.lit("")).alias("name")).withColumn(
        "time", F.row_number().over(numbered)), "index")

    def at_place(rows: DataFrame) -> DataFrame:
        digested = rows.select("file", "seat", "name", "length", F.sha2(
            F.concat(F.lit(VERSION), "record"), 256).alias("digest"))
        times = digested.withColumn("time", F.row_number().over(
            Window.partitionBy("file", "name").orderBy("seat")))
        # Places among the records that are there, so that a missing one moves no other.
        joined = times.join(places, ["file", "name", "time"], "left").withColumns({
            "stands": F.row_number().over(Window.partitionBy("file").orderBy(
                F.col("offset").isNull(), "seat")),
            "belongs": F.row_number().over(Window.partitionBy("file").orderBy(
                F.col("offset").isNull(), "offset"))})
        moved = F.col("offset").isNotNull() & (F.col("stands") != F.col("belongs"))
        far = F.lit(1 << 42) + F.pmod(F.xxhash64("digest"), F.lit(1 << 40))
        return cut(leaves(joined.withColumns({
            "offset": F.coalesce("offset", far),
            "digest": F.when(moved, F.concat("digest", F.lit("@"), "stands"))
            .otherwise(F.col("digest"))})), "leaves")

    left, right = at_place(replica), at_place(against)
    found = cut(audit(left, right), "audit")
    return (places.select("key", "file", "offset", F.col("stated").alias("length"))
            .join(found, ["file", "offset"], "full_outer")
            .select("key", "file", "offset", "length",
                    F.coalesce("status", F.lit("ok")).alias("status")))

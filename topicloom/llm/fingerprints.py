"""Fingerprints of whole texts: a digest of quartiles, compared by a bounded score.

The byte triplets of a text are hashed to `BUCKETS` buckets and counted. Each bucket
becomes two bits: above how many of the three quartiles of all its text's counts it
lies. One more byte holds the logarithm of the length. So the digest has one size for
every text, equal texts have equal digests, and an edit moves only the buckets of the
triplets it touches.

The score of two digests is 1 for equal ones and falls with the summed difference of
buckets and lengths; digests that differ as much as random ones have 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut

BUCKETS = 1024
# Two random digests differ by 1.25 a bucket; the length counts as so many buckets.
RANDOM, LENGTH_BUCKETS = 1.25, 8
_SHIFTS = np.array([6, 4, 2, 0], np.uint8)


def _buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of every byte triplet; one or two bytes are padded to one triplet."""
    if 0 < len(data) < 3:
        data = np.append(data, np.zeros(3 - len(data), np.uint8))
    b = data.astype(np.uint32)
    x = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    x ^= x >> np.uint32(13)
    return x & np.uint32(BUCKETS - 1)


def digest(data: bytes) -> bytes:
    """The length byte and BUCKETS / 4 bytes of quartile codes of a text in UTF-8."""
    raw = np.frombuffer(data, np.uint8)
    counts = np.bincount(_buckets(raw), minlength=BUCKETS) if len(raw) else np.zeros(BUCKETS, int)
    quarter = BUCKETS // 4
    q = np.sort(counts)[[quarter, 2 * quarter, 3 * quarter]]
    codes = ((counts > q[0]).astype(np.uint8) + (counts > q[1]) + (counts > q[2]))
    packed = (codes.reshape(-1, 4) << _SHIFTS).sum(1).astype(np.uint8)
    return bytes([int(4 * np.log2(len(raw) + 1.0))]) + packed.tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests down to 0 for those that differ like random ones."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    apart = LENGTH_BUCKETS * abs(int(x[0]) - int(y[0])) / 4
    for shift in _SHIFTS:
        left, right = (x[1:] >> shift) & 3, (y[1:] >> shift) & 3
        apart += int(np.maximum(left, right).sum(dtype=np.int64)
                     - np.minimum(left, right).sum(dtype=np.int64))
    return max(0.0, 1.0 - apart / (RANDOM * BUCKETS))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) for each row of ``docs``, in lowercase hex; null text is empty.

    Nothing is shuffled. Rows that repeat repeat in the result, an empty table gives no
    rows, other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
                       .alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [digest(t.as_py()).hex() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())],
                                             ["key", "fingerprint"])
    schema = rows.select("key").schema.add("fingerprint", "string")
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _heads(data: bytes) -> np.ndarray:
    """Byte offsets of the code points of a UTF-8 text."""
    return np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)


def edited(data: bytes, other: bytes, share: int = 3) -> tuple[int, bytes]:
    """Code points of ``data``, and ``data`` with its last 1/share of them replaced by the
    first as many of ``other``, or all when there are fewer."""
    mine, theirs = _heads(data), _heads(other)
    n = len(mine)
    gone = n // share
    kept = data[:mine[n - gone]] if gone else data
    return n, kept + (other[:theirs[gone]] if gone < len(theirs) else other)


def _judged(key, data: bytes, own: bytes, other: bytes, theirs: bytes) -> tuple:
    n, changed = edited(data, other)
    print_ = digest(changed)
    return (key, n, hashlib.sha256(changed).hexdigest(), own, print_,
            likeness(own, print_), likeness(own, theirs))


_FOUND = ("n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double")
_TYPES = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
          "near_next"]


def _batch(found: list[tuple], key_type, more: dict) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [()] * 7
    arrays = [pa.array(columns[0], key_type),
              *[pa.array(c, t) for c, t in zip(columns[1:], _TYPES)]]
    return pa.RecordBatch.from_arrays([*arrays, *more.values()], ["key", *_NAMES, *more])


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint against that of its edited text and that of the next row.

    Rows stand in descending order of ``key``, null keys last; rows with one key follow in
    the order of a hash of their text. The row after the last is the first. The edited
    text is the row's own with its last third replaced by the head of the next row's.

    Returns (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) per row. Null text is empty, a single row is its own next one, an empty
    table gives no rows, other columns are not read.

    Texts move once, to range partitions of that order, however often a key repeats. Each
    task walks its rows in order and leaves open only its last one; first and last rows of
    the partitions, two a task, then meet in a join.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    order = [F.desc_nulls_last("key"), F.asc("tie"), F.asc("place")]
    rows = (docs.select(F.col(key).alias("key"), F.xxhash64(content).alias("tie"),
                        F.monotonically_increasing_id().alias("place"),
                        content.cast("binary").alias("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None

        def edge(k, data: bytes, which: int, key_type) -> pa.RecordBatch:
            return _batch([(k, None, None, None, None, None, None)], key_type, {
                "part": pa.array([part], pa.int32()), "edge": pa.array([which], pa.int8()),
                "text": pa.array([data], pa.binary())})
        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            found = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = t.as_py()
                own = digest(data)
                if last is None:
                    yield edge(k, data, 1, key_type)
                else:
                    found.append(_judged(*last, data, own))
                last = (k, data, own)
            n = len(found)
            yield _batch(found, key_type, {
                "part": pa.array([part] * n, pa.int32()), "edge": pa.array([0] * n, pa.int8()),
                "text": pa.nulls(n, pa.binary())})
        if last is not None:
            yield edge(last[0], last[1], 2, key_type)

    key_field = rows.schema["key"]
    found_fields = StructType.fromDDL(_FOUND).fields
    edge_fields = StructType.fromDDL("part int, edge tinyint, text binary").fields
    schema = StructType([key_field, *found_fields, *edge_fields])
    walked = cut(rows.mapInArrow(walk, schema), "walked")

    # One row a task here: the first row of the next task that has rows, or of the first.
    firsts = walked.where("edge = 1").select("part", F.col("text").alias("next"))
    parts = firsts.select(
        "part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                           F.min("part").over(Window.orderBy("part"))).alias("after"))
    met = (walked.where("edge = 2").select("key", "text", "part").join(parts, "part")
           .join(firsts.withColumnRenamed("part", "after"), "after").select("key", "text", "next"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k, t, other in zip(*(c.to_pylist() for c in batch.columns)):
                found.append(_judged(k, t, digest(t), other, digest(other)))
            yield _batch(found, batch.schema.field(0).type, {})
    closed = met.mapInArrow(close, StructType([key_field, *found_fields]))
    done = walked.where("edge = 0").select("key", *_NAMES).unionByName(closed)
    return done.select(F.col("key").alias(key), *[
        F.lower(F.hex(c)).alias(c) if c.endswith("fingerprint") else F.col(c) for c in _NAMES])


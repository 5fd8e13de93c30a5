"""Removing repeated passages, found through super-k-mers of words.

A window is ``window`` consecutive words of one document. Its minimiser is the
smallest number among its runs of ``gram`` words. Consecutive windows that share a
minimiser form a super-k-mer: one stretch of text that holds them all.

1. Every document lists its super-k-mers as (minimiser, start, windows), without text.
   A minimiser that only one document has cannot belong to a repeated window.
2. The super-k-mers of the other minimisers travel as packed strings, their words
   joined by single spaces. Equal strings of one minimiser collapse to the smallest
   document before they are shuffled.
3. The buckets of a partition are read in order. The distinct strings of whole buckets
   are cut into windows, which are sorted by 128 bits of digest; equal neighbours give
   the smallest document of each window. A bucket with more than ``CROWD`` distinct
   strings is not gathered: its windows travel singly, and an ordinary aggregate counts
   them.
4. A document loses the words of every window that a smaller document also has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .sharing import if_small
from .words import grams, words_of

WINDOW, GRAM = 50, 10
# Distinct strings of a minimiser that one task compares.
CROWD = 2_000


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, by doubling."""
    span, low = 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def super_kmers(numbers: np.ndarray, window: int, gram: int):
    """(minimiser, first window, windows) of the runs of windows of one document.

    ``numbers`` are its gram numbers. Windows of one run share the minimiser's value,
    so equal windows have equal minimisers wherever they stand.
    """
    low = _sliding_min(numbers, window - gram + 1)
    start = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    # A string of at most two windows' length keeps buckets even on repeated words.
    pieces = []
    for a, b in zip(start, np.append(start[1:], len(low))):
        pieces.extend((a + k, min(window, b - a - k)) for k in range(0, b - a, window))
    at = np.array([p[0] for p in pieces])
    return low[at], at, np.array([p[1] for p in pieces])


def named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text, tag); texts of one key are told apart by their tag."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("bigint").alias("doc"),
                       content.cast("binary").alias("text"), F.xxhash64(content).alias("tag"))


def listed(docs: DataFrame, key: str, text: str, window: int, gram: int) -> DataFrame:
    """(doc, n_words, sha, kmers) per row: all its super-k-mers, and the digest of its words."""
    kind = "array<struct<mini:bigint,start:int,windows:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, sha, mini, start, windows, ends = [], [], [], [], [], [0]
            for block in words_of(batch.column(1)):
                numbers = grams(block.hashes, gram)
                raw = block.data.tobytes()
                for a, b in zip(block.first[:-1], block.first[1:]):
                    own = raw[block.starts[a]: block.ends[b - 1]] if b > a else b""
                    count.append(int(b - a))
                    sha.append(hashlib.sha256(b" ".join(own.split())).hexdigest())
                    if b - a >= window:
                        m, s, w = super_kmers(numbers[a: b - gram + 1], window, gram)
                        mini.append(m.view(np.int64))
                        start.append(s)
                        windows.append(w)
                    ends.append(ends[-1] + (len(mini[-1]) if b - a >= window else 0))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64)
                    for x in (mini, start, windows)]
            items = pa.StructArray.from_arrays(
                [pa.array(flat[0], pa.int64()), pa.array(flat[1].astype(np.int32)),
                 pa.array(flat[2].astype(np.int32))], ["mini", "start", "windows"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(count, pa.int64()), pa.array(sha),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)],
                ["doc", "tag", "n_words", "sha", "kmers"])
    return named(docs, key, text).mapInArrow(
        run, f"doc bigint, tag bigint, n_words bigint, sha string, kmers {kind}")


def packed(docs: DataFrame, wanted: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """(mini, doc, tag, start, windows, packed, id) for the wanted super-k-mers.

    ``wanted`` has (doc, tag, kmers array<struct<mini, start, windows>>).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                kmers, own = part.column(3), pa.array(np.repeat(
                    np.arange(part.num_rows), part.column(3).value_lengths().to_numpy()))
                flat = kmers.flatten()
                start, count = (flat.field(k).to_numpy() for k in ("start", "windows"))
                words = [t.as_py().split() for t in part.column(2)]
                text_ = [b" ".join(words[n][a: a + w + window - 1]) for n, a, w in zip(
                    own.to_pylist(), start.tolist(), count.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [flat.field("mini"), part.column(0).take(own), part.column(1).take(own),
                     flat.field("start"), flat.field("windows"), pa.array(text_, pa.binary()),
                     pa.array([hashlib.md5(t).digest() for t in text_], pa.binary())],
                    ["mini", "doc", "tag", "start", "windows", "packed", "id"])
    return named(docs, key, text).join(wanted, ["doc", "tag"]).select(
        "doc", "tag", "text", "kmers").mapInArrow(
        run, "mini bigint, doc bigint, tag bigint, start int, windows int, packed binary, "
             "id binary")


def _digests(column: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit numbers of every window of every string, each from the bytes of its words
    under keys of its own, and windows per string."""
    one, two, count = [], [], []
    for block in words_of(column):
        for numbers, out in ((block.hashes, one), (block.others(), two)):
            whole = grams(numbers, window)
            out.extend(whole[a: b - window + 1] for a, b in zip(block.first[:-1], block.first[1:]))
        count.append(block.counts() - window + 1)
    return np.concatenate(one), np.concatenate(two), np.concatenate(count)


def _count(rows: pa.Table, window: int) -> pa.RecordBatch:
    """(mini, id, firsts) for the strings of whole buckets: their windows are sorted, and of
    equal ones the smallest document is taken. One number stands for equal numbers."""
    one, two, count = _digests(rows["packed"].combine_chunks(), window)
    own = rows["first"].to_numpy()
    first = np.repeat(own, count)
    order = np.lexsort((two, one))
    new = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))
    low = np.empty_like(first)
    low[order] = np.minimum.reduceat(first[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    # A string whose windows are all its own document's needs one number.
    at = np.append(0, np.cumsum(count))
    plain = np.minimum.reduceat(low, at[:-1]) == own
    keep = ~np.repeat(plain, count)
    keep[at[:-1]] = True
    ends = np.append(0, np.cumsum(np.where(plain, 1, count))).astype(np.int32)
    firsts = pa.ListArray.from_arrays(pa.array(ends), pa.array(low[keep]))
    return pa.RecordBatch.from_arrays([rows["mini"].combine_chunks(), rows["id"].combine_chunks(),
                                       firsts], ["mini", "id", "firsts"])


def repeated_windows(strings: DataFrame, window: int) -> DataFrame:
    """(mini, id, firsts) for ``strings`` (mini, id, doc, packed): of each distinct string, named
    by the digest ``id``, the smallest document of each of its windows, or one number when
    that is the same for all."""
    distinct = cut(strings.groupBy("mini", "id", "packed").agg(F.min("doc").alias("first")),
                   "strings")
    many = cut(distinct.groupBy("mini").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
               .select("mini"), "crowded")

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the strings of the last bucket, which may go on
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            mini = rows["mini"].to_numpy()
            last = int(np.searchsorted(mini, mini[-1]))
            held = rows.slice(last)
            if last:
                yield _count(rows.slice(0, last), window)
        if held is not None:
            yield _count(held, window)
    few = distinct.join(if_small(many, 8), "mini", "left_anti").repartition(
        "mini").sortWithinPartitions("mini").select("mini", "id", "first", "packed")
    by_sort = few.mapInArrow(in_order, "mini bigint, id binary, firsts array<bigint>")
    if many.isEmpty():
        return by_sort

    def singly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two, count = _digests(batch.column(3), window)
            row = np.repeat(np.arange(batch.num_rows), count)
            place = np.arange(len(row)) - np.repeat(np.append(0, np.cumsum(count)[:-1]), count)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 batch.column(2).take(take), pa.array(place.astype(np.int32)),
                 pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                ["mini", "id", "first", "k", "one", "two"])
    crowd = distinct.join(if_small(many, 8), "mini", "left_semi")
    windows = cut(crowd.select("mini", "id", "first", "packed").mapInArrow(
        singly, "mini bigint, id binary, first bigint, k int, one bigint, two bigint"), "windows")
    low = windows.groupBy("one", "two").agg(F.min("first").alias("low"))
    by_key = windows.join(low, ["one", "two"]).groupBy("mini", "id").agg(
        F.sort_array(F.collect_list(F.struct("k", "low"))).alias("all")).select(
        "mini", "id", F.col("all.low").alias("firsts"))
    return by_sort.unionByName(by_key)


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                 gram: int = GRAM) -> DataFrame:
    """(key, n_words, n_removed, kept_text, kept_sha256) per row of ``docs``.

    Words are runs other than space and \\x09-\\x0D, unchanged; null has none. A word goes
    when a window over it also starts in a document with a smaller key, judged on the
    input. ``kept_text`` is null where nothing went; the digest is of the kept words
    joined by one space. Rows that repeat with their key count as one document and
    each give a row. A row without key is compared with nothing. Extra columns are not
    read.
    """
    rows = cut(listed(docs, key, text, window, gram), "listed")
    flat = rows.where("doc IS NOT NULL").select("doc", "tag", F.inline("kmers"))
    shared = cut(flat.groupBy("mini").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
                 .where("low < high").select("mini"), "shared")
    wanted = flat.join(shared, "mini").groupBy("doc", "tag").agg(
        F.collect_set(F.struct("mini", "start", "windows")).alias("kmers"))
    strings = cut(packed(docs, wanted, key, text, window), "packed")
    firsts = repeated_windows(strings, window)
    placed = strings.select("mini", "doc", "start", "windows", "id", "tag")
    spans = F.filter(F.transform(F.sequence(F.lit(0), F.col("windows") - 1), lambda k: F.when(
        F.try_element_at("firsts", F.least(k + 1, F.size("firsts"))) < F.col("doc"),
        F.col("start") + k)), lambda s: s.isNotNull())
    hits = cut(placed.join(firsts, ["mini", "id"]).select("doc", "tag", spans.alias("spans")).where(F.size("spans") > 0).groupBy("doc", "tag").agg(F.array_distinct(F.flatten(F.collect_list("spans")))
                                   .alias("starts")), "hits")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_, starts in zip(batch.column(1), batch.column(2).to_pylist()):
                words = text_.as_py().split()
                gone = np.zeros(len(words) + 1, np.int64)
                at = np.array(starts, np.int64)
                np.add.at(gone, at[at < len(words)], 1)
                np.add.at(gone, np.minimum(at + window, len(words)), -1)
                stays = np.cumsum(gone)[:-1] == 0
                kept = b" ".join(w for w, s in zip(words, stays) if s)
                out.append((len(words), int((~stays).sum()), kept.decode("utf-8", "replace"),
                            hashlib.sha256(kept).hexdigest()))
            n, gone, kept, sha = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(sha, pa.string())],
                ["doc", "n_words", "n_removed", "kept_text", "kept_sha256"])
    schema = "doc bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string"
    changed = named(docs, key, text).join(hits, ["doc", "tag"]).select(
        "doc", "text", "starts").mapInArrow(remove, schema)
    same = rows.join(hits.select("doc", "tag"), ["doc", "tag"], "left_anti").select(
        "doc", "n_words", F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(None).cast("string").alias("kept_text"), F.col("sha").alias("kept_sha256"))
    return changed.unionByName(same).withColumnRenamed("doc", key)

"""Compressing vectors to short codes: one codebook entry a part, by member-resident Lloyd.

A vector is cut into equal parts; each part position has its own codebook. A part lives
with the owner of its entry, (position, entry, salt), in the table written when it got
there, and is not written again while it stays. In each round

* every task compares the parts that live in its files with the new codebooks. It adds
  up those that stay, one row per owner, and passes on only those whose entry changed;
* both go to the owners by one shuffle and are written: the round's table;
* the owners' sums in that table give the next codebooks, `entries` rows a position,
  which are all that the driver sees.

Whether a part has left the table it was written to follows from the codebooks since
then, so nothing is rewritten or marked, and a lost executor costs a re-read of files.
Salts split an entry that holds many parts; their number grows with the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.matrices import as_matrix
from ..session import cut, cut_with

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
OWNER_ROWS = 1 << 20   # parts an owner takes, about
LEAST_SALTS = 16
LIMIT = 1 << 26        # components below it keep squared distances within 64 bits
BLOCK = 4096           # vectors compared at a time

# Null row: the sum of ``weight`` parts that stayed with this owner.
_PARTS = ("row bigint, pos int, entry int, salt int, weight bigint, part array<bigint>")


@dataclass
class Codebooks:
    """``entries[pos]`` is a matrix of integers, one row an entry."""

    entries: list[np.ndarray]

    def sha256(self) -> str:
        """Of all components in decimal, by position, entry and place, comma-joined."""
        numbers = ",".join(str(x) for book in self.entries for x in book.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def _nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part, the lowest of equal ones, and the squared distance."""
    entry, far = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for low in range(0, len(parts), BLOCK):
        block = slice(low, low + BLOCK)
        d = ((parts[block, None, :] - book[None, :, :]) ** 2).sum(2)
        entry[block] = d.argmin(1)
        far[block] = d[np.arange(len(d)), entry[block]]
    return entry, far


def _list_array(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(matrix.ravel(), pa.int64()))


def _kept(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of usable vectors, and their components as integers."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    good = lengths > 0
    flat = column.flatten()
    bad = np.asarray(flat.is_null()) | ~np.isfinite(
        flat.fill_null(0.0).to_numpy(zero_copy_only=False))
    owner = np.repeat(np.arange(len(column)), lengths)
    good[owner[bad]] = False
    rows = np.flatnonzero(good)
    if not len(rows):
        return rows, np.zeros((0, 0), np.int64)
    values = as_matrix(column.take(pa.array(rows)))
    whole = np.floor(values * scale)
    if np.abs(whole).max(initial=0) >= LIMIT:
        raise ValueError(f"components of {LIMIT / scale:g} or more are too large to compare")
    return rows, whole.astype(np.int64)


def _vectors(df: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"),
                     F.col(vec).cast("array<double>").alias("v"))


def _whole(df: DataFrame, scale: int) -> DataFrame:
    """(key, whole): usable vectors as integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole = _kept(batch.column(1), scale)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), _list_array(whole)], ["key", "whole"])
    return df.select("key", "v").mapInArrow(run, "key bigint, whole array<bigint>")


def _first_books(df: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """The parts of the ``entries`` smallest keys, so many rows on the driver."""
    first = (_whole(df, scale).orderBy(F.asc_nulls_last("key"), "whole").limit(entries)
             .select("whole").collect())
    if not first:
        return None
    lengths = {len(r.whole) for r in first}
    if len(lengths) > 1 or min(lengths) % parts:
        raise ValueError(f"vectors need one length, a multiple of {parts}")
    whole = np.array([r.whole for r in first], np.int64)
    return Codebooks(np.split(whole, parts, axis=1))


def _placed(df: DataFrame, books: Codebooks, scale: int, label_type: str) -> DataFrame:
    """Every part at its first owner. Key and label travel with position 0."""
    parts = len(books.entries)
    width = books.entries[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole = _kept(batch.column(3), scale)
            if not len(rows):
                continue
            if whole.shape[1] != parts * width:
                raise ValueError("vectors of several lengths")
            take = pa.array(rows)
            n = len(rows)
            for pos, book in enumerate(books.entries):
                part = whole[:, pos * width:(pos + 1) * width]
                entry, _ = _nearest(part, book)
                key, label = ((batch.column(c).take(take) for c in (1, 2)) if pos == 0 else
                              (pa.nulls(n, batch.schema.field(c).type) for c in (1, 2)))
                yield pa.RecordBatch.from_arrays(
                    [key, label, batch.column(0).take(take),
                     pa.array(np.full(n, pos), pa.int32()), pa.array(entry, pa.int32()),
                     pa.array(np.ones(n), pa.int64()), _list_array(part)],
                    ["key", "label", "row", "pos", "entry", "weight", "part"])
    rows = df.select(F.monotonically_increasing_id().alias("row"), "key", "label", "v")
    return rows.mapInArrow(run, f"key bigint, label {label_type}, row bigint, pos int, entry int, "
                                "weight bigint, part array<bigint>")


def _living(batch: pa.RecordBatch, books: list[Codebooks]) -> Iterator[tuple]:
    """(pos, rows, parts, entry, moved to, distance) of the parts of a batch that no codebook
    but the last of ``books`` sent away. Columns: row, pos, entry, ..., part last."""
    pos = batch.column("pos").to_numpy()
    entry = batch.column("entry").to_numpy().astype(np.int64)
    alive = np.flatnonzero(np.asarray(batch.column("row").is_valid()))
    if not len(alive):
        return
    part = as_matrix(batch.column("part"))
    for p in np.unique(pos[alive]):
        at = alive[pos[alive] == p]
        for book in books[:-1]:
            at = at[_nearest(part[at], book.entries[p])[0] == entry[at]]
        if len(at):
            to, far = _nearest(part[at], books[-1].entries[p])
            yield int(p), at, part[at], entry[at], to, far


def _round(table: DataFrame, books: list[Codebooks], label_type: str) -> DataFrame:
    """What the owners of a table's parts send: sums of those that stay under the last of
    ``books``, and those that move. ``books`` are the codebooks since the table was written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, at, part, entry, to, _ in _living(batch, books):
                moved = to != entry
                stay = ~moved
                size = len(books[-1].entries[p])
                count = np.bincount(entry[stay], minlength=size)
                total = np.zeros((size, part.shape[1]), np.int64)
                np.add.at(total, entry[stay], part[stay])
                some = np.flatnonzero(count)
                take, n, m = pa.array(at[moved]), int(moved.sum()), len(some)
                own = [batch.column(c).take(take) for c in ("key", "label", "row")]
                own = [pa.concat_arrays([c, pa.nulls(m, c.type)]) for c in own]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.full(n + m, p), pa.int32()),
                     pa.array(np.append(to[moved], some), pa.int32()),
                     pa.array(np.append(np.ones(n, np.int64), count[some]), pa.int64()),
                     _list_array(np.concatenate([part[moved], total[some]]))],
                    ["key", "label", "row", "pos", "entry", "weight", "part"])
    return table.drop("salt").mapInArrow(
        run, f"key bigint, label {label_type}, row bigint, pos int, entry int, weight bigint, "
             "part array<bigint>")


def _to_owners(rows: DataFrame, salts: int, name: str) -> tuple[DataFrame, dict]:
    spread = F.coalesce("row", F.spark_partition_id().cast("bigint"))
    salt = F.pmod(F.xxhash64(spread), F.lit(salts))
    return cut_with(rows.withColumn("salt", salt.cast("int"))
                    .repartition("pos", "entry", "salt"), name, count=F.count("row"))


def _means(table: DataFrame, books: Codebooks) -> Codebooks:
    """The owners' sums as new entries: floor(sum / count). Unused entries stay."""
    width = books.entries[0].shape[1]
    sums = table.groupBy("pos", "entry").agg(
        F.sum("weight").alias("n"),
        *[F.sum(F.get("part", F.lit(k))).alias(f"s{k}") for k in range(width)]).collect()
    new = [book.copy() for book in books.entries]
    for r in sums:
        new[r.pos][r.entry] = [r[f"s{k}"] // r.n for k in range(width)]
    return Codebooks(new)


def _finished(table: DataFrame, books: list[Codebooks], label_type: str) -> DataFrame:
    """(key, label, row, pos, entry, far) of the parts that live in a table, at last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, at, _, _, to, far in _living(batch, books):
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(take) for c in ("key", "label", "row")],
                     pa.array(np.full(len(at), p), pa.int32()), pa.array(to, pa.int32()),
                     pa.array(far, pa.int64())],
                    ["key", "label", "row", "pos", "entry", "far"])
    return table.drop("salt").mapInArrow(
        run, f"key bigint, label {label_type}, row bigint, pos int, entry int, far bigint")


def compress(df: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE, owner_rows: int = OWNER_ROWS) -> tuple[DataFrame, Codebooks]:
    """(key, label, code, error) per usable vector, and the codebooks.

    A component x counts as the integer floor(scale * x). Codebooks start as the parts of
    the ``entries`` smallest keys (fewer rows, fewer entries); each of ``rounds`` rounds
    assigns all parts to their nearest entries and replaces each entry by the floor of its
    parts' mean. ``code`` has two hex digits a part, ``error`` is the summed squared distance.

    Vectors that are null, empty, or hold a null or non-finite component are dropped. Rows
    that repeat, also with their key, each count and give a row; of rows with one key the
    smaller vector starts the codebooks first, and null keys come last. Vectors of several
    lengths, or of components of LIMIT / scale or more, are an error. An empty table gives
    no rows and no codebooks. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry needs two hex digits")
    rows = _vectors(df, key, vec, label)
    label_type = rows.schema["label"].dataType.simpleString()
    start = _first_books(rows, parts, entries, scale)
    if start is None:
        return rows.limit(0).select(
            F.col("key").alias(key), F.col("label").alias(label), F.lit("").alias("code"),
            F.lit(0).cast("bigint").alias("error")), Codebooks([])
    salts = max(LEAST_SALTS, -(-rows.count() // owner_rows))
    books = [start]
    first, _ = _to_owners(_placed(rows, start, scale, label_type), salts, "residents")
    tables = [first]
    for done in range(rounds):
        books.append(_means(tables[-1], books[-1]))
        if done + 1 < rounds:
            # A table written in round r has met the codebooks up to r.
            sent = [_round(t, books[r + 1:], label_type) for r, t in enumerate(tables)]
            tables.append(_to_owners(reduce(DataFrame.unionByName, sent), salts, "residents")[0])
    ends = reduce(DataFrame.unionByName, [_finished(t, books[r + 1:], label_type)
                                          for r, t in enumerate(tables)])
    digits = [F.max(F.when(F.col("pos") == p, F.col("entry"))).alias(f"e{p}")
              for p in range(parts)]
    code = F.concat(*[F.lpad(F.lower(F.hex(f"e{p}")), 2, "0") for p in range(parts)])
    coded = ends.groupBy("row").agg(F.max("key").alias("key"), F.max("label").alias("label"),
                                    F.sum("far").alias("error"), *digits)
    return coded.select(F.col("key").alias(key), F.col("label").alias(label),
                        code.alias("code"), "error"), books[-1]


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """Append ``label_error``: the error summed over rows with one label, nulls together."""
    coded = cut(coded, "coded")
    totals = coded.groupBy(label).agg(F.sum("error").alias("label_error"))
    totals = totals.withColumnRenamed(label, "_of")
    return coded.join(totals, coded[label].eqNullSafe(totals["_of"])).drop("_of")

"""Near duplicates by a MinHash LSH forest, confirmed on full shingle sets.

1. Every text becomes its set of distinct n-word shingles, a digest of the set, and
   ``TREES`` signatures of ``DEPTH`` minima each. Texts with one digest are one class,
   represented by the smallest id.
2. Each tree sorts the classes by its signature. Neighbours in that order share the
   longest prefixes. A region, the classes that share the first ``SHALLOW`` minima, is
   compared whole while it is small. In a crowded region a class meets only its next
   neighbours, which share prefixes as deep as the region is dense. A pair is a
   candidate when ``AGREE`` of the ``DEPTH`` minima agree.
3. Candidates join classes to clusters, which are compared on full sets: clusters are
   dealt into blocks of bounded weight; each block is compared within itself and with
   the first block of its cluster, then what is not in the largest component so far
   with all blocks. A comparison returns the links of a spanning forest, never all
   pairs.

A link at similarity 0.85 is missed by one tree with probability 0.40 and by all 16
with 5e-7; at 0.8 with 3e-5. In a crowded region, where pairs may stand far apart, a
class is found through any of its neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import cut
from .sharing import if_small
from .words import shingle_sets, words_of

TREES, DEPTH, SHALLOW, AGREE = 16, 8, 3, 6
# Regions up to this many classes are compared whole.
CROWD = 8
# Shingles of one block of a cluster.
BLOCK_SHINGLES = 200_000

_rng = np.random.default_rng(7)
_FACTORS = _rng.integers(1, 1 << 62, TREES * DEPTH, dtype=np.int64).astype(np.uint64) * 2 + 1


def signature(shingles: np.ndarray) -> bytes:
    """The upper half of the smallest product with each factor, big-endian."""
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 4096):
        np.minimum(low, (_FACTORS[:, None] * shingles[None, k: k + 4096]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(">u4").tobytes()


def signatures(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(doc, n, digest, sig) per row; digest and sig are null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sig = [], [], []
            for block in words_of(batch.column(1), lower=True):
                for shingles in shingle_sets(block, words):
                    n.append(len(shingles))
                    digest.append(hashlib.md5(shingles.tobytes()).digest() if n[-1] else None)
                    sig.append(signature(shingles) if n[-1] else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.binary())], ["doc", "n", "digest", "sig"])
    return docs.select(F.col(key).cast("bigint").alias("doc"),
                       F.col(text).cast("string").cast("binary").alias("text")).mapInArrow(
        run, "doc bigint, n bigint, digest binary, sig binary")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _neighbours(share: float):
    """Candidate pairs from the classes of a partition in signature order.

    Of a crowded region that spans batches only its last ``CROWD`` + 1 rows are held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = np.zeros(0, np.int32)
        sig, doc, n = np.zeros((0, DEPTH), ">u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        old = 0  # rows carried over whose pairs are out
        for batch in _with_end(batches):
            if batch is not None:
                tree = np.concatenate([tree, batch.column(0).to_numpy()])
                rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4")
                sig = np.concatenate([sig, rows.reshape(-1, DEPTH)])
                doc = np.concatenate([doc, batch.column(2).to_numpy()])
                n = np.concatenate([n, batch.column(3).to_numpy()])
            if not len(doc):
                continue
            new = np.ones(len(doc), bool)
            new[1:] = (tree[1:] != tree[:-1]) | (sig[1:, :SHALLOW] != sig[:-1, :SHALLOW]).any(axis=1)
            starts = np.flatnonzero(new)
            region = np.cumsum(new) - 1
            size = np.diff(np.append(starts, len(doc)))
            crowded = (size > CROWD)[region]
            # The last region may go on: unless crowded it waits for the next batch.
            waiting = region == len(starts) - 1 if batch is not None else np.zeros(len(doc), bool)
            found = []
            for ahead in range(1, CROWD):
                b = np.arange(ahead, len(doc))
                b = b[region[b] == region[b - ahead]]
                b = b[(b >= old) & np.where(crowded[b], ahead == 1, ~waiting[b])]
                if len(b):
                    a = b - ahead
                    ok = np.minimum(n[a], n[b]) >= share * np.maximum(n[a], n[b])
                    ok &= (sig[a] == sig[b]).sum(axis=1) >= AGREE
                    found.append((doc[a[ok]], doc[b[ok]]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["i", "j"])
            # Carry the last region, or of a crowded one what marks it as such.
            last = starts[-1]
            keep = max(last, len(doc) - CROWD - 1) if crowded[-1] else last
            old = len(doc) - keep if crowded[-1] else 0
            tree, sig, doc, n = tree[keep:], sig[keep:], doc[keep:], n[keep:]
    return run


def candidate_pairs(classes: DataFrame, share: float) -> DataFrame:
    """(i, j) with i < j from the forest over ``classes`` (doc, n, sig)."""
    width = 4 * DEPTH
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = classes.select(trees, "doc", "n", "sig").select(
        "tree", F.col("sig").substr(F.col("tree") * width + 1, F.lit(width)).alias("key"),
        "doc", "n")
    ordered = rows.repartitionByRange("tree", "key", "doc").sortWithinPartitions(
        "tree", "key", "doc")
    return ordered.mapInArrow(_neighbours(share), "i bigint, j bigint").distinct()


def _links(members: list[tuple[int, np.ndarray]], left: int, num: int, den: int):
    """Links among ``members`` (doc, set) that join components; the first ``left`` meet all,
    the others meet only those. A link: den * intersection >= num * union."""
    flat = np.concatenate([s for _, s in members])
    ids = np.unique(flat, return_inverse=True)[1]
    sizes = np.array([len(s) for _, s in members])
    at = np.append(0, np.cumsum(sizes))
    mark = np.zeros(ids.max() + 1, np.int64)
    part = np.arange(len(members))
    out = []
    for k in range(1, len(members)):
        stop = min(k, left)
        mine = ids[at[k]: at[k + 1]]
        mark[mine] = 1
        both = np.add.reduceat(mark[ids[: at[stop]]], at[:stop])
        mark[mine] = 0
        hit = np.flatnonzero(den * both >= num * (sizes[:stop] + sizes[k] - both))
        for name, first in zip(*np.unique(part[hit], return_index=True)):
            part[part == name] = k
            out.append((members[hit[first]][0], members[k][0]))
    return out


def confirmed_links(docs: DataFrame, tasks: DataFrame, key: str, text: str, words: int,
                    num: int, den: int) -> DataFrame:
    """(i, j) from comparing the texts dealt to each task.

    ``tasks`` has (doc, tasks array<struct<cluster, x, y, side>>): the rows of side 0
    of a task are compared with all, those of side 1 only with side 0. A task holds two
    blocks at most.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block in words_of(batch.column(1), lower=True):
                found.extend(s.tobytes() for s in shingle_sets(block, words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.binary())],
                ["doc", "tasks", "shingles"])

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "doc"])
        members = [(d, np.frombuffer(s, np.uint64)) for d, s in zip(rows["doc"], rows["shingles"])]
        left = int((rows["side"] == 0).sum())
        found = _links(members, left, num, den) if left and len(members) > 1 else []
        return pd.DataFrame(found, columns=["i", "j"], dtype="int64")

    whole = docs.select(F.col(key).cast("bigint").alias("doc"),
                        F.col(text).cast("string").cast("binary").alias("text"))
    task = "array<struct<cluster:bigint,x:int,y:int,side:int>>"
    dealt = (whole.join(if_small(tasks, 64), "doc").select("doc", "text", "tasks")
             .mapInArrow(sets, f"doc bigint, tasks {task}, shingles binary")
             .select("doc", "shingles", F.inline("tasks")))
    return dealt.groupBy("cluster", "x", "y").applyInPandas(compare, "i bigint, j bigint")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                num: int = 85, den: int = 100) -> DataFrame:
    """(key, n_shingles, component_id) per row of ``docs``.

    Two documents are linked when den * intersection >= num * union of their sets of
    distinct ``words``-word shingles of A-Z lower-cased words; with fewer words the
    whole sequence is the one shingle. ``component_id`` is the smallest key that links
    reach. A text that is null or has no words is linked with nothing, and a row
    without key is its own component, with null id. Rows that repeat are one document and
    each give a row. Rows of one key with different texts each give a row as well, with the
    component of their text; texts that stand under one key share its links. Keys are
    integers, or strings of them. Extra columns are not read.
    """
    rows = cut(signatures(docs, key, text, words), "signatures")
    linked = rows.where("digest IS NOT NULL AND doc IS NOT NULL")
    best = linked.groupBy("digest").agg(F.min(F.struct("doc", "n", "sig")).alias("best"))
    classes = best.select("best.doc", "best.n", "best.sig")
    pairs = cut(candidate_pairs(classes, num / den), "candidates")
    clusters = cut(connected_components(pairs).join(
        linked.select(F.col("doc").alias("node"), "n").distinct(), "node"), "clusters")

    # Blocks of a cluster: so many that none is expected above its weight.
    weights = clusters.groupBy("component").agg(F.ceil(
        F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    placed = cut(clusters.join(weights, "component").select(
        F.col("node").alias("doc"), F.col("component").alias("cluster"), "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block")), "blocks")

    def task(x, y, side):
        return F.struct(F.col("cluster"), x.cast("int").alias("x"), y.cast("int").alias("y"),
                        F.lit(side).alias("side"))
    zero, block, blocks = F.lit(0), F.col("block"), F.col("blocks")
    with_first = F.when(block == 0, F.transform(
        F.sequence(F.lit(1), F.greatest(blocks - 1, F.lit(1))), lambda y: task(zero, y, 0))
    ).otherwise(F.array(task(zero, block, 1)))
    own = F.array(task(block, block, 0))
    first = cut(placed.select("doc", F.when(blocks == 1, own).otherwise(
        F.concat(own, with_first)).alias("tasks")), "tasks")
    links = cut(confirmed_links(docs, first, key, text, words, num, den), "links")

    many = placed.where("blocks > 1")
    if not many.isEmpty():
        # What is outside the largest component of its cluster meets all blocks.
        parts = many.join(connected_components(links), F.col("doc") == F.col("node"), "left").select(
            "doc", "cluster", "blocks", "block", F.coalesce("component", "doc").alias("part"))
        largest = parts.groupBy("cluster", "part").agg(F.count("*").alias("size")).groupBy(
            "cluster").agg(F.max(F.struct("size", "part"))["part"].alias("main"))
        parts = cut(parts.join(largest, "cluster"), "parts")
        strays = parts.where("part <> main")
        some = strays.groupBy("cluster").agg(F.collect_set("block").alias("with"))
        meets = F.transform(F.col("with"), lambda s: task(s, block, 1))
        spread = F.transform(F.sequence(zero, blocks - 1), lambda y: task(block, y, 0))
        # A stray is on side 0 in its own task with each block; there it stands once.
        again = F.when(F.col("part") == F.col("main"), meets).otherwise(F.concat(
            spread, F.filter(meets, lambda t: t["x"] != block)))
        second = cut(parts.join(some, "cluster").select("doc", again.alias("tasks")), "tasks")
        links = cut(links.unionByName(
            confirmed_links(docs, second, key, text, words, num, den)), "links")

    found = connected_components(links)
    # A class carries its component to all its copies.
    labelled = classes.select("doc").distinct().join(found, F.col("doc") == F.col("node"), "left").select(
        "doc", F.coalesce("component", "doc").alias("component"))
    names = best.select("digest", F.col("best.doc").alias("doc")).join(labelled, "doc").select(
        "digest", "component")
    salts = 16
    salted = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int"))
            .join(salted, ["digest", "salt"], "left")
            .select(F.col("doc").alias(key), F.col("n").alias("n_shingles"),
                    F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
                    .alias("component_id")))

"""Coordinates for the nodes of a neighbour graph, from its leading eigenvectors.

The graph is a table of weighted edges, a block of vectors a table with one row for each
node and one column for each vector. A product of the two is a join and a sum by node,
and what the driver sees of it are the sums of products of columns, a small square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, cut_with

DIMENSIONS = 2
GUARD = 4          # vectors iterated beyond those asked for, which speeds up the others
ROUNDS = 30
TOLERANCE = 1e-2


@dataclass
class Layout:
    """``nodes``: node, coordinates. ``values`` are the eigenvalues of the coordinates, largest
    first; ``residual`` is how far the block is from being invariant, ``rounds`` the products
    it took."""

    nodes: DataFrame
    values: list[float]
    residual: float
    rounds: int


def symmetric(near: DataFrame, weight: str | None = None) -> DataFrame:
    """(i, j, w) in both directions, each pair once: an edge counts if either end lists it."""
    w = F.greatest(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    one = near.where("i <> j").select("i", "j", w.alias("w"))
    both = one.unionByName(one.select(F.col("j").alias("i"), F.col("i").alias("j"), "w"))
    return both.groupBy("i", "j").agg(F.max("w").alias("w")).where("w > 0")


def _turned(block: DataFrame, matrix: np.ndarray, out: str) -> DataFrame:
    """A block of vectors times a small matrix, as the columns ``out``0, ``out``1, ..."""
    names = [f"{out}{k}" for k in range(matrix.shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1) @ matrix
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v) for v in values.T]], ["node", *names])
    # In numpy: as column expressions each round's numbers would be new code to compile.
    return block.mapInArrow(run, "node bigint, " + ", ".join(f"{n} double" for n in names))


def graph_layout(near: DataFrame, weight: str | None = None, dims: int = DIMENSIONS,
                 rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Layout:
    """Spectral coordinates of the nodes of ``near`` (i, j, weight).

    With D the nodes' summed weights, the leading eigenvectors of (1 + D^-1/2 W D^-1/2) / 2
    put nodes close that many or heavy paths connect. The first one, which says only how
    connected a node is, is left out; if the graph has several parts, the next ones tell
    the parts apart. A block of vectors is multiplied and made orthonormal until it is
    invariant up to ``tolerance``, or for ``rounds``. Signs are chosen so that the largest
    entry of each coordinate is positive.
    """
    edges = cut(symmetric(near, weight), "graph")
    degrees, seen = cut_with(edges.groupBy(F.col("i").alias("node")).agg(F.sum("w").alias("d")),
                             "degrees", count=F.count(F.lit(1)))
    size = min(dims + 1 + GUARD, seen["count"])
    if size < 2:
        return Layout(degrees.select("node", F.array().cast("array<double>").alias("coordinates")),
                      [], 0.0, 0)
    scale = degrees.select("node", F.sqrt("d").alias("r"))
    # Tables of nodes are not sent through the driver, however small: there is one a round.
    scaled = edges.join(scale.toDF("i", "ri").hint("merge"), "i").join(
        scale.toDF("j", "rj").hint("merge"), "j").select(
        "i", "j", (F.col("w") / (F.col("ri") * F.col("rj"))).alias("s"))
    scaled = cut(scaled, "scaled")
    q = [f"q{k}" for k in range(size)]
    y = [f"y{k}" for k in range(size)]

    def square(a: list[str], b: list[str], name: str) -> dict:
        """The sums of products, which are symmetric in theory."""
        return {f"{name}_{m}_{n}": F.sum(F.col(a[m]) * F.col(b[n]))
                for m in range(size) for n in range(m, size)}

    def matrix(found: dict, name: str) -> np.ndarray:
        return np.array([[found[f"{name}_{min(m, n)}_{max(m, n)}"] for n in range(size)]
                         for m in range(size)])

    # The first vector is known; the others start from a hash of the node.
    draws = [(F.xxhash64("node", F.lit(k)) / float(1 << 63)).alias(q[k]) for k in range(1, size)]
    block, found = cut_with(scale.select("node", F.col("r").alias("q0"), *draws), "block",
                            **square(q, q, "qq"))
    turn = np.linalg.inv(np.linalg.cholesky(matrix(found, "qq"))).T
    done = 0
    while True:
        done += 1
        block = _turned(block, turn, "q")
        sent = block.select(F.col("node").alias("j"), *q)
        sums = (scaled.join(sent.hint("merge"), "j").groupBy(F.col("i").alias("node"))
                .agg(*[F.sum(F.col("s") * F.col(a)).alias(b) for a, b in zip(q, y)]))
        product = block.join(sums.hint("merge"), "node").select(
            "node", *q, *[((F.col(a) + F.col(b)) / 2).alias(b) for a, b in zip(q, y)])
        product, found = cut_with(product, "block", **square(q, y, "qy"), **square(y, y, "yy"))
        inner, outer = matrix(found, "qy"), matrix(found, "yy")
        values, vectors = np.linalg.eigh(inner)
        values, vectors = values[::-1], vectors[:, ::-1]
        wanted = vectors[:, :dims + 1]
        # |Y v - q v value|, of the vectors that are asked for.
        lost = np.diag(wanted.T @ outer @ wanted) - values[:dims + 1] ** 2
        residual = float(np.sqrt(max(0.0, lost.max())))
        if residual <= tolerance or done >= rounds:
            break
        block = product.select("node", *[F.col(b).alias(a) for a, b in zip(q, y)])
        turn = np.linalg.inv(np.linalg.cholesky(outer)).T
    shown = vectors[:, 1:dims + 1]
    names = [f"x{k}" for k in range(shown.shape[1])]
    nodes = cut(_turned(product.select("node", *q), shown, "x"), "layout")
    signs = nodes.agg(*[F.max_by(F.col(n), F.struct(F.round(F.abs(n), 9), -F.col("node"))).alias(n)
                        for n in names]).first()
    placed = nodes.select("node", F.array(*[
        F.col(n) * (1.0 if signs[n] >= 0 else -1.0) for n in names]).alias("coordinates"))
    return Layout(placed, [float(x) for x in values[1:dims + 1]], residual, done)

"""Small numpy helpers that work on one bounded block of vectors inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

DIGITS = 10  # measures are ranked at this precision, so ties break by id


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column to a dense row matrix; null lists and several lengths are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros((0, 0))
    lengths = column.value_lengths()
    if column.null_count or len(lengths.unique()) > 1:
        raise ValueError("a block of vectors needs rows of one length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def measure(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Pairwise measure, smaller is closer: minus cosine, or Euclidean distance."""
    dots = left @ right.T
    if metric == "cosine":
        return -dots
    squares = (left * left).sum(1)[:, None] - 2 * dots + (right * right).sum(1)[None, :]
    return np.sqrt(np.maximum(squares, 0.0))


def spanning_forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray,
                    n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lightest spanning forest of an edge list and the component of each node.

    Every component adds its lightest outgoing edge until none is left. Equal
    weights are ordered by position, so no cycle can form.
    """
    order = np.argsort(weight, kind="stable")
    i, j = i[order], j[order]
    label = np.arange(n)
    chosen: list[np.ndarray] = []
    live = np.arange(len(i))
    while True:
        live = live[label[i[live]] != label[j[live]]]
        if not len(live):
            break
        ends = np.stack([label[i[live]], label[j[live]]], axis=1).ravel()
        _, first = np.unique(ends, return_index=True)
        picked = np.unique(live[first // 2])
        chosen.append(picked)
        low = np.arange(n)
        a, b = label[i[picked]], label[j[picked]]
        while True:
            new = low.copy()
            np.minimum.at(new, a, low[b])
            np.minimum.at(new, b, low[a])
            new = new[new]
            if (new == low).all():
                break
            low = new
        label = low[label]
    edges = np.concatenate(chosen) if chosen else np.zeros(0, dtype=int)
    return order[edges], label


def nearest(m: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` smallest entries per row; inf is skipped.

    Entries equal to the k-th are kept until the ids decide.
    """
    m = np.round(m, DIGITS)
    width = m.shape[1]
    if width > k:
        kth = np.partition(m, k - 1, axis=1)[:, k - 1:k]
        row, col = np.nonzero((m <= kth) & np.isfinite(m))
    else:
        row, col = np.nonzero(np.isfinite(m))
    order = np.lexsort((ids[col], m[row, col], row))
    row, col = row[order], col[order]
    start = np.searchsorted(row, row)
    keep = np.arange(len(row)) - start < k
    return row[keep], col[keep]

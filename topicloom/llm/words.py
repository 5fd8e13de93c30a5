"""Words of UTF-8 texts as 64-bit numbers, a block of texts at a time, in numpy.

A word is a run of bytes other than space and \\x09-\\x0D. Its number is made of its
pieces of eight bytes: each is spread together with its place, so that no pattern of
bytes cancels out, and the sum is spread with the length. Words of one length up to
eight bytes never share a number; others do by chance of one in 2^64. A second number
of the same bytes, under other keys, makes 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text looked at together; a longer text is a block of its own.
BLOCK = 1 << 20

# Keys of the first and the second number, and the factor that tells left from right.
_KEYS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_LEFT = np.uint64(0xA0761D6478BD642F)
# The first k bytes of a piece.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of each number (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.uint64) -> np.ndarray:
    """A number for the bytes of each data[starts:ends], none of them empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    pieces = (ends - starts + 7) >> 3
    first = np.cumsum(pieces) - pieces
    place = np.arange(first[-1] + pieces[-1]) - np.repeat(first, pieces)
    at = np.repeat(starts, pieces) + 8 * place
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    piece = eights[at] & _MASK[np.minimum(np.repeat(ends, pieces) - at, 8)]
    # Few places occur, and most words have one piece.
    keys = mix(np.arange(1, int(pieces.max()) + 1, dtype=np.uint64) * _LEFT ^ key)
    spread = mix(piece ^ keys[place])
    return mix(np.add.reduceat(spread, first) + (ends - starts).astype(np.uint64) ^ key)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each run on the left followed by the run on the right."""
    return mix(left * _LEFT + right)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A number for each n consecutive words, from runs that double in length; those across
    two texts are the caller's to drop."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    span, run, done, out = 1, hashes, 0, None
    while True:
        if n & span:
            part = run[done: done + size]
            out = part if out is None else _join(out, part)
            done += span
        if 2 * span > n:
            return mix(out + np.uint64(n))
        run = _join(run[:-span], run[span:])
        span *= 2


@dataclass
class Words:
    """Texts ``low`` to ``high`` of a column: ``data`` are their bytes, word w is
    data[starts[w]:ends[w]], text t has the words first[t - low] to first[t - low + 1]."""

    low: int
    high: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def others(self) -> np.ndarray:
        """The second number of each word, from its bytes."""
        return _numbers(self.data, self.starts, self.ends, _KEYS[1])


def words_of(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a binary column, null as empty, in blocks of whole texts.

    Offsets are of 32 bits or, in a large column, of 64.
    """
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, wide)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + BLOCK, "right")) - 1)
        part = raw[at[low]: at[high]]
        if lower:
            part = _LOWER[part]
        bounds = at[low: high + 1] - at[low]
        solid = ~_SPACE[part]
        cut = np.zeros(len(part) + 1, bool)
        cut[bounds] = True
        edge = np.zeros(len(part) + 1, bool)
        edge[1:-1] = solid[1:] != solid[:-1]
        edge |= cut
        starts = np.flatnonzero(edge[:-1] & solid)
        ends = np.flatnonzero(edge[1:] & solid) + 1
        hashes = _numbers(part, starts, ends, _KEYS[0])
        yield Words(low, high, part, starts, ends, hashes, np.searchsorted(starts, bounds))
        low = high


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """For each text its distinct n-word shingles in order; all words as one if there are fewer."""
    whole = grams(words.hashes, n)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= n:
            yield np.unique(whole[a: b - n + 1])
        elif b > a:
            yield grams(words.hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)

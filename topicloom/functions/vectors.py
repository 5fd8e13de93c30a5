"""Vector expressions on ARRAY<DOUBLE> columns."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let, tokens

HASH_DIMS = 64
TOKENS = 1 << 18  # tokens counted at once


def as_vector(c: Column) -> Column:
    return c.cast("array<double>")


def parse_vector(c: Column) -> Column:
    """A vector written as a text literal, such as ``[0.1, 2]``."""
    return F.from_json(c, "array<double>")


def entries(df: DataFrame, keep: Sequence[str | Column], vec: str) -> DataFrame:
    """(keep..., pos, x): one row per vector entry.

    The outer form keeps the optimizer from adding a size test below, which
    would compute the vector expression a second time.
    """
    return (df.select(*keep, F.posexplode_outer(as_vector(F.col(vec))).alias("pos", "x"))
            .where(F.col("pos").isNotNull()))


def finite(v: Column) -> Column:
    """NaN, infinities and missing entries become 0."""
    return F.transform(v, lambda x: F.when(
        x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x))


def squared_norm(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)


def unit(v: Column) -> Column:
    """Divide by the Euclidean norm; a zero vector stays as it is."""
    return let(v, lambda a: let(F.sqrt(squared_norm(a)), lambda n: F.transform(
        a, lambda x: F.when(n > 0, x / n).otherwise(x))))


def _hashed(dims: int):
    """Unit vectors of token lists, see `hash_embed`; distinct tokens of a batch are hashed once."""
    def run(lists: pa.Array) -> pa.Array:
        lists = pc.fill_null(lists, [])
        offsets = lists.offsets.to_numpy()
        words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        codes = np.array([int(h[6:8], 16) % dims * 2 + (h[15] not in "13579bdf")
                          for h in (hashlib.md5(word).hexdigest() for word in
                                    words.dictionary.cast(pa.binary()).to_pylist())], np.int64)
        at = words.indices.to_numpy()
        offsets = offsets - offsets[0]
        counts = np.zeros((len(lists), dims))
        row = 0
        while row < len(lists):
            # As many rows as hold some number of tokens, one at least.
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + TOKENS, "right")) - 1)
            code = codes[at[offsets[row]:offsets[end]]]
            of = np.repeat(np.arange(end - row), np.diff(offsets[row:end + 1]))
            both = np.bincount(of * (2 * dims) + code, minlength=(end - row) * 2 * dims)
            both = both.reshape(-1, dims, 2)
            counts[row:end] = both[:, :, 0] - both[:, :, 1]
            row = end
        norm = np.sqrt((counts * counts).sum(1))[:, None]
        unit_rows = np.divide(counts, norm, out=counts, where=norm > 0)
        return pa.ListArray.from_arrays(np.arange(len(lists) + 1, dtype=np.int32) * dims,
                                        pa.array(unit_rows.ravel()))
    return run


def hash_embed(text: Column, dims: int = HASH_DIMS) -> Column:
    """Signed feature hashing of a text's tokens to a unit vector.

    A token's MD5 picks an entry (first eight hex digits modulo ``dims``) and a
    sign (next eight, plus when odd). Each token becomes one code, entry and
    sign together; an entry's value is the difference of its two code counts.
    The tokens go to Python in Arrow batches, where each distinct one is hashed once;
    a text without tokens, also null, has zeros. No explode, no shuffle.
    """
    if not 0 < dims <= 256 or dims & (dims - 1):
        raise ValueError("dims must be a power of two up to 256")
    # For a power of two up to 256 the last two of eight digits decide.
    return F.arrow_udf(_hashed(dims), "array<double>")(tokens(text))

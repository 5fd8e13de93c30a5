"""Joining big rows to few keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side of at most so many bytes, by counted rows times the width of a row, is broadcast.
BROADCAST_BYTES = 16 << 20


def if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Hint a broadcast when the counted rows prove ``df`` small, else leave a shuffled join.

    ``df`` is a written table, so counting reads only its footers.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name

"""Vectors from a caller's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import finite, unit

BATCH = 64  # fixed value: texts per call of a local model


def embed_with(df: DataFrame, text: str,
               encoder: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
               batch: int = BATCH, out: str = "embedding") -> DataFrame:
    """Append unit vectors from ``encoder``.

    ``encoder`` is called once per task and returns the function that encodes a
    list of texts; loading a model belongs there. Filters and cleaning should
    come before: the optimizer does not push them through.
    """
    @F.pandas_udf("array<double>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for texts in batches:
            found: list = []
            for start in range(0, len(texts), batch):
                part = texts.iloc[start:start + batch].fillna("").tolist()
                found.extend(np.asarray(v, np.float64) for v in encode(part))
            yield pd.Series(found, dtype=object)

    # Only the texts travel to Python.
    return df.withColumn(out, unit(finite(vectors(F.col(text)))))

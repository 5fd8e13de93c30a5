"""Mean vectors of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import as_vector


def mean_vectors(df: DataFrame, group: Sequence[str], vec: str,
                 weight: str | None = None, out: str = "vec") -> DataFrame:
    """Entry-wise mean of each group's vectors; NaN and null entries are skipped.

    A task holds one buffer for each group it sees, and sends one row for each: the sums of
    the entries, followed by the weights of the entries that are there. An entry with no
    value at all, or without a finite mean, is 0. Null and empty vectors count for nothing.
    Weights must not be negative.
    """
    v = as_vector(F.col(vec))

    def given(x):
        return x.isNotNull() & ~F.isnan(x)
    both = F.concat(F.transform(v, lambda x: F.when(given(x), x).otherwise(0.0)),
                    F.transform(v, lambda x: F.when(given(x), 1.0).otherwise(0.0)))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.size(vec) > 0).select(*group, array_to_vector(both).alias("_both"),
                                            w.alias("_w"))
    sums = rows.groupBy(*group).agg(Summarizer.sum(F.col("_both"), F.col("_w")).alias("_s"))
    parts = vector_to_array("_s")
    half = (F.size("_a") / 2).cast("int")
    mean = F.zip_with(F.slice("_a", F.lit(1), half), F.slice("_a", half + 1, half),
                      lambda s, n: F.when((n > 0) & (F.abs(s) < float("inf")), s / n)
                      .otherwise(0.0))
    return sums.select(*group, parts.alias("_a")).select(*group, mean.alias(out))


def centroids(df: DataFrame, cluster: str, vec: str, noise: int = -1) -> DataFrame:
    """(cluster, vec, size) for every cluster but noise."""
    kept = df.where(F.col(cluster) != noise)
    sizes = kept.groupBy(cluster).agg(F.count("*").alias("size"))
    return mean_vectors(kept, [cluster], vec).join(sizes, cluster)

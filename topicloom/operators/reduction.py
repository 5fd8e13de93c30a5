"""Fewer dimensions for clustering and plots."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import as_vector, unit

COMPONENTS = 10  # fixed value


def reduce_dims(df: DataFrame, vec: str, k: int = COMPONENTS, out: str = "reduced") -> DataFrame:
    """Append the first ``k`` principal components of the unit vectors.

    A component's sign is free; it is chosen so that its largest loading is
    positive, which makes runs comparable. The fitted matrix is dims x k.
    """
    rows = df.withColumn("_v", array_to_vector(unit(as_vector(F.col(vec)))))
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(rows)
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    signed = F.zip_with(vector_to_array("_pc"), F.array(*[F.lit(s) for s in signs]),
                        lambda x, s: x * s)
    return model.transform(rows).withColumn(out, signed).drop("_v", "_pc")

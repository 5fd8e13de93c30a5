"""Reading and writing tables: Parquet, gzip CSV, JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
])
CSV_OPTIONS = {"header": True, "escape": '"', "quote": '"', "encoding": "UTF-8"}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def write_csv(df: DataFrame, path: str, mode: str = "error", single_file: bool = False) -> None:
    """Gzip CSV with a header. One file only for an export known to be small."""
    df = df.coalesce(1) if single_file else df
    # Quote everything that is text, so that '' and null stay apart.
    (df.write.mode(mode).options(**CSV_OPTIONS, quoteAll=True, emptyValue="", nullValue=None,
                                 ignoreLeadingWhiteSpace=False,
                                 ignoreTrailingWhiteSpace=False, compression="gzip").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT_SCHEMA,
             null_tokens: Sequence[str] = ()) -> DataFrame:
    """Read CSV with line breaks inside quotes. ``null_tokens`` also read as null."""
    df = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True).csv(path)
    for field in schema.fields if null_tokens else []:
        if isinstance(field.dataType, T.StringType):
            c = F.col(field.name)
            df = df.withColumn(field.name, F.when(~c.isin(list(null_tokens)), c))
    return df


def roundtrip_csv(df: DataFrame) -> DataFrame:
    """Write as gzip CSV and read back."""
    path = scratch_path(df.sparkSession, "csv")
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Stack batches by column name; a column a batch lacks is null."""
    stacked = batches[0]
    for batch in batches[1:]:
        stacked = stacked.unionByName(batch, allowMissingColumns=True)
    return stacked


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)

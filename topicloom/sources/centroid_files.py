"""Centroid tables of several clustering configurations, on disk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.vectors import finite

# --- Fixed values: file names and metadata layout. -----------------------------
CENTROIDS, METADATA = "centroids_", "metadata_"
META_SCHEMA = ("config struct<umap_neighbors:int,hdb_min_cluster_size:int>, "
               "cluster_names map<string,string>")
# ------------------------------------------------------------------------------
ID = "cluster_id"


def config_name(neighbors: int, min_cluster_size: int) -> str:
    return f"{neighbors}_{min_cluster_size}"


def write_centroids(df: DataFrame, folder: str, neighbors: int, min_cluster_size: int,
                    dims: int, cluster: str = "cluster_id", vec: str = "vec",
                    name: str = "name") -> None:
    """Write (cluster, vec, name) as a gzip CSV of numbers and a JSON of names."""
    key = config_name(neighbors, min_cluster_size)
    (df.select(F.col(cluster).alias(ID), *[F.get(vec, F.lit(k)).alias(f"v{k}")
                                           for k in range(dims)])
     .write.option("header", True).option("compression", "gzip")
     .csv(f"{folder}/{CENTROIDS}{key}"))
    # One line per cluster; a metadata file that holds one large object reads as well.
    (df.select(F.struct(F.lit(neighbors).alias("umap_neighbors"),
                        F.lit(min_cluster_size).alias("hdb_min_cluster_size")).alias("config"),
               F.create_map(F.col(cluster).cast("string"), F.col(name)).alias("cluster_names"))
     .write.json(f"{folder}/{METADATA}{key}"))


def _key(prefix: str):
    """What follows the prefix in the name of a file, or of the folder of its parts."""
    name = rf"/{prefix}([^/]+?)(?:\.csv\.gz|\.json)?(?:/part-[^/]*)?$"
    return F.regexp_extract("_metadata.file_path", name, 1)


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(key, source_config, cluster_id, cluster_name): one row per named cluster."""
    def metadata(pattern: str, multi_line: bool) -> DataFrame:
        return (spark.read.schema(META_SCHEMA).option("multiLine", multi_line)
                .option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(folder)
                .where(_key(METADATA) != "")
                .select(_key(METADATA).alias("key"), "config", "cluster_names"))

    read = metadata(f"{METADATA}*.json", True).unionByName(metadata("part-*.json*", False))
    return read.select(
        "key", F.concat_ws("_", "config.umap_neighbors", "config.hdb_min_cluster_size")
        .alias("source_config"),
        F.explode("cluster_names").alias("_id", "cluster_name")).select(
        "key", "source_config", F.col("_id").cast("bigint").alias(ID), "cluster_name")


def _table_files(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The files of each configuration's table; only names are read."""
    try:
        found = spark.read.format("binaryFile").load(f"{folder}/{CENTROIDS}*").select(
            _key(CENTROIDS).alias("key"), F.col("_metadata.file_path").alias("file")).collect()
    except AnalysisException as missing:
        raise FileNotFoundError(f"no {CENTROIDS}* in {folder}") from missing
    files: dict[str, list[str]] = {}
    for row in found:
        files.setdefault(row["key"], []).append(row["file"])
    return files


def _table(spark: SparkSession, key: str, files: list[str]) -> DataFrame:
    """One configuration's rows, its numeric columns under their names."""
    rows = spark.read.options(header=True, inferSchema=True).csv(sorted(files))
    numeric = [f.name for f in rows.schema.fields
               if f.name != ID and isinstance(f.dataType, T.NumericType)]
    file = F.col("_metadata.file_path").alias("_file")
    if ID in rows.columns:
        number = F.col(ID).cast("bigint")
    else:
        # A gzip file is read by one task from start to end, so this is its order.
        place = Window.partitionBy("_file").orderBy("_at")
        number = F.row_number().over(place).cast("bigint") - 1
    return rows.select("*", file, F.monotonically_increasing_id().alias("_at")).select(
        F.lit(key).alias("_key"), number.alias("_id"), *[F.col(c).cast("double").alias(c)
                                                         for c in numeric])


def load_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """(source_config, cluster_id, cluster_name, vec) of all configurations.

    Tables and metadata are paired by the key in their names. Every numeric column but
    the id belongs to the vector; tables are aligned by column name, in the order in
    which names first appear, and what a table lacks is 0. A file without ids numbers
    its rows. There is one read per configuration, a short list.
    """
    tables = [_table(spark, key, files) for key, files in sorted(_table_files(spark, folder).items())]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    columns = [c for c in rows.columns if c not in ("_key", "_id")]
    vec = finite(F.array(*[F.coalesce(c, F.lit(0.0)) for c in columns]).cast("array<double>"))
    names = read_metadata(spark, folder)
    configs = names.select("key", "source_config").distinct()
    return (rows.select(F.col("_key").alias("key"), F.col("_id").alias(ID), vec.alias("vec"))
            .join(configs, "key")
            .join(names.select("key", ID, "cluster_name"), ["key", ID], "left")
            .select("source_config", ID, "cluster_name", "vec"))


def unmatched_configs(spark: SparkSession, folder: str) -> DataFrame:
    """(key, missing): configurations of which one of the two parts is absent."""
    tables = (spark.read.text(f"{folder}/{CENTROIDS}*").select(_key(CENTROIDS).alias("key"))
              .distinct().withColumn("table", F.lit(1)))
    metadata = (spark.read.text(f"{folder}/{METADATA}*").select(_key(METADATA).alias("key"))
                .distinct().withColumn("meta", F.lit(1)))
    return (tables.join(metadata, "key", "full").where("table IS NULL OR meta IS NULL")
            .select("key", F.when(F.col("meta").isNull(), "metadata").otherwise("centroids")
                    .alias("missing")))

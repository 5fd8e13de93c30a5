"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", app: str = "topicloom", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine, where the tasks' Python finds this
    package wherever the driver was started. On a cluster the package is installed, or
    sent along with ``--py-files``."""
    home = str(Path(__file__).resolve().parents[1])
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local master may fall back to a
    temporary folder: there driver and executors are the same machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="topicloom-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/topicloom-{app}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result depends on files only, so a lost executor costs a re-read, and
    its size is known to the optimizer, which a cached or checkpointed RDD
    hides.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_with(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """Like `cut`, with aggregates taken while the rows are written."""
    seen = Observation(name)
    watched = df.observe(seen, *[metric.alias(key) for key, metric in metrics.items()])
    return cut(watched, name), seen.get

"""Ingestion of records that come again: the newest content of each record, once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from ..sources.records import PATTERN, as_xml, extract_record, read_options
from .ingest import FILES_PER_BATCH

VERSIONS = StructType([
    StructField("key", StringType()), StructField("version", IntegerType()),
    StructField("modified", TimestampType()), StructField("title", StringType()),
    StructField("abstract", StringType())])
# What is known of a record: short, whatever its size.
KNOWN = "key string, digest string, version int, modified timestamp"


class NewestContent(StatefulProcessor):
    """For each key the digest of its newest content; only another content goes on. This is the
    rule of `fold` for one key at a time, for streams that keep their state in a state store.

    State holds one short row for each key, whatever the size of the record. Of the rows of
    one batch the last by time counts, of equal times the one with the largest digest. A
    row older than what is known is passed over.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState(
            "known", "digest string, version int, modified timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                        timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for batch in rows:
            for row in batch.itertuples(index=False):
                if best is None or (row.modified, row.digest) > (best.modified, best.digest):
                    best = row
        digest, version, modified = self.known.get() if self.known.exists() else (None, 0, None)
        if best is None or best.digest == digest:
            return
        if modified is not None and best.modified < pd.Timestamp(modified):
            return
        self.known.update((best.digest, version + 1, best.modified.to_pydatetime()))
        yield pd.DataFrame([(key[0], version + 1, best.modified, best.title, best.abstract)],
                           columns=VERSIONS.names)

    def close(self) -> None:
        pass


def fold(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """(key, digest, version, modified, title, abstract): the next versions that the rows of one
    batch (key, modified, title, abstract, digest) make, given what is ``known`` of their keys.

    Of the rows of a key the last by time counts, of equal times the one with the largest
    digest. It is passed over when its content is the known one, or when it is older.
    """
    rest = F.struct("digest", "modified", "title", "abstract")
    best = (batch.groupBy("key").agg(F.max_by(rest, F.struct("modified", "digest")).alias("r"))
            .select("key", "r.*"))
    if known is None:
        return best.select("key", "digest", F.lit(1).alias("version"), "modified", "title",
                           "abstract")
    last = F.struct("digest", "version", "modified")
    kept = (known.groupBy("key").agg(F.max_by(last, "version").alias("k"))
            .select("key", *[F.col(f"k.{c}").alias(f"_{c}") for c in ("digest", "version",
                                                                      "modified")]))
    changed = F.col("_digest").isNull() | (
        (F.col("digest") != F.col("_digest")) & (F.col("modified") >= F.col("_modified")))
    return best.join(kept, "key", "left").where(changed).select(
        "key", "digest", (F.coalesce("_version", F.lit(0)) + 1).alias("version"), "modified",
        "title", "abstract")


def ingest_upsert(spark: SparkSession, root: str, out: str, checkpoint: str, key,
                  pattern: str = PATTERN, record_end: str | None = None,
                  files_per_batch: int = FILES_PER_BATCH) -> None:
    """Append to a Parquet table the records that are new or changed since they were last seen.

    ``key`` is a column over (file, title, abstract) that names a record; records without
    it are left out. A record that comes again unchanged, in any file or run, adds nothing;
    one that changed adds its next version, by the time of its file. `newest` reads the
    table as one row a record. Runs until all files are read.

    A batch is aggregated by key and joined with what earlier batches left below
    ``checkpoint``, a short row for each version. It writes its versions, then its short rows,
    each to a folder of its number, so a batch that is run again after a crash writes the same.
    """
    found = (spark.readStream.format("text").options(**read_options(pattern, record_end))
             .option("maxFilesPerTrigger", files_per_batch).load(root))
    timed = as_xml(found, record_end, "modified")
    records = extract_record(timed, "file", "xml", "modified")
    content = F.concat_ws("\u0000", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    keyed = records.select(key.cast("string").alias("key"), "modified", "title", "abstract",
                           F.sha2(content, 256).alias("digest")).where(F.col("key").isNotNull())
    states = f"{checkpoint}/known"

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        known = (session.read.schema(KNOWN + ", batch bigint").parquet(states)
                 .where(F.col("batch") < number) if number else None)
        versions = f"{out}/batch={number}"
        fold(batch, known).write.mode("overwrite").parquet(versions)
        (session.read.schema(KNOWN).parquet(versions).select("key", "digest", "version", "modified")
         .write.mode("overwrite").parquet(f"{states}/batch={number}"))

    (keyed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def newest(spark: SparkSession, out: str) -> DataFrame:
    """(key, version, modified, title, abstract): the last version of every record."""
    rows = spark.read.schema(VERSIONS).parquet(out)
    rest = F.struct("version", "modified", "title", "abstract")
    return rows.groupBy("key").agg(F.max_by(rest, "version").alias("r")).select("key", "r.*")

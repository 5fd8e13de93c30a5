"""Incremental ingestion of record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.records import PATTERN, as_xml, extract_record, read_options

# Fixed value: files per batch when nothing else is asked for.
FILES_PER_BATCH = 10_000


def record_stream(spark: SparkSession, root: str, pattern: str = PATTERN,
                  record_end: str | None = None,
                  files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """An unbounded (file, title, abstract, corrupt) over a growing folder."""
    found = (spark.readStream.format("text").options(**read_options(pattern, record_end))
             .option("maxFilesPerTrigger", files_per_batch).load(root))
    return extract_record(as_xml(found, record_end), "file", "xml")


def ingest(spark: SparkSession, root: str, out: str, checkpoint: str,
           transform=None, **options) -> list[int]:
    """Append all files not seen before to a Parquet table, batch by batch.

    The checkpoint remembers single files: after a crash finished batches are
    skipped, and new files join without moving old ones between batches. The
    text operators are stateless and may be applied as ``transform``. Returns
    the rows read by each batch.
    """
    records = record_stream(spark, root, **options)
    rows = transform(records) if transform else records
    # Progress is kept for every batch, not only for the last hundred.
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, str(1 << 30))
    query = (rows.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    finally:
        spark.conf.set(kept, before)
    batches = [progress["numInputRows"] for progress in query.recentProgress]
    return [rows for rows in batches if rows]

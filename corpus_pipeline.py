"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import decontamination, exact_dedup, language_id, mixing, near_dedup
from topicloom.llm.sharing import fresh, if_small
from topicloom.session import cut


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises; it is fitted on their labels.

    Texts without letters go, and those whose calibrated probability is too low. When
    no row is labelled nothing can be recognised, and all texts with letters stay.
    """
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(language_id.has_letter(F.col("text")))
    return language_id.keep_accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, the one with the largest doc_id."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 or more connect, the smallest stays.

    Documents without words, or without doc_id, have no near copies and stay.
    """
    found = near_dedup.near_groups(docs, num=80)
    name = fresh(docs, "_gone")
    gone = cut(found.where(F.col("doc_id") != F.col("component_id"))
               .select(F.col("doc_id").alias(name)).distinct(), "near-copies")
    return docs.join(if_small(gone, 16), F.col("doc_id") == F.col(name), "left_anti")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no part of a benchmark item, also not with other slots."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix emits it, numbered in ``copy``."""
    return mixing.mix(docs)


STAGES = [
    ("language id", keep_known_languages),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

# Language, near duplicates and contamination have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""The queries of this subpackage over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, scratch_path
from . import conversation_trie, decontamination, exact_dedup, fingerprints, html_text
from . import language_id, language_model, mixing, near_dedup, substring_dedup, url_filters
from . import vector_codes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_near_dedup(spark, folder):
    return near_dedup.near_groups(read(spark, folder, "documents")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id"))


@query
def op2_language_id(spark, folder):
    docs = read(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = language_id.fit(docs.where(~held_out))
    asked = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.predict(asked, model).select("doc_id", "held_out", "lang_pred", "score",
                                                    "accepted")


@query
def op3_mixing(spark, folder):
    plan = mixing.mix_plan(read(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


@query
def op4_warc_fixity(spark, folder):
    """Pages as WARC files in two replicas. In the second, records of keys that leave 7
    when divided by 97 are damaged and those that leave 5 when divided by 101 are
    missing; the audit locates them."""
    pages = read(spark, folder, "pages")
    rows = warc.records(pages, "page_id", "url", "html", per_file=1000)
    whole = F.col("record")
    damaged = F.when(F.pmod("key", F.lit(97)) == 7, F.concat(
        F.lit("warc-type: "), whole.substr(F.lit(12), F.length(whole) - 11))).otherwise(whole)
    root = scratch_path(spark, "replicas")
    warc.write_warc(rows, root, [whole, F.when(
        F.coalesce(F.pmod("key", F.lit(101)) != 5, F.lit(True)), damaged)])
    found = warc.fixity(warc.index_of(rows), warc.read_warc(spark, f"{root}/replica=0"),
                        warc.read_warc(spark, f"{root}/replica=1"))
    return found.select(F.col("key").alias("page_id"), "file", "offset", "length", "status")


@query
def op5_substring_dedup(spark, folder):
    return substring_dedup.drop_repeats(read(spark, folder, "documents")).drop("kept_text")


@query
def op6_html_text(spark, folder):
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op7_decontamination(spark, folder):
    return decontamination.flag(read(spark, folder, "documents"),
                                read(spark, folder, "benchmark"))


@query
def op8_url_filters(spark, folder):
    """Pages are labelled through the document of the same number: bad when its
    quality is 0 or it is toxic."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = read(spark, folder, "labels").select(F.col("doc_id").alias("page_id"),
                                                    bad.alias("bad"))
    return url_filters.judge_urls(read(spark, folder, "pages"), outcomes, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.round("mean", 6).alias("mean"),
        F.round("bound", 6).alias("bound"))


@query
def op9_language_model(spark, folder):
    docs = read(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    model, rest = language_model.fit(docs.where(~held_out))
    return language_model.score(docs, model, rest, held_out)


@query
def op10_exact_dedup(spark, folder):
    found = exact_dedup.exact_groups(read(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def grafted_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with its first h turns taken from conversation c - c % 5, where h
    is crc32 of c's decimal digits modulo 9; and all conversations."""
    c = F.col("conv")
    sizes = turns.groupBy("conv").agg(F.count("*").alias("size"))
    plan = sizes.select("conv", (c - c % 5).alias("base"),
                        (F.crc32(c.cast("string").cast("binary")) % 9).alias("h"))
    given = sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    plan = cut(plan.join(given, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_size", F.lit(0).cast("bigint")))), "grafts")
    own = turns.join(plan, "conv").where("idx >= h").select(
        "conv", (F.col("idx") - F.col("h") + F.col("taken")).alias("idx"), "digest", "n_bytes")
    heads = turns.where("idx < 9").withColumnRenamed("conv", "base")
    lent = heads.join(plan, "base").where("idx < h").select("conv", "idx", "digest", "n_bytes")
    return own.unionByName(lent), plan.select("conv")


@query
def op11_conversation_trie(spark, folder):
    turns = cut(conversation_trie.ordered_turns(read(spark, folder, "conversations")), "turns")
    return conversation_trie.prefix_trie(*grafted_turns(turns))


@query
def op12_fingerprints(spark, folder):
    return fingerprints.compare_with_edits(read(spark, folder, "documents"))


@query
def op13_vector_codes(spark, folder):
    coded, books = vector_codes.compress(read(spark, folder, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

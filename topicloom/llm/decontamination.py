"""Benchmark decontamination by template windows, with DataFrame functions only.

Numbers, units and names in texts become typed placeholders, token for token; the rest
is lower-cased. A window is ``window`` consecutive tokens of the template. Windows of
documents meet windows of benchmark items in a hash join. Aligned matches of one
document and item are then checked slot by slot: each value that the item holds must
stand for one value in the document. So a copied passage is found, and also a question
that was asked again with other numbers and names, but not a passage that fits a
template by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .sharing import fresh, if_small

WINDOW = 10
# So many tokens of a window must be words, not placeholders.
LITERAL = 6

# Fixed patterns of the template.
NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
UNITS = ("mm|cm|dm|km|mg|kg|ml|cl|dl|kwh|kw|mhz|ghz|hz|mph|metres?|meters?|kilometres?|kilometers?|"
         "miles?|feet|foot|inch(?:es)?|grams?|kilograms?|tons?|tonnes?|pounds?|litres?|liters?|"
         "seconds?|minutes?|hours?|days?|weeks?|months?|years?|dollars?|euros?|cents?|percent|"
         "degrees?|m|g|l|s|h")
SPACE = r"[\x20\x09-\x0D]+"
SLOT = "<(?:name|n|unit)>"


def tokens(text: Column) -> Column:
    """Runs other than space and \\x09-\\x0D; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda t: t != "")


def template(text: Column) -> Column:
    """The text with placeholders. It has as many tokens as the text.

    A name is a capitalised token inside a sentence: one space after a character that
    ends no sentence.
    """
    c = F.regexp_replace(text, r"(?<=[^.!?:;\s]\s)\p{Lu}[\p{L}'’-]*", "<name>")
    c = F.regexp_replace(c, NUMBER, "<n>")
    c = F.regexp_replace(c, rf"(?i)(?<=<n>[\x20-]?)(?:{UNITS})(?![\p{{L}}\p{{N}}])", "<unit>")
    return F.lower(c)


def _windows(template_tokens: Column, size: int) -> Column:
    """Hashes of all windows, in order; none if there are fewer tokens."""
    last = F.size(template_tokens) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.xxhash64(
        F.slice(template_tokens, k + 1, size)))).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, key: str, text: str, window: int, literal: int) -> DataFrame:
    """(item, at, size, hash, tokens, raw) for the windows of ``items``.

    An item shorter than a window is one window, if it has ``literal`` words at all.
    """
    rows = items.select(F.col(key).alias("item"), tokens(F.col(text)).alias("raw"),
                        tokens(template(F.col(text))).alias("template"))
    size = F.least(F.size("raw"), F.lit(window))
    rows = rows.withColumn("size", size).where("size > 0")
    starts = F.explode(F.sequence(F.lit(0), F.size("raw") - F.col("size")))
    cutouts = rows.withColumn("at", starts).select(
        "item", "at", "size", F.slice("template", F.col("at") + 1, F.col("size")).alias("tokens"),
        F.slice("raw", F.col("at") + 1, F.col("size")).alias("raw"))
    words = F.size(F.filter("tokens", lambda t: ~t.rlike(SLOT)))
    return cutouts.where(words >= literal).withColumn("hash", F.xxhash64("tokens"))


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
                 literal: int = LITERAL) -> DataFrame:
    """(key, item, windows, verbatim) for each document and item that it holds a part of.

    ``windows`` counts the matched windows on consistent alignments, ``verbatim`` is true
    when one of them has equal slots throughout. Rows that repeat with their key are one
    document; documents or items that are null, empty or without key match nothing.
    The windows of the benchmark are broadcast while their counted rows are small, else
    documents' windows are shuffled to them.
    """
    bench = cut(item_windows(items.where(F.col(item_key).isNotNull()), item_key, item_text,
                             window, literal), "bench-windows")
    sizes = sorted(r[0] for r in bench.select("size").distinct().collect())
    wanted = cut(bench.select("size", "hash").distinct(), "bench-hashes")
    texts = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    canonical = texts.select("doc", tokens(template(F.col("text"))).alias("template"))
    found = None
    for size in sizes:
        windows = canonical.select("doc", F.posexplode(_windows(F.col("template"), size)).alias(
            "at", "hash"))
        hit = windows.join(if_small(wanted.where(F.col("size") == size).select("hash"), 16),
                           "hash", "left_semi").withColumn("size", F.lit(size))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return docs.select(F.col(key)).where(F.lit(False)).select(
            key, F.lit(None).cast(items.schema[item_key].dataType).alias("item"),
            F.lit(0).cast("bigint").alias("windows"), F.lit(True).alias("verbatim"))
    places = cut(found.groupBy("doc").agg(F.collect_set(F.struct("at", "size", "hash")).alias("at")),
                 "places")
    # Slots come from the texts of documents with a match; there the windows are compared whole.
    seen = texts.join(if_small(places, 512), "doc").select(
        "doc", "at", tokens(F.col("text")).alias("raw"),
        tokens(template(F.col("text"))).alias("template"))
    seen = seen.select("doc", F.explode("at").alias("p"), "raw", "template").select(
        "doc", F.col("p.at").alias("doc_at"), F.col("p.hash").alias("hash"),
        F.slice("template", F.col("p.at") + 1, F.col("p.size")).alias("doc_tokens"),
        F.slice("raw", F.col("p.at") + 1, F.col("p.size")).alias("doc_raw"))
    met = seen.join(bench, "hash").where(F.col("doc_tokens") == F.col("tokens"))
    slots = F.filter(F.arrays_zip(F.col("tokens").alias("t"), F.col("raw").alias("i"),
                                  F.col("doc_raw").alias("d")),
                     lambda s: s["t"].rlike(SLOT))
    pairs = F.transform(slots, lambda s: F.struct(F.lower(s["i"]).alias("i"),
                                                  F.lower(s["d"]).alias("d")))
    aligned = met.select("doc", "item", (F.col("doc_at") - F.col("at")).alias("shift"),
                         F.col("at"), pairs.alias("pairs")).groupBy("doc", "item", "shift").agg(
        F.count_distinct("at").alias("windows"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"])))
    return (aligned.where(F.size("pairs") == values).groupBy("doc", "item").agg(
        F.sum("windows").alias("windows"),
        F.max(F.forall("pairs", lambda p: p["i"] == p["d"])).alias("verbatim"))
        .withColumnRenamed("doc", key))


def flag(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
         **options) -> DataFrame:
    """(key, kept, items, reworded) per distinct key of ``docs``.

    ``items`` are the benchmark items in order that the document holds a part of,
    ``reworded`` is true when all of them only with other slots; ``kept`` is true without
    items. A null key is kept.
    """
    hits = contaminated(docs, items, key, text, **options).groupBy(F.col(key).alias("k")).agg(
        F.sort_array(F.collect_set("item")).alias("items"),
        (~F.max("verbatim")).alias("reworded"))
    return docs.select(key).distinct().join(hits, F.col(key) == F.col("k"), "left").select(
        key, F.col("k").isNull().alias("kept"),
        F.coalesce("items", F.array().cast(hits.schema["items"].dataType)).alias("items"),
        F.coalesce("reworded", F.lit(False)).alias("reworded"))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` that hold no part of an item, with all their columns."""
    hit = fresh(docs, "_hit")
    hits = cut(contaminated(docs, items, key, text, **options).select(F.col(key).alias(hit))
               .distinct(), "contaminated")
    return docs.join(if_small(hits, 16), F.col(key) == F.col(hit), "left_anti")

"""Language of a text, from character trigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .ranking import top_k


def letters_only(text: Column) -> Column:
    """The lowered text between spaces; whatever is not a letter counts as one space."""
    letters = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    return F.concat(F.lit(" "), letters, F.lit(" "))


def trigrams(letters: Column) -> Column:
    """Every run of three characters. A look-ahead finds overlapping runs in one
    pass; a text without a letter has none."""
    return F.regexp_extract_all(letters, F.lit("(?=(...))"), F.lit(1))


def gram_counts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, gram, n): how often each trigram occurs in a text, counted inside its row."""
    grams = trigrams(letters_only(F.col(text)))
    sorted_ = df.select(*keys, F.array_sort(grams).alias("grams"))
    # Runs of equal grams in the sorted list: where each starts, and where the next does.
    starts = F.filter(F.transform("grams", lambda g, k: F.when(
        (k == 0) | (g != F.get("grams", k - 1)), k)), lambda k: k.isNotNull())
    runs = sorted_.select(*keys, "grams", starts.alias("starts"))
    counted = F.transform("starts", lambda s, k: F.struct(
        F.get("grams", s).alias("gram"), (F.coalesce(F.get("starts", k + 1), F.size("grams")) - s)
        .cast("bigint").alias("n")))
    return runs.select(*keys, F.inline(counted))


def language_profiles(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, gain, base): what a trained language says about a trigram.

    All trigrams of its texts, with add-one smoothed log probabilities: ``base`` for a
    trigram it never showed, and ``gain`` on top for one it did. Rows without a
    language teach nothing.
    """
    known = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), text)
    counts = cut(gram_counts(known, ["lang"], text).groupBy("lang", "gram").agg(
        F.sum("n").alias("n")), "profiles")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("grams"))
    return counts.join(totals, "lang").select(
        "lang", "gram", F.log(F.col("n") + 1.0).alias("gain"),
        (-F.log(F.col("total") + F.col("grams").cast("double"))).alias("base"))


def language_id(df: DataFrame, doc: str, text: str, profiles: DataFrame) -> DataFrame:
    """(doc, language, score): the best-scored language per text.

    The score is the mean log probability of the text's trigrams. Ties go by
    language name. Texts without a known trigram get a null language.
    """
    profiles = cut(profiles, "profiles")
    bases = profiles.select("lang", "base").distinct()
    seen = gram_counts(df.select(doc, text), [doc], text)
    lengths = df.select(doc, (F.length(letters_only(F.col(text))) - 2).alias("length"))
    # A gram outside a profile adds nothing to the base score.
    gains = (seen.join(profiles.select("lang", "gram", "gain"), "gram").groupBy(doc, "lang")
             .agg(F.sum(F.col("gain") * F.col("n")).alias("gain")))
    scored = gains.join(lengths, doc).join(bases, "lang").select(
        doc, "lang", F.round(F.col("base") + F.col("gain") / F.col("length"), 6).alias("score"))
    best = top_k(scored, [doc], [F.desc("score"), F.asc("lang")], 1).drop("rank")
    return (df.select(doc).join(best, doc, "left")
            .select(doc, F.col("lang").alias("language"), "score"))


def drop_unknown_language(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with a null in any of the language columns."""
    return df.dropna(subset=list(columns))

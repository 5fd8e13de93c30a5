"""TF-IDF terms per group: what a cluster's documents are about."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import counted, is_blank, tokens, without
from ..session import cut
from .ranking import top_k

# --- Fixed values: they decide results and must stay as they are. -------------
EXTRA_STOP_WORDS = [
    "type", "text", "article", "pdf", "application", "identifier", "journal",
    "report", "paper", "source", "bulletin", "表紙", "裏表紙", "目次", "奥付",
    "論文", "特集", "記事", "編集後記", "会告", "概要", "summary", "study",
    "results", "method", "analysis", "introduction", "conclusion", "abstract",
    "vol", "no", "pp", "http", "https", "handle", "jp", "en", "dataset", "1", "2",
    "3", "p", "s", "c", "4", "8", "18", "12",
]
MAX_FEATURES = 5000
TOP_TERMS = 10
NO_TEXT_TERM = "placeholdertext"
# ------------------------------------------------------------------------------


def stop_words(extra: Sequence[str] = tuple(EXTRA_STOP_WORDS),
               language: str = "english") -> list[str]:
    return sorted(set(StopWordsRemover.loadDefaultStopWords(language)) | set(extra))


def document_terms(df: DataFrame, text: str, keep: Sequence[str],
                   drop_words: Sequence[str] = ()) -> DataFrame:
    """One row per (document, term) with its count; each row is a document."""
    words = without(tokens(F.col(text)), drop_words)
    return (df.select(*keep, F.explode(counted(words)).alias("t"))
            .select(*keep, F.col("t.term").alias("term"), F.col("t.tf").alias("tf")))


def token_counts(df: DataFrame, group: str, text: str) -> DataFrame:
    """Occurrences and documents of every term, per group."""
    return (document_terms(df, text, [group]).groupBy(group, "term")
            .agg(F.sum("tf").alias("occurrences"), F.count("*").alias("documents")))


def tfidf_terms(df: DataFrame, group: str, doc: str, text: str, top_n: int = TOP_TERMS,
                max_features: int = MAX_FEATURES,
                drop_words: Sequence[str] | None = None) -> DataFrame:
    """The ``top_n`` terms of every group by summed, length-normalised TF-IDF.

    Returns (group, rank, term, score). ``doc`` must be unique. A text is taken apart once:
    each document's counts are written as one row, and read for the totals and for the
    weights. What shuffles is (group, term) totals, reduced before they leave a task, and
    the counts of kept terms, once, by document.
    """
    drop_words = stop_words() if drop_words is None else drop_words
    texts = df.select(group, doc, text).where(~is_blank(F.col(text)))
    listed = cut(texts.select(group, doc, counted(without(tokens(F.col(text)), drop_words))
                              .alias("t")), "terms")
    terms = listed.select(group, doc, F.explode("t").alias("t")).select(
        group, doc, F.col("t.term").alias("term"), F.col("t.tf").alias("tf"))

    totals = (terms.groupBy(group, "term")
              .agg(F.sum("tf").alias("total"), F.count("*").alias("df")))
    sizes = listed.groupBy(group).agg(F.count("*").alias("n"))
    vocabulary = top_k(totals, [group], [F.desc("total"), F.asc("term")], max_features,
                       rank="_r", salt=F.col("term")).drop("_r")
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    # At most max_features rows per group. Written, because its size decides the join.
    weights = cut(vocabulary.join(sizes, group).select(group, "term", idf.alias("idf")),
                  "vocabulary")

    weighted = (terms.join(weights, [group, "term"])
                .select(group, doc, "term", (F.col("tf") * F.col("idf")).alias("x")))
    # At most max_features rows per document.
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(group, doc)))
    scores = (weighted.select(group, "term", (F.col("x") / norm).alias("share"))
              .groupBy(group, "term").agg(F.round(F.sum("share"), 6).alias("score")))
    return (top_k(scores, [group], [F.desc("score"), F.asc("term")], top_n)
            .select(group, "rank", "term", "score"))

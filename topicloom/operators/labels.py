"""Names for clusters: keywords, prompts, model answers, label joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_answer
from ..session import cut
from ..sources.tables import require_columns
from .density import NOISE
from .ranking import top_k
from .tfidf import MAX_FEATURES, NO_TEXT_TERM, TOP_TERMS, tfidf_terms

# --- Fixed values: they decide results and must stay as they are. -------------
NAME_TERMS = 3
NAME_SEPARATOR = " / "
MODEL_LABEL_MIN_SIZE = 500
SUMMARY_TEXTS = 5
DEFAULT_MERGED_NAME = "General"
MERGE_NAMES = 200  # names in a prompt for a merged group, ours

LABEL_PROMPT = """You are a research topic summarizer.
The following keywords describe a scientific topic cluster:
%s
Return only a concise 2–4 word topic name."""
SUMMARY_PROMPT = """Summarize the following research abstracts in one concise sentence:
%s
Return only the summary."""
MERGE_PROMPT = """You are an expert research topic summarizer.
Below are names of related clusters:
%s

%s

Suggest a concise 2–4 word topic name that represents them all.
Examples: 'Cancer Genomics', 'Climate Studies', 'Language Modeling'.
Only output the name."""
# ------------------------------------------------------------------------------


def cluster_info(df: DataFrame, cluster: str, doc: str, text: str, top_n: int = TOP_TERMS,
                 max_features: int = MAX_FEATURES,
                 drop_words: Sequence[str] | None = None) -> DataFrame:
    """(cluster, keywords, name, summary, size), one row per cluster but noise."""
    texts = df.where((F.col(cluster) != NOISE) & F.col(text).isNotNull())
    sizes = texts.groupBy(cluster).agg(F.count("*").alias("size"))
    terms = tfidf_terms(texts, cluster, doc, text, top_n, max_features, drop_words)
    listed = terms.groupBy(cluster).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                    lambda t: t["term"]).alias("_terms"))
    keywords = F.coalesce("_terms", F.array(F.lit(NO_TEXT_TERM)))
    return sizes.join(listed, cluster, "left").select(
        cluster, keywords.alias("keywords"),
        F.concat_ws(NAME_SEPARATOR, F.slice(keywords, 1, NAME_TERMS)).alias("name"),
        F.lit("").alias("summary"), "size")


def label_docs(df: DataFrame, info: DataFrame, cluster: str) -> DataFrame:
    """Add name and summary to documents; noise keeps nulls.

    One row of ``info`` per cluster. It is written, so the optimizer knows its bytes and
    broadcasts it only when small; else the join is by key, and adaptive execution
    splits a crowded cluster.
    """
    return df.join(cut(info.select(cluster, "name", "summary"), "names"), cluster, "left")


def unlabelled(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce("name", F.lit("")) == "")


def relabel(df: DataFrame, cluster: str, doc: str, text: str, **options) -> DataFrame | None:
    """Label again when some clustered row has no name; None when all have one.

    Noise has no name by nature and does not count.
    """
    require_columns(df, cluster)
    if unlabelled(df.where(F.col(cluster) != NOISE)).isEmpty():
        return None
    bare = df.drop("name", "summary")
    return label_docs(bare, cluster_info(bare, cluster, doc, text, **options), cluster)


def first_texts(df: DataFrame, cluster: str, order: Sequence[str], text: str,
                n: int = SUMMARY_TEXTS) -> DataFrame:
    """(cluster, texts): the first ``n`` texts of each cluster, one per line."""
    first = top_k(df.where((F.col(cluster) != NOISE) & F.col(text).isNotNull())
                  .select(cluster, *order, text), [cluster], [F.asc(c) for c in order], n)
    return first.groupBy(cluster).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", text))),
                                 lambda t: t[text]), "\n").alias("texts"))


def prompt_table(info: DataFrame, texts: DataFrame, cluster: str) -> DataFrame:
    """The label and the summary prompt of every cluster."""
    return info.join(texts, cluster, "left").select(
        cluster, "size",
        F.format_string(LABEL_PROMPT, F.array_join("keywords", ", ")).alias("label_prompt"),
        F.format_string(SUMMARY_PROMPT, F.coalesce("texts", F.lit(""))).alias("summary_prompt"))


PROMPTS_PER_CALL = 32


def ask(df: DataFrame, prompt: str, out: str,
        model: Callable[[], Callable[[list[str]], list[str | None]]],
        error: str | None = None) -> DataFrame:
    """Append a model's answers, batch by batch.

    ``model`` is called once per task and returns the function that answers a
    list of prompts. Prompts go in lists of ``PROMPTS_PER_CALL``; when a call fails,
    its prompts are sent one by one, and one that fails by itself is answered with
    null. ``error``, if given, names a column for what went wrong. Null prompts are
    not sent.
    """
    kept = df.select("*", F.lit(None).cast("string").alias(out),
                     F.lit(None).cast("string").alias("_error"))

    def one_by_one(answer, prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            return [(said, None) for said in answer(prompts)]
        except Exception as error:  # a failed call means no answer, not a failed job
            if len(prompts) == 1:
                return [(None, f"{type(error).__name__}: {error}")]
            return [said for p in prompts for said in one_by_one(answer, [p])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = model()
        for pdf in batches:
            wanted = pdf.index[pdf[prompt].notna()]
            pdf[out] = None
            pdf["_error"] = None
            for start in range(0, len(wanted), PROMPTS_PER_CALL):
                rows = wanted[start:start + PROMPTS_PER_CALL]
                said = one_by_one(answer, pdf.loc[rows, prompt].tolist())
                pdf.loc[rows, out] = [s for s, _ in said]
                pdf.loc[rows, "_error"] = [e for _, e in said]
            yield pdf

    answered = df.mapInPandas(run, kept.schema)
    answered = answered.withColumnRenamed("_error", error) if error else answered.drop("_error")
    return answered.withColumn(out, F.nullif(clean_answer(F.col(out)), F.lit("")))


def name_with(info: DataFrame, prompts: DataFrame, cluster: str, model,
              min_size: int = MODEL_LABEL_MIN_SIZE, summaries: bool = True) -> DataFrame:
    """Let a model name the large clusters and summarise all of them."""
    asked = info.drop("summary").join(prompts.drop("size"), cluster).withColumn(
        "label_prompt", F.when(F.col("size") >= min_size, F.col("label_prompt")))
    asked = ask(asked, "label_prompt", "_name", model)
    if summaries:
        asked = ask(asked, "summary_prompt", "_summary", model)
    else:
        asked = asked.withColumn("_summary", F.lit(None).cast("string"))
    return asked.select(cluster, "keywords", F.coalesce("_name", "name").alias("name"),
                        F.coalesce("_summary", F.lit("")).alias("summary"), "size")


def merged_names(members: DataFrame, group: str, name: str = "name") -> DataFrame:
    """(group, name): the most frequent words of the members' names.

    Words count once per occurrence, ties go by word; ``General`` when none.
    """
    groups = members.select(group).distinct()
    words = (members.select(group, F.explode(F.split(name, " ")).alias("word"))
             .where("word NOT IN ('', '/')"))
    counts = words.groupBy(group, "word").agg(F.count("*").alias("n"))
    best = top_k(counts, [group], [F.desc("n"), F.asc("word")], NAME_TERMS)
    named = best.groupBy(group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))),
                                 lambda w: w["word"]), NAME_SEPARATOR).alias("_name"))
    return groups.join(named, group, "left").select(
        group, F.coalesce("_name", F.lit(DEFAULT_MERGED_NAME)).alias("name"))


def merge_prompts(members: DataFrame, group: str, name: str = "name",
                  most: int = MERGE_NAMES) -> DataFrame:
    """(group, prompt): member names and their words, for a model that names groups.

    A prompt lists at most ``most`` names, in the order of names; a group has as many as it
    has members, which no model could read.
    """
    few = top_k(members.where(F.col(name).isNotNull()).select(group, name), [group],
                [F.asc(name)], most, salt=F.col(name))
    listed = members.select(group).distinct().join(few.groupBy(group).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", name))), lambda n: n[name]).alias("names")),
        group, "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
    words = F.flatten(F.transform("names", lambda n: F.split(n, " ")))
    keywords = F.when(F.size(words) > 0,
                      F.concat(F.lit("Keywords: "), F.array_join(words, ", "))).otherwise("")
    return listed.select(group, F.format_string(
        MERGE_PROMPT, F.array_join("names", ", "), keywords).alias("prompt"))


def model_namer(model, most: int = MERGE_NAMES):
    """A namer for the merge ladder that asks ``model`` (see `ask`); a group without an answer
    is called ``General``."""
    def namer(members: DataFrame, group: str, name: str = "name") -> DataFrame:
        answered = ask(merge_prompts(members, group, name, most), "prompt", "_answer", model)
        return cut(answered.select(group, F.coalesce("_answer", F.lit(DEFAULT_MERGED_NAME))
                                   .alias("name")), "answers")
    return namer


def run_metadata(labels: DataFrame, cluster: str, best_config: str = "{}",
                 use_model: bool = False) -> DataFrame:
    """One row about a run: clusters, outliers, configuration, time."""
    c = F.col(cluster)
    return labels.agg(
        F.count_distinct(F.when(c != NOISE, c)).alias("n_clusters"),
        F.count_if(c == NOISE).alias("n_outliers")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit(best_config).alias("best_config"), "n_clusters", "n_outliers",
        F.lit(use_model).alias("use_model"))

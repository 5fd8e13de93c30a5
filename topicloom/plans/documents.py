"""From record files to clean, classified, embedded documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import text as X
from ..functions.vectors import hash_embed
from ..operators.language import drop_unknown_language, language_id
from ..operators.ranking import ordinal
from ..session import cut
from ..sources.records import PATTERN, extract_record, sample_files, scan_files
from ..streaming.ingest import FILES_PER_BATCH, ingest


def extract_documents(spark: SparkSession, root: str, out: str, checkpoint: str,
                      pattern: str = PATTERN, record_end: str | None = None,
                      files_per_batch: int = FILES_PER_BATCH, max_docs: int | None = None,
                      seed: int = 42) -> DataFrame:
    """Record files to a Parquet table of raw documents; run again for new files.

    With ``max_docs`` a repeatable sample of so many files is read, in batches of
    ``files_per_batch``. A batch is one append to the table, so after a crash those that are
    there are skipped and the rest follow.
    """
    if max_docs is None:
        ingest(spark, root, out, checkpoint, pattern=pattern, record_end=record_end,
               files_per_batch=files_per_batch)
    else:
        extract_sample(spark, root, out, max_docs, seed, pattern, record_end, files_per_batch)
    return spark.read.parquet(out)


def extract_sample(spark: SparkSession, root: str, out: str, max_docs: int, seed: int = 42,
                   pattern: str = PATTERN, record_end: str | None = None,
                   files_per_batch: int = FILES_PER_BATCH) -> int:
    """Append the records of at most ``max_docs`` sampled files; returns the batches written.

    The names of the sample, at most ``max_docs``, go through the driver. Files of which the
    table already holds records are not read again.
    """
    chosen = sample_files(spark, root, max_docs, seed, pattern)
    try:
        done = spark.read.parquet(out).select("file").distinct()
        chosen = chosen.join(done, "file", "left_anti")
    except AnalysisException:  # no table yet
        pass
    names = sorted(r["file"] for r in chosen.collect())
    for start in range(0, len(names), files_per_batch):
        found = scan_files(spark, names[start:start + files_per_batch], pattern, record_end)
        extract_record(found, "file", "xml").write.mode("append").parquet(out)
    if not names and max_docs == 0:
        extract_record(scan_files(spark, root, pattern, record_end).limit(0), "file", "xml"
                       ).write.mode("append").parquet(out)
    return -(-len(names) // files_per_batch)


def numbered(raw: DataFrame, start: int = 0, out: str = "doc_id") -> DataFrame:
    """Number the documents from ``start``, in the order of file and content.

    The same table gets the same numbers however it is partitioned; a later batch goes on
    from the end of the one before. Rows that repeat get a number each.
    """
    content = F.sha2(F.concat_ws("\u0000", F.coalesce("title", F.lit("")),
                                 F.coalesce("abstract", F.lit(""))), 256)
    placed = ordinal(raw.withColumn("_content", content), ["file", "_content"], out, start)
    return placed.drop("_content")


def add_languages(df: DataFrame, profiles: DataFrame, doc: str = "doc_id", title: str = "title",
                  abstract: str = "clean_abstract", drop_unknown: bool = False) -> DataFrame:
    """Append title_lang and abstract_lang by the trigram ``profiles`` (see `language_profiles`);
    null where nothing tells the language. With ``drop_unknown`` such rows are dropped."""
    for text, out in ((title, "title_lang"), (abstract, "abstract_lang")):
        found = language_id(df, doc, text, profiles).select(
            F.col(doc).alias("_doc"), F.col("language").alias(out))
        df = df.join(found, F.col(doc) == F.col("_doc"), "left").drop("_doc")
    return drop_unknown_language(df, "title_lang", "abstract_lang") if drop_unknown else df


def drop_empty(df: DataFrame, title: str = "title", abstract: str = "abstract") -> DataFrame:
    """Nulls become '', and rows with neither title nor abstract are dropped."""
    df = df.withColumns({title: X.text_or_empty(F.col(title)),
                         abstract: X.text_or_empty(F.col(abstract))})
    return df.where(~(X.is_blank(F.col(title)) & X.is_blank(F.col(abstract))))


def clean(df: DataFrame, abstract: str = "abstract", out: str = "clean_abstract",
          entities: bool = True) -> DataFrame:
    return df.withColumn(out, X.clean_markup(F.col(abstract), entities))


def classify(df: DataFrame, title: str = "title", out: str = "type",
             types: Mapping[str, str] = X.DOCUMENT_TYPES,
             default: str = X.DEFAULT_TYPE) -> DataFrame:
    return df.withColumn(out, X.document_type(F.col(title), types, default))


def drop_boilerplate(df: DataFrame, text: str = "clean_abstract",
                     words: Sequence[str] = tuple(X.BOILERPLATE_WORDS)) -> DataFrame:
    """Drop rows whose text starts with a boilerplate word."""
    return df.where(~X.starts_with_word(F.col(text), words))


def document_text(df: DataFrame, title: str = "title", abstract: str = "clean_abstract",
                  sep: str = " ", out: str = "text") -> DataFrame:
    """Title and abstract as one text: sep ' ' to embed, '. ' to name clusters."""
    return df.withColumn(out, X.joined(F.col(title), F.col(abstract), sep=sep))


def embed(df: DataFrame, title: str = "title", abstract: str = "clean_abstract",
          out: str = "embedding") -> DataFrame:
    return df.withColumn(out, hash_embed(X.joined(F.col(title), F.col(abstract), sep=" ")))


class Funnel:
    """Row counts per stage, taken while the stages run; no job of their own."""

    def __init__(self):
        self.stages: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        seen = Observation(stage)
        self.stages.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def counts(self) -> list[tuple[int, str, int]]:
        """(position, stage, rows), once an action has run."""
        return [(k, stage, seen.get["n"]) for k, (stage, seen) in enumerate(self.stages)]


def prepare_documents(raw: DataFrame, embedder=embed, funnel: Funnel | None = None,
                      **classes) -> DataFrame:
    """The whole chain, lazy and without a shuffle: every step works on its row.

    Boilerplate goes before the embedding, so a costly model never sees it.
    Rows of other types than the default one carry no embedding.
    """
    watch = funnel.watch if funnel else (lambda df, _: df)
    df = watch(raw, "loaded")
    df = watch(drop_empty(df), "not_empty")
    df = classify(clean(df), **classes)
    df = watch(df.where(F.col("type") == classes.get("default", X.DEFAULT_TYPE)), "papers")
    df = watch(drop_boilerplate(df), "kept")
    return embedder(df)


def run(raw: DataFrame, out: str, embedder=embed, start: int = 0,
        profiles: DataFrame | None = None, drop_unknown: bool = False, **classes) -> None:
    """Write embedded papers and all other documents to two folders of ``out``.

    Documents are numbered in ``doc_id``, from ``start``, before anything is dropped. With
    language ``profiles`` papers carry the languages of title and abstract.
    """
    default = classes.get("default", X.DEFAULT_TYPE)
    if "doc_id" not in raw.columns:
        raw = cut(numbered(raw, start), "numbered")
    if profiles is None:
        papers = prepare_documents(raw, embedder, **classes)
    else:
        # Languages before the embedding, so that a costly model sees only what stays.
        plain = cut(prepare_documents(raw, lambda df: df, **classes), "prepared")
        papers = embedder(add_languages(plain, profiles, drop_unknown=drop_unknown))
    papers.write.parquet(f"{out}/papers")
    (classify(clean(drop_empty(raw)), **classes).where(F.col("type") != default)
     .write.partitionBy("type").parquet(f"{out}/other"))

"""Text expressions against Python's own re and html modules."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from topicloom.functions import text as X
from topicloom.plans import documents as D

# What each text becomes when it is cleaned.
CLEANED = [
    (None, ""), ("", ""), ("   ", ""), ("\u00a0\u3000", ""), ("plain", "plain"),
    ("a\u2028b\u3000\u00a0 c\x85d\x1ce", "a b c d e"),
    (r"\"u and \"9", r"u and \"9"), (r"it\'s", "its"),
    ("$a$ and $b\nc$ d$", "a and $b c d"), (r"\emph{x} \frac{a}{b}", "x a{b}"),
    (r"\begin{eq}x\end{eq}", "eqxeq"), (r"\alpha\beta", ""),
    ("``quoted'' 'single'", "\"quoted\" 'single'"), ("<p>one</p><br/>two", "one two"),
    ("a < b", "a < b"), ("<<a>>", ">"), ("&amp;lt; &lt;b&gt;", "&lt; <b>"),
    ("&ampfoo; &notit; &copy", "&foo; \u00acit; \u00a9"),
    ("&#233; &#xe9; &#150; &#0; &nosuch;", "\u00e9 \u00e9 \u2013 \ufffd &nosuch;"),
    ("&eacute;t&eacute; &hellip; &nbsp;x", "\u00e9t\u00e9 \u2026 x"), ("trailing \n\t ", "trailing"),
    (r"\textbf{\emph{deep}}", "{deep}"), ("&", "&"), ("&&amp;", "&&"),
]
EDGES = [text for text, _ in CLEANED]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(list(enumerate(EDGES)), "n int, t string")


def by_number(df, column):
    return [row[column] for row in df.orderBy("n").collect()]


def test_clean_markup(edges):
    got = by_number(edges.select("n", X.clean_markup(F.col("t")).alias("c")), "c")
    assert got == [clean for _, clean in CLEANED]


def test_strip_and_blank(edges):
    got = edges.select("n", X.strip(F.col("t")).alias("s"), X.is_blank(F.col("t")).alias("b"))
    assert by_number(got, "s") == [t if t is None else t.strip() for t in EDGES]
    assert by_number(got, "b") == [not (t or "").strip() for t in EDGES]


def test_tokens_and_counts(edges):
    got = edges.where("t IS NOT NULL").select("t", X.tokens(F.col("t")).alias("w"),
                                              X.counted(X.tokens(F.col("t"))).alias("c"))
    for row in got.collect():
        words = re.findall(r"\w+", row["t"].lower())
        assert row["w"] == words
        assert {c["term"]: c["tf"] for c in row["c"]} == {w: words.count(w) for w in words}


@pytest.mark.parametrize("title,kind", [
    (None, "unknown"), ("LHD #1234", "diagnostic_report"), ("lhd12", "diagnostic_report"),
    ("An LHD bolometer run", "diagnostic_report"), ("lhd bolometers", "scientific_paper"),
    ("xlhd 12", "scientific_paper"), ("LHD\u3000ece", "diagnostic_report"),
    ("  ", "scientific_paper"), ("the lhd", "scientific_paper"),
])
def test_document_type(spark, title, kind):
    df = spark.createDataFrame([(title,)], "title string")
    assert df.select(X.document_type(F.col("title"))).first()[0] == kind


def test_boilerplate(spark):
    texts = ["type:text", "Text", "textual", "論文 x", "論文x", "a text", "", "application/pdf"]
    df = spark.createDataFrame([(t,) for t in texts], "clean_abstract string")
    kept = {row[0] for row in D.drop_boilerplate(df).collect()}
    pattern = re.compile(r"(?:%s)\b" % "|".join(X.BOILERPLATE_WORDS), re.IGNORECASE)
    assert kept == {t for t in texts if not pattern.match(t)}


def test_answers(spark):
    answers = [("<think>a</think> b ", "b"), ("b", "b"), ("<think>x", "x"),
               ("a</think>b</think>\n c", "c"), (" \u3000", "")]
    df = spark.createDataFrame([(t,) for t, _ in answers], "t string")
    got = [row[0] for row in df.select(X.clean_answer(F.col("t"))).collect()]
    assert got == [clean for _, clean in answers]


def test_preparation_needs_no_shuffle_and_no_python_for_plain_text(spark, small):
    raw = spark.read.parquet(f"{small}/documents.parquet").select(
        F.col("source").alias("title"), F.col("text").alias("abstract"))
    plan = D.prepare_documents(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

"""Queries against DuckDB, and against brute force where SQL has no words."""

from __future__ import annotations

import collections
import hashlib
import html
import math
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle_check import compare, connect

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def con(medium):
    return connect(medium)


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()


@pytest.mark.parametrize("name", ["op3_mixing", "op8_url_filters", "op10_exact_dedup"])
def test_equals_sql(spark, con, medium, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], medium) == []


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_near_dedup_equals_all_pairs(spark, texts, medium):
    sets = {k: shingles(t) for k, t in texts}
    where = collections.defaultdict(list)
    for k, s in sets.items():
        for g in s:
            where[g].append(k)
    both = collections.Counter((a, b) for ks in where.values() for b in ks for a in ks if a < b)
    root = {k: k for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for (a, b), n in both.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    want = {(k, len(s), top(k), top(k) == k) for k, s in sets.items()}
    got = entry.queries()["op1_near_dedup"](spark, medium)
    assert {tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept")
            .collect()} == want


def test_language_held_out_accuracy(spark, medium):
    truth = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang")
    got = entry.queries()["op2_language_id"](spark, medium).join(truth, "doc_id")
    n, held, right = got.agg(F.count("*"), F.sum(F.col("held_out").cast("int")), F.sum(
        (F.col("held_out") & (F.col("lang") == F.col("lang_pred"))).cast("int"))).first()
    assert n == 1000 and right >= 0.98 * held
    assert got.where("score < 0 OR score > 1 OR held_out <> (crc32(cast(doc_id AS string)) % 4 = 2)"
                     ).isEmpty()


def test_fixity_finds_exactly_the_damage(spark, medium):
    for r in entry.queries()["op4_warc_fixity"](spark, medium).collect():
        want = ("missing" if r.page_id % 101 == 5 else "changed" if r.page_id % 97 == 7 else "ok")
        assert r.status == want


def test_substring_dedup_equals_brute_force(spark, texts, medium):
    words = {k: (t or "").encode().split() for k, t in texts}
    first = {}
    for k, w in words.items():
        for a in range(len(w) - 49):
            first.setdefault(tuple(w[a:a + 50]), k)
    want = set()
    for k, w in words.items():
        gone = set()
        for a in range(len(w) - 49):
            if first[tuple(w[a:a + 50])] < k:
                gone.update(range(a, a + 50))
        kept = b" ".join(x for a, x in enumerate(w) if a not in gone)
        want.add((k, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    got = entry.queries()["op5_substring_dedup"](spark, medium)
    assert {tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256")
            .collect()} == want


def test_html_text_keeps_the_article(spark, con, medium):
    got = {r.page_id: r for r in entry.queries()["op6_html_text"](spark, medium).collect()}
    rows = con.execute("""SELECT page_id, regexp_extract(html, '<article>(.*)</article>', 1, 's')
                          FROM pages""").fetchall()
    assert len(got) == len(rows)
    for k, article in rows:
        headline = " ".join(html.unescape(article.split("<h1>")[1].split("</h1>")[0]).split())
        lines = got[k].text.split("\n")
        assert lines[0] == headline and "©" not in got[k].text
        assert len(lines) == 1 + article.count("<p>") and got[k].n_chars == len(got[k].text)


def test_decontamination_equals_brute_force(spark, con, texts, medium):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    held = collections.defaultdict(set)
    for k, t in items:
        w = t.lower().split()
        for a in range(len(w) - 9):
            held[tuple(w[a:a + 10])].add(k)
    want = {}
    for k, t in texts:
        w = t.lower().split()
        found = set().union(*(held.get(tuple(w[a:a + 10]), ()) for a in range(len(w) - 9)), ())
        want[k] = sorted(found)
    got = {r.doc_id: r for r in entry.queries()["op7_decontamination"](spark, medium).collect()}
    assert {k: r["items"] for k, r in got.items()} == want
    assert all(r.kept == (not want[k]) for k, r in got.items())


def test_language_model_counts_and_gain(spark, texts, medium):
    def tokens(t):
        return [*(t or "").encode().translate(LOWER).split(), None]

    def held(k):
        return zlib.crc32(str(k).encode()) % 5 == 1
    counts = collections.Counter(x for k, t in texts if not held(k) for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in entry.queries()["op9_language_model"](spark, medium).collect()}
    base = model = 0.0
    for k, t in texts:
        own, r = tokens(t), got[k]
        want = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(k), len(own), n)
        assert r.n_known == sum(counts[x] > 0 for x in own)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        base, model = base + want * held(k), model + r.score * held(k)
    assert model > base

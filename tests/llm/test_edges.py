"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from topicloom.llm import decontamination, exact_dedup, html_text, language_id, language_model
from topicloom.llm import mixing, near_dedup, substring_dedup, url_filters, warc

LONG = " ".join(f"w{k}" for k in range(60_000))
NEAR = LONG + " tail"
ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (None, "one"),
        (None, None), (6, LONG), (7, NEAR), (8, LONG), (9, "12 34 !"), (10, "A B C D E F"),
        (11, "a b c d e f")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_near_dedup(docs):
    got = rows_of(near_dedup.near_groups(docs(ROWS)), "doc_id", "n_shingles", "component_id")
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (None, 1, None),
            (None, 0, None), (6, 59_996, 6), (7, 59_997, 6), (8, 59_996, 6), (9, 1, 9),
            (10, 2, 10), (11, 2, 10)]
    assert got == sorted(want, key=repr)
    assert near_dedup.near_groups(docs([])).count() == 0


def test_near_dedup_at_the_bound(docs):
    # 17 of 20 shingles shared is exactly 0.85, 16 of 19 is below.
    whole = [f"x{k}" for k in range(24)]
    at, below = " ".join(whole[:21]), " ".join(whole[:20])
    got = dict(rows_of(near_dedup.near_groups(docs([(1, " ".join(whole)), (2, at)])),
                       "doc_id", "component_id"))
    assert got == {1: 1, 2: 1}
    got = dict(rows_of(near_dedup.near_groups(docs([(1, " ".join(whole)), (2, below)])),
                       "doc_id", "component_id"))
    assert got == {1: 1, 2: 2}


def test_language_id(docs):
    teach = [(100 + k, f"the cat and the dog number {k} went home") for k in range(40)]
    other = [(200 + k, f"der hund und die katze nummer {k} gehen heim") for k in range(40)]
    model = language_id.fit(docs(teach, "en").union(docs(other, "de")))
    got = {r.doc_id: r for r in language_id.predict(
        docs(ROWS[:4] + [(9, "12 34 !"), (20, "the dog and the cat"), (21, "die katze und der hund"),
                         (22, "the cat " * 20_000)]), model).collect()}
    for k in (1, 2, 3, 9):
        assert (got[k].lang_pred, got[k].score, got[k].accepted) == ("und", 0.0, False)
    assert [got[k].lang_pred for k in (20, 21, 22)] == ["en", "de", "en"]
    for nothing in (docs([]), docs(teach, None)):
        unlabelled = language_id.predict(docs(teach), language_id.fit(nothing))
        assert rows_of(unlabelled.select("lang_pred").distinct(), "lang_pred") == [("und",)]


def test_mixing(docs):
    rows = docs(ROWS).withColumn("source", F.when(F.col("doc_id") > 5, "b").when(
        F.col("doc_id") == 4, "a"))
    plan = mixing.mix_plan(rows)
    got = plan.groupBy("source").agg(F.sum("size").alias("all"), F.max("source_size").alias("n"),
                                     F.max("target").alias("t"), F.max("copies").alias("c"))
    sizes = {r["source"]: r for r in got.collect()}
    assert {k: (r["all"], r["n"]) for k, r in sizes.items()} == {
        "a": (1, 1), "b": (180_016, 180_016), None: (3, 3)}
    # Only a and the null source reach three times their size; b takes the rest.
    assert (sizes["a"]["t"], sizes[None]["t"]) == (3.0, 9.0)
    assert sizes["b"]["t"] == pytest.approx(180_020 - 12) and max(
        r["c"] for r in sizes.values()) <= 3
    assert plan.count() == len(ROWS) and rows_of(plan, "doc_id", "copies") == rows_of(
        mixing.mix_plan(rows.repartition(7)), "doc_id", "copies")
    assert mixing.mix(rows).count() == plan.agg(F.sum("copies")).first()[0]
    assert mixing.mix_plan(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<p>x\r\n\r\nWARC/1.0\r\ny"), (2, None, None), (3, "http://c/", ""),
         (3, "http://c/", ""), (None, "http://d/", "z"), (4, "http://e/", "é" * 300_000)],
        "page_id bigint, url string, html string")
    rows = warc.records(pages, "page_id", "url", "html", per_file=2)
    whole = F.col("record")
    warc.write_warc(rows, str(tmp_path / "w"), [whole, F.when(~F.col("key").eqNullSafe(2), whole)])
    index = warc.index_of(rows)
    replicas = [warc.read_warc(spark, f"{tmp_path}/w/replica={k}") for k in (0, 1)]
    assert replicas[0].count() == 6
    got = rows_of(warc.fixity(index, *replicas), "key", "status")
    assert got == sorted([(k, "missing" if k == 2 else "ok") for k in (1, 2, 3, 3, 4, None)],
                         key=repr)
    same = warc.fixity(index, replicas[0], replicas[0])
    assert same.where("status <> 'ok'").isEmpty() and same.count() == 6


def test_substring_dedup(docs):
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
           for r in substring_dedup.drop_repeats(docs(ROWS)).collect()}
    empty, one = sha(""), sha("one")
    assert got == {(1, 0, 0, empty), (2, 0, 0, empty), (3, 0, 0, empty), (4, 1, 0, one),
                   (5, 1, 0, one), (None, 1, 0, one), (None, 0, 0, empty),
                   (6, 60_000, 0, sha(LONG)), (7, 60_001, 60_000, sha("tail")),
                   (8, 60_000, 60_000, empty), (9, 3, 0, sha("12 34 !")),
                   (10, 6, 0, sha("A B C D E F")), (11, 6, 0, sha("a b c d e f"))}
    assert substring_dedup.drop_repeats(docs(ROWS)).count() == len(ROWS)
    assert substring_dedup.drop_repeats(docs([])).count() == 0


def test_html_text(spark):
    body = "The river rose in the night and the people of the town went up to the hill. " * 3
    pages = spark.createDataFrame(
        [(1, None, "old"), (2, "", "old"), (3, "<", "old"), (4, f"<p>{body} &amp; a&nbsp;b", "old"),
         (5, "<p>" + body * 5_000 + "</p>", None)], "page_id int, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got[1] == "" and got[2] == "" and got[4].startswith("The river")
    assert got[4].endswith("& a b") and len(got[5]) == len((body * 5_000).strip())
    assert html_text.extract(pages.limit(0)).count() == 0


def test_decontamination(spark, docs):
    item = ("a train leaves the old station at 40 miles per hour and travels for 3 hours "
            "before it stops in the next town")
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, item)],
                                  "item_id bigint, text string")
    moved = item.replace("40", "75").replace("3 hours", "9 hours")
    rows = docs(ROWS + [(20, "so " + item), (20, "so " + item), (21, LONG + " " + moved)])
    got = {r.doc_id: r for r in decontamination.flag(rows, items).collect()}
    assert {k for k, r in got.items() if not r.kept} == {20, 21}
    assert (got[20]["items"], got[20].reworded) == ([1], False)
    assert (got[21]["items"], got[21].reworded) == ([1], True)
    kept = decontamination.drop_contaminated(rows, items)
    assert kept.count() == len(ROWS) and kept.columns == rows.columns
    assert decontamination.drop_contaminated(rows, items.limit(0)).count() == rows.count()
    assert decontamination.flag(docs([]), items).count() == 0


def test_url_filters(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?y"),
         (5, "http://example.net/de/"), (6, "http://b.org/fr/#t"), (7, "http://"),
         (7, "http://"), (None, "http://bad.info/")], "page_id bigint, url string")
    bad = spark.createDataFrame([(1, None), (9, 1)], "page_id bigint, bad int")
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/")]
    for outcomes in (bad, bad.limit(0)):
        got = rows_of(url_filters.judge_urls(pages, outcomes, rules),
                      "page_id", "host", "path", "rule", "verdict")
        assert got == sorted([
            (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
            (4, "a.example.net", "/en/x", "example.net/en/", "allow"),
            (5, "example.net", "/de/", "net/", "block"), (6, "b.org", "/fr/", "org/fr/", "allow"),
            (7, "", "", None, "allow"), (7, "", "", None, "allow"),
            (None, "bad.info", "/", None, "allow")], key=repr)
    assert url_filters.judge_urls(pages.limit(0), bad, rules).count() == 0


def test_language_model(docs):
    model, rest = language_model.fit(docs(ROWS))
    got = language_model.score(docs(ROWS), model, rest, F.lit(False)).collect()
    assert len(got) == len(ROWS)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert all(r.n_known == r.n_tokens and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id == 6} == {60_001}
    model, rest = language_model.fit(docs([]))
    got = language_model.score(docs(ROWS), model, rest, F.lit(True)).collect()
    assert len(got) == len(ROWS) and all(r.train_tokens == 0 and r.n_known == 0 for r in got)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda text: F.lit(b"same")])
def test_exact_dedup(docs, digest):
    # With one digest for all texts only the contents tell them apart.
    got = rows_of(exact_dedup.exact_groups(docs(ROWS), digest=digest),
                  "doc_id", "keep_id", "group_size", "kept")
    want = [(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (3, 3, 1, True),
            (4, 5, 4, False), (5, 5, 4, True), (5, 5, 4, False), (None, 5, 4, False),
            (6, 8, 2, False), (8, 8, 2, True), (7, 7, 1, True), (9, 9, 1, True),
            (10, 10, 1, True), (11, 11, 1, True)]
    assert got == sorted(want, key=repr)
    kept = exact_dedup.keep_distinct(docs(ROWS))
    assert kept.columns == docs(ROWS).columns and sorted(
        r.doc_id for r in kept.collect()) == [2, 3, 5, 7, 8, 9, 10, 11]
    assert exact_dedup.exact_groups(docs([])).count() == 0


@pytest.mark.parametrize("rows", [[], [(None, None)], ROWS])
def test_pipeline_stages(spark, docs, small, rows):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for given in (docs(rows), docs(rows, None)):
            kept = stage(spark, given, small)
            assert kept.columns == given.columns and kept.count() <= len(rows)
    assert corpus_pipeline.mix_sources(spark, docs(rows), small).count() >= 0


def test_language_model_bounds_do_not_change_scores(docs, monkeypatch):
    texts = [(k, " ".join(f"w{(k * j * j + j) % 17}" for j in range(60))) for k in range(1, 40)]
    table = docs([*texts, (99, "never seen w1 w2 w3 w1 w2"), (100, "")])

    def scores():
        model, rest = language_model.fit(table.where("doc_id < 90"))
        got = language_model.score(table, model, rest, F.lit(False)).collect()
        return len(model.pairs), {r.doc_id: r.score for r in got}
    pairs, whole = scores()
    for most in (40, 0):
        monkeypatch.setattr(language_model, "PAIRS", most)
        fewer, joined = scores()
        assert fewer <= most < pairs
        assert joined == pytest.approx(whole, rel=1e-9)


def test_html_takes_linear_time():
    """Pages on which a pattern that reads again would take minutes or for ever."""
    import time
    start = time.perf_counter()
    for page in ("<a " + 'x="y" ' * 5000, "<script 'a" * 20_000, "<a x='" * 20_000,
                 "<p>" + '<b class="' * 20_000, "<" * 100_000, "<!" * 100_000, "<a " + "'" * 100_000):
        html_text.main_text(page)
    assert time.perf_counter() - start < 5


PROSE = "The dog and the cat were in the house, and it was good for all of them that they had come."


@pytest.mark.parametrize("name,kept", [("no-sidebar", True), ("has-sidebar", True),
                                       ("wrapper without-footer", True), ("sidebar-left", False),
                                       ("cookie-consent", False), ("page", True)])
def test_html_wrappers(name, kept):
    page = f'<body><div class="{name}"><p>{PROSE}</p></div></body>'
    assert html_text.main_text(page) == (PROSE if kept else "")


def test_html_in_other_languages():
    text = "Это длинный русский текст, который должен остаться на странице целиком. " * 2
    page = (f'<body><ul><li><a href="/">Главная</a></li><li><a href="/n">Новости</a></li></ul>'
            f"<p>{text}</p><p><a href='/x'>{text}</a></p><footer>© {text}</footer></body>")
    assert html_text.main_text(page) == text.strip()


def test_html_with_odd_columns(spark):
    rows = spark.createDataFrame([(1, "u", f"<article><p>{PROSE}</p></article>", 5, 6)],
                                 "page_id int, `odd.name` string, html string, `a b` int, text int")
    got = html_text.extract(rows)
    assert got.columns == ["page_id", "odd.name", "a b", "text"]
    assert tuple(got.first()) == (1, "u", 5, PROSE)


def test_warc_records_in_another_order(spark, tmp_path):
    """A replica with its records reversed, one with two swapped; and what the files look like."""
    import gzip
    import re
    from pathlib import Path
    pages = spark.createDataFrame([(k, f"u{k}", f"body {k}") for k in range(7)],
                                  "page_id bigint, url string, html string")
    rows = warc.records(pages, "page_id", "url", "html", per_file=10)
    warc.write_warc(rows, str(tmp_path / "w"))
    file, = (tmp_path / "w").glob("replica=0/file=0/*.gz")
    data = gzip.decompress(file.read_bytes())
    found = re.findall(rb"WARC/1\.0\r\n((?:[^\r\n]+\r\n)+)\r\n", data)
    assert len(found) == 7 and all(b"WARC-Date: " in h and b"WARC-Type: " in h for h in found)
    parts = [b"WARC/1.0\r\n" + p for p in data.split(b"WARC/1.0\r\n")[1:]]
    for p in parts:
        head, body = p.split(b"\r\n\r\n", 1)
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert body[size:] == b"\r\n\r\n" and len(body) == size + 4

    def replica(name, order):
        folder = Path(tmp_path / name / "file=0")
        folder.mkdir(parents=True)
        (folder / "part.txt.gz").write_bytes(gzip.compress(b"".join(parts[k] for k in order)))
        return warc.read_warc(spark, str(tmp_path / name))
    index, intact = warc.index_of(rows), warc.read_warc(spark, str(tmp_path / "w/replica=0"))

    def statuses(order):
        other = replica("r" + "".join(map(str, order)), order)
        return {r.key: r.status for r in warc.fixity(index, intact, other).collect()}
    assert statuses(range(7)) == {k: "ok" for k in range(7)}
    assert statuses([6, 5, 4, 3, 2, 1, 0]) == {k: "ok" if k == 3 else "changed" for k in range(7)}
    assert statuses([0, 2, 1, 3, 5, 6]) == {0: "ok", 1: "changed", 2: "changed", 3: "ok",
                                            4: "missing", 5: "ok", 6: "ok"}


def test_warc_null_keys_fill_several_files(spark):
    pages = spark.createDataFrame([(None, f"u{k}", "b") for k in range(40)],
                                  "page_id bigint, url string, html string")
    files = warc.records(pages, "page_id", "url", "html", per_file=10).select("file").distinct()
    assert 2 <= files.count() <= 4 and files.where("file >= 0").isEmpty()


def test_language_model_has_a_context_for_every_word(docs, monkeypatch):
    # Each line twice, and more words than 8,192 that are more frequent than x, y, a and b.
    fill = " ".join(f"f{k}" for k in range(9000))
    table = docs([(k, text) for k, text in enumerate([fill, fill, fill, "x a", "x a", "y b", "y b"])])
    asked = docs([(1, "x a"), (2, "x b"), (3, "y a"), (4, "y b"), (5, "x never"), (6, "never a")])

    def scores():
        model, rest = language_model.fit(table)
        got = language_model.score(asked, model, rest, F.lit(True)).collect()
        return model, {r.doc_id: r.score for r in got}
    model, whole = scores()
    assert whole[1] > whole[2] + 0.5 and whole[4] > whole[3] + 0.5
    # The parent's probabilities, and those of each context, sum to one.
    size = len(model.voc.words)
    assert model.parent.sum() + model.unseen == pytest.approx(1)
    u, w = model.pairs // size, model.pairs % size
    mass = (10 ** model.gains - 1) * model.reach[u] * model.parent[w]
    assert np.bincount(u, mass, size) + model.reach == pytest.approx(np.ones(size))
    # Words beyond a broadcast meet the same numbers in joins.
    monkeypatch.setattr(language_model, "WORDS", 3)
    model, joined = scores()
    assert len(model.voc.words) <= 3
    assert joined == pytest.approx(whole, rel=1e-9)

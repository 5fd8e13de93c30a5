"""Fingerprints: against a slow reading of the same rule, and where rows are odd."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest

from topicloom.llm import fingerprints
from topicloom.llm.fingerprints import BUCKETS, digest, edited, likeness


def slow(data):
    """The digest by its rule, one triplet at a time."""
    counts = collections.Counter()
    padded = data + bytes(3 - len(data)) if 0 < len(data) < 3 else data
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        x = (a + b * 256 + c * 65536) * 0x9E3779B1 % 2 ** 32
        x = (x ^ x >> 15) * 0x85EBCA77 % 2 ** 32
        counts[(x ^ x >> 13) % BUCKETS] += 1
    row = [counts[k] for k in range(BUCKETS)]
    q = [sorted(row)[k * BUCKETS // 4] for k in (1, 2, 3)]
    codes = [sum(c > x for x in q) for c in row]
    import math
    out = [int(4 * math.log2(len(data) + 1))]
    for k in range(0, BUCKETS, 4):
        out.append(codes[k] * 64 + codes[k + 1] * 16 + codes[k + 2] * 4 + codes[k + 3])
    return bytes(out)


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "é", "日本語", "word " * 3000,
                                  "".join(chr(97 + k * k % 26) for k in range(5000))])
def test_digest(text):
    assert digest(text.encode()) == slow(text.encode())


def test_likeness_is_bounded():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (0, 1, 50, 900, 20_000)]
    prints = [digest(t.encode()) for t in texts]
    for a in prints:
        assert likeness(a, a) == 1.0
        for b in prints:
            assert 0 <= likeness(a, b) <= 1 and likeness(a, b) == likeness(b, a)
    half = digest((texts[3][:600] + texts[3][:300]).encode())
    assert likeness(prints[3], half) > likeness(prints[3], prints[4])


def test_edited_counts_code_points():
    assert edited("日本語日本語".encode(), "éx".encode()) == (6, "日本語日éx".encode())
    assert edited(b"abcdef", "日本語".encode()) == (6, "abcd日本".encode())
    assert edited(b"ab", b"xyz") == (2, b"ab") and edited(b"", b"x") == (0, b"")


def brute(rows):
    """Rows in order, each with its edited text; keys are unique here."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (key, text) in enumerate(order):
        text, other = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        changed = text[:len(text) - cut] + other[:cut]
        a, b, c = (digest(t.encode()) for t in (text, changed, other))
        out[key] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), a.hex(), b.hex(),
                    likeness(a, b), likeness(a, c))
    return out


def test_compare_equals_brute_force(spark, docs):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice("aé語 bc") for _ in range(rng.randrange(0, 90))))
            for k in range(400)] + [(900, None), (901, ""), (-5, "x" * 200_000), (None, "last row")]
    got = fingerprints.compare_with_edits(docs(rows)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(rows)


def test_repeats_and_small_tables(spark, docs):
    assert fingerprints.compare_with_edits(docs([])).count() == 0
    assert fingerprints.fingerprints(docs([])).count() == 0
    alone = fingerprints.compare_with_edits(docs([(7, "abcdef")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1.0
    # One key many times over: every row has a row after it, copies follow each other.
    rows = [(1, "one text here")] * 300 + [(1, "another text")] * 300 + [(None, None)] * 3
    got = fingerprints.compare_with_edits(docs(rows)).collect()
    assert len(got) == 603 and sum(r.near_next == 1.0 for r in got) >= 600 - 2 + 2
    again = fingerprints.compare_with_edits(docs(rows[::-1])).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_edits_are_nearer_than_the_next_text(spark, medium):
    import __spark_entry__ as entry
    rows = entry.queries()["op12_fingerprints"](spark, medium).where("near_next < 1").collect()
    assert all(r.near_edited > r.near_next for r in rows if r.n_chars >= 3)
    same = fingerprints.fingerprints(spark.read.parquet(f"{medium}/documents.parquet"))
    assert {r.doc_id: r.fingerprint for r in same.collect()}.items() >= {
        r.doc_id: r.fingerprint for r in rows}.items()

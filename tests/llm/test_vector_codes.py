"""Vector codes against plain Lloyd rounds, and where rows are odd."""

from __future__ import annotations

import collections
import math
import random

import pytest

from topicloom.llm import vector_codes

SCHEMA = ("vec_id bigint, embedding array<double>, label int, row string, pos int, entry int, "
          "`odd.name` int")


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, "x", 9, 9, 1) for r in rows], schema).repartition(5)


def lloyd(rows, parts, entries, rounds, scale=4096):
    kept = [(k, [math.floor(x * scale) for x in v], label) for k, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[r[1][p * width:(p + 1) * width] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e)
                   for e, entry in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = collections.defaultdict(list)
            for c in cut:
                own[nearest(c[p], books[p])[1]].append(c[p])
            for e, group in own.items():
                books[p][e] = [sum(x) // len(group) for x in zip(*group)]
    out = []
    for (k, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((k, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return sorted(out, key=repr), books


def check(spark, rows, **how):
    coded, books = vector_codes.compress(table(spark, rows), owner_rows=50, **how)
    want, want_books = lloyd(rows, how["parts"], how["entries"], how["rounds"])
    assert sorted((tuple(r) for r in coded.collect()), key=repr) == want
    assert [b.tolist() for b in books.entries] == want_books


def test_equals_plain_rounds(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(k % 3, 1) for _ in range(12)], k % 4 if k % 5 else None)
            for k in range(300)]
    rows += [(k, rows[3][1], 1) for k in range(300, 420)]  # one vector many times
    rows += [(5, rows[9][1], 2), (5, rows[9][1], 2), (None, rows[10][1], None)]  # repeated keys
    rows += [(0, None, 1), (1, [], 1), (2, [1.0] * 11 + [None], 1),
             (3, [math.nan] * 12, 1), (4, [1.0] * 11 + [math.inf], 1)]
    check(spark, rows, parts=4, entries=5, rounds=4)
    check(spark, rows, parts=3, entries=256, rounds=1)
    check(spark, rows[:3], parts=4, entries=16, rounds=6)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(0, [-1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, [-1.0, 0.0], 1)]
    check(spark, rows, parts=1, entries=2, rounds=3)
    check(spark, [(k, [1.0, 1.0], None) for k in range(40)], parts=2, entries=4, rounds=2)


def test_label_error(spark):
    rows = [(k, [float(k % 7), 1.0], k % 3 if k % 4 else None) for k in range(60)]
    coded, _ = vector_codes.compress(table(spark, rows), parts=1, entries=2, rounds=2)
    got = vector_codes.with_label_error(coded).collect()
    total = collections.Counter()
    for r in got:
        total[r.label] += r.error
    assert len(got) == 60 and all(r.label_error == total[r.label] for r in got)


def test_nothing_usable(spark):
    for rows in ([], [(1, None, 1), (2, [math.nan, 1.0], 1)]):
        coded, books = vector_codes.compress(table(spark, rows), parts=1)
        assert coded.columns == ["vec_id", "label", "code", "error"]
        assert coded.count() == 0 and books.entries == [] and len(books.sha256()) == 64
        assert vector_codes.with_label_error(coded).count() == 0


def test_unfit_vectors(spark):
    with pytest.raises(ValueError):
        vector_codes.compress(table(spark, [(1, [1.0, 2.0, 3.0], 1)]), parts=2)
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(table(spark, [(1, [1e300, 2.0], 1)]), parts=2)


def test_only_changed_parts_move(spark):
    """After the first round a table holds sums, and the parts whose entry changed."""
    rng = random.Random(4)
    rows = [(k, [rng.gauss(5 * (k % 2), 1) for _ in range(4)], 1) for k in range(400)]
    moved = []
    real = vector_codes._to_owners

    def watch(df, salts, name):
        table_, seen = real(df, salts, name)
        moved.append(seen["count"])
        return table_, seen
    vector_codes._to_owners = watch
    try:
        vector_codes.compress(table(spark, rows), parts=2, entries=2, rounds=6)[0].collect()
    finally:
        vector_codes._to_owners = real
    assert moved[0] == 800 and all(0 <= n < 400 for n in moved[1:]) and moved[-1] < 40

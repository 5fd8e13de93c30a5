"""Word numbers against words: patterns that cancel in sums, wide columns, repeated keys."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicloom.llm.decontamination import drop_contaminated
from topicloom.llm.mixing import mix
from topicloom.llm.near_dedup import near_groups
from topicloom.llm.substring_dedup import drop_repeats
from topicloom.llm.words import grams, words_of

SCHEMA = "doc_id bigint, source string, text string"


def twins(order: int) -> tuple[str, str]:
    """The Thue-Morse word over a and b, and its complement."""
    word = "a"
    for _ in range(order):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_numbers_are_equal_for_equal_words_only(kind):
    rng = random.Random(3)
    words = ["".join(rng.choices("abé\x00", k=rng.randint(1, 30))) for _ in range(20_000)]
    words += [*twins(10), *twins(13), "x" * 100_000]
    texts = [None, " ".join(words), "", "\t\n"]
    blocks = list(words_of(pa.array([t and t.encode() for t in texts], kind)))
    found = [n for block in blocks for n in block.counts()]
    assert found == [0, len(words), 0, 0]
    for block in (b for b in blocks if b.counts().sum()):
        for numbers in (block.hashes, block.others()):
            numbers = numbers.tolist()
            assert len(set(zip(words, numbers))) == len(set(words)) == len(set(numbers))
        for n in (1, 5, 10, 50):
            whole = grams(block.hashes, n).tolist()
            runs = [tuple(words[k: k + n]) for k in range(len(words) - n + 1)]
            assert len(whole) == len(runs)
            assert len(set(zip(runs, whole))) == len(set(runs)) == len(set(whole))


@pytest.mark.parametrize("wide", ["false", "true"])
def test_words_that_cancel_in_sums_stay_apart(spark, wide):
    one, two = twins(10)
    rows = [(1, "s", " ".join([one] * 60)), (2, "s", " ".join([two] * 60)),
            (3, "s", " ".join([one] * 60)), (4, "s", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", wide)
    try:
        near = {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(docs).collect()}
        gone = {r.doc_id: (r.n_words, r.n_removed) for r in drop_repeats(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
    assert near == {1: (1, 1), 2: (1, 2), 3: (1, 1), 4: (0, 4)}
    assert gone == {1: (60, 0), 2: (60, 0), 3: (60, 60), 4: (0, 0)}


def test_rows_of_one_key_give_one_row_each(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(1, "s", a), (1, "s", b), (1, "s", b), (2, "s", a), (3, "s", "other words")]
    got = near_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1)] * 3 + [(2, 1), (3, 3)]


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "s", "a b c"), (2, "t", "d e")], SCHEMA)
    odd = docs.selectExpr("*", "1 AS times", "2 AS of_key", "3 AS of_source", "4 AS _hit",
                          "5 AS __hit")
    mixed = mix(odd)
    assert mixed.columns == [*odd.columns, "copy"]
    assert {(r.times, r.of_key, r.of_source) for r in mixed.collect()} <= {(1, 2, 3)}
    held = " ".join("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    items = spark.createDataFrame([(1, held)], "item_id bigint, text string")
    kept = drop_contaminated(odd.union(odd.withColumn("text", F.lit(held))
                                       .withColumn("doc_id", F.col("doc_id") + 2)), items)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2}

"""Language-model scores from a hierarchical Pitman-Yor model.

Counts cover every training token. Each word has a restaurant of its own, however rare
it is: the customers are the tokens that follow it, the dishes the words that they are.
All restaurants share one parent, whose customers are their tables, over a uniform base
with one place for words never seen.

A Gibbs sweep takes all customers of a dish out of its restaurant and seats them again
one by one, each at a new table with probability (strength + discount * tables) *
parent / (that + seated - discount * own tables), the restaurant's other tables and its
parent being those of the last sweep. Restaurants need nothing from each other but
the parent, so a sweep is one pass over the pairs of words that occur more than once; a
pair that occurs once always has one table, and how many of these a word has is known
from the word's count. Draws are hashes of dish and sweep, so reruns agree however rows
are dealt. The predictive probabilities are averaged over the sweeps after ``BURN_IN``.

What tasks meet as a broadcast is of bounded size: the ``WORDS`` most frequent words and
the ``PAIRS`` most frequent pairs of them. All other words and pairs, in the sweeps and in
a text, meet their tables, counts and masses in joins, so both bounds decide how a score
is computed, never its value. A word's code is its place among the frequent words, or
else its number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, cut_with, scratch_path
from .words import Words, mix, words_of

WORDS, PAIRS = 1 << 17, 1 << 20
DISCOUNT, STRENGTH = 0.75, 1.0
BURN_IN, SAMPLES = 2, 3
# The end of a text, a number that no word is expected to have.
END = np.uint64(0x656E642D6F662D74)
_LEFT = np.uint64(0xA0761D6478BD642F)


def uniform(keys: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """A number in (0, 1) for each key, by hashing."""
    seed = np.uint64((sweep * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return ((mix(keys ^ seed) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def seat(keys: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray,
         sweep: int, discount: float = DISCOUNT, strength: float = STRENGTH) -> np.ndarray:
    """Tables of each dish after its customers have been seated.

    The first 32 are seated singly, then a sixteenth of those present at a time, whose
    number of new tables is drawn as a rounded normal.
    """
    own = np.minimum(customers, 1).astype(np.float64)
    order = np.argsort(-customers, kind="stable")
    pull = (strength + discount * tables) * parent
    seated, step = 1, 0
    left = int(np.searchsorted(-customers[order], -1, "left"))  # dishes with more than one
    while left:
        rows = order[:left]
        size = np.minimum(max(1, seated // 16) if seated >= 32 else 1, customers[rows] - seated)
        p = pull[rows] / (pull[rows] + seated - discount * own[rows])
        u = uniform(keys[rows], sweep, 2 * step)
        if seated < 32:
            new = (u < p).astype(np.float64)
        else:
            v = uniform(keys[rows], sweep, 2 * step + 1)
            z = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
            new = np.clip(np.rint(size * p + np.sqrt(size * p * (1 - p)) * z), 0, size)
        own[rows] += new
        seated += max(1, seated // 16) if seated >= 32 else 1
        step += 1
        left = int(np.searchsorted(-customers[order[:left]], -seated, "left"))
    return own


def _tokens(docs: DataFrame, *columns: Column) -> DataFrame:
    return docs.select(*columns, F.col("text").cast("string").cast("binary").alias("text"))


def token_counts(train: DataFrame) -> DataFrame:
    """(word, n): how often each token number occurs in ``train`` (text), its ends included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w.hashes for w in words_of(batch.column(0), lower=True)]
            found.append(np.full(batch.num_rows, END))
            word, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)],
                                             ["word", "n"])
    return _tokens(train).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> tuple[int, DataFrame]:
    """The rows with the largest ``n``, at most ``most`` of them, by a threshold on n.

    Numbers of rows are taken per eighth of a doubling, so a few hundred rows decide.
    """
    step = F.floor(F.log2(F.col("n")) * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows"),
                                                   F.min("n").alias("low")).collect()
    total, low = 0, 1 << 62
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["rows"]
        if total > most:
            break
        low = row["low"]
    return low, counts.where(F.col("n") >= low)


@dataclass
class Vocabulary:
    """Frequent words: sorted numbers and counts."""

    words: np.ndarray
    counts: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each number, len(words) for those that are not here."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, len(self.words))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        at = self.find(hashes)
        return np.where(at < len(self.words), at, hashes.view(np.int64))

    def holds(self, codes: np.ndarray) -> np.ndarray:
        return (codes >= 0) & (codes < len(self.words))

    def pick(self, values: np.ndarray, codes: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The value of each frequent word, of ``others`` where a word is not frequent."""
        here = self.holds(codes)
        return np.where(here, np.append(values, 0)[np.where(here, codes, -1)], others)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        return self.pick(self.words, codes, codes.view(np.uint64)).astype(np.uint64)

    def pairs(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """A number for each pair of codes."""
        return mix(self.numbers(u) * _LEFT + self.numbers(w))


def vocabulary(kept: DataFrame) -> Vocabulary:
    rows = kept.toArrow()
    words, counts = rows["word"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(words)
    return Vocabulary(words[order], counts[order])


def steps_of(block: Words, codes: np.ndarray, start: int):
    """The context of each word, and the context of each text's end."""
    before = np.empty(len(codes), np.int64)
    before[1:] = codes[:-1]
    some = block.counts() > 0
    before[block.first[:-1][some]] = start
    ends = np.full(len(some), start, np.int64)
    ends[some] = codes[block.first[1:][some] - 1]
    return before, ends


def pair_counts(train: DataFrame, known) -> DataFrame:
    """(u, w, n): how often word w follows word u, by their codes. ``known`` is a broadcast
    vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = known.value
        end = int(voc.codes(np.array([END]))[0])
        for batch in batches:
            for block in words_of(batch.column(0), lower=True):
                codes = voc.codes(block.hashes)
                before, ends = steps_of(block, codes, end)
                u = np.concatenate([before, ends])
                w = np.concatenate([codes, np.full(len(ends), end)])
                order = np.argsort(mix(u.view(np.uint64) * _LEFT + w.view(np.uint64)))
                u, w = u[order], w[order]
                new = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (w[1:] != w[:-1])))
                n = np.diff(np.append(new, len(u)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u[new]), pa.array(w[new]), pa.array(n)], ["u", "w", "n"])
    return _tokens(train).mapInArrow(run, "u bigint, w bigint, n bigint").groupBy("u", "w").agg(
        F.sum("n").alias("n"))


def _rare(column: str, words: int) -> Column:
    return ~F.col(column).between(0, words - 1)


def _bit(bit: int) -> Column:
    return F.col("kind").bitwiseAND(bit) > 0


#: Bits of a pair's kind: its context, or its dish, is not frequent; it occurs more than once.
RARE_U, RARE_W, MANY = 1, 2, 4


def _cut_kinds(pairs: DataFrame, words: int, name: str) -> DataFrame:
    """``pairs`` written by ``kind``, so that a reader of some kinds reads no others."""
    kind = sum((F.when(is_so, bit).otherwise(0) for is_so, bit in (
        (_rare("u", words), RARE_U), (_rare("w", words), RARE_W), (F.col("n") > 1, MANY))), F.lit(0))
    pairs = pairs.withColumn("kind", kind)
    path = scratch_path(pairs.sparkSession, name)
    pairs.write.partitionBy("kind").parquet(path)
    return pairs.sparkSession.read.schema(pairs.schema).parquet(path)


def _met(table: DataFrame, state: DataFrame, of_u: list[str], of_w: list[str]) -> DataFrame:
    """``table`` with columns of ``state`` (word, ...) for its words that are not frequent, null
    for the others."""
    for side, bit, columns in (("u", RARE_U, of_u), ("w", RARE_W, of_w)):
        found = table.where(_bit(bit)).join(
            state.select(F.col("word").alias(side), *columns), side)
        table = found.unionByName(table.where(~_bit(bit)), allowMissingColumns=True)
    return table


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def word_sums(pairs: DataFrame, known, run) -> tuple[np.ndarray, DataFrame]:
    """Sums over all pairs of what ``run(batch)`` gives, by context and by dish: those of the
    frequent words, and a table (word, context, dish) of those of the others."""
    size = len(known.value.words)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, names = known.value, ["word", "context", "dish"]
        held = np.zeros((2, size))
        for batch in batches:
            value = run(batch)
            for k, side in enumerate("uw"):
                word = _column(batch, side)
                here = voc.holds(word)
                held[k] += np.bincount(word[here], value[here], size)[:size]
                far, at = np.unique(word[~here], return_inverse=True)
                sums = np.zeros((2, len(far)))
                sums[k] = np.bincount(at, value[~here], len(far))
                yield pa.RecordBatch.from_arrays([pa.array(far), *map(pa.array, sums)], names)
        some = np.flatnonzero(held.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), *map(pa.array, held[:, some])], names)
    sums = cut(pairs.mapInArrow(part, "word bigint, context double, dish double").groupBy(
        "word").agg(F.sum("context").alias("context"), F.sum("dish").alias("dish")), "sums")
    rows = sums.where(~_rare("word", size)).toArrow()
    out = np.zeros((2, size))
    for k, name in enumerate(("context", "dish")):
        out[k, rows["word"].to_numpy()] = rows[name].to_numpy()
    return out, sums.where(_rare("word", size))


@dataclass
class Sweep:
    number: int
    tables: np.ndarray  # of each frequent word as a context, before the sweep
    parent: np.ndarray  # of each frequent word as a dish, before the sweep


def _reseat(batch: pa.RecordBatch, voc: Vocabulary, sweeps: list[Sweep]) -> np.ndarray:
    """Tables of each pair (u, w, n), averaged over ``sweeps``; t0, p0 and so on are what sweeps
    start from for words that are not frequent."""
    u, w, n = (_column(batch, c) for c in "uwn")
    keys = voc.pairs(u, w)
    return sum(seat(keys, n, voc.pick(s.tables, u, _column(batch, f"t{k}")),
                    voc.pick(s.parent, w, _column(batch, f"p{k}")), s.number)
               for k, s in enumerate(sweeps)) / len(sweeps)


@dataclass
class Parent:
    """The restaurant that all contexts share, after a sweep: ``sent`` customers in all at
    ``tables`` tables, over a uniform base of ``types`` words and one."""

    types: int
    sent: float = 0.0
    tables: float = 0.0

    def seat(self, numbers: np.ndarray, sent: np.ndarray, sweep: int) -> np.ndarray:
        return seat(numbers, sent, np.full(len(sent), float(self.types)),
                    np.full(len(sent), 1 / (self.types + 1)), sweep)

    def share(self, sent, own):
        """The probability of a dish from its customers and tables, numbers or columns."""
        return (sent - DISCOUNT * own + self.unseen() * (self.sent + STRENGTH)) / (
            self.sent + STRENGTH)

    def unseen(self) -> float:
        return (STRENGTH + DISCOUNT * self.tables) / (self.types + 1) / (self.sent + STRENGTH)


@dataclass
class Seating:
    """What scores are made of: ``reach``, the share of a context that reaches the parent, and
    ``parent``, the parent's probability of a dish, of each frequent word; ``words`` (word,
    customers, reach, parent) of all others; ``pairs`` (u, w, n, own, kind), own being the averaged
    tables; the parent's probability of a word never seen."""

    reach: np.ndarray
    parent: np.ndarray
    words: DataFrame
    pairs: DataFrame
    unseen: float


def gibbs(pairs: DataFrame, others: DataFrame, known, tokens: int, types: int) -> Seating:
    """Sweeps over ``pairs`` (u, w, n, kind). ``others`` (word, n): words that are not frequent."""
    voc, context = known.value, pairs.sparkSession.sparkContext
    size = len(voc.words)
    many = pairs.where(_bit(MANY))
    held, far = word_sums(many, known, lambda batch: _column(batch, "n"))
    # Customers of a word's pairs that occur once; each has a table of its own.
    lone = voc.counts - held
    paired = cut(others.join(far, "word").select(
        "word", "n", (F.col("n") - F.col("context")).alias("lone_context"),
        (F.col("n") - F.col("dish")).alias("lone_dish")), "paired")
    single = cut(others.join(far, "word", "left_anti"), "single")
    rounds = BURN_IN + SAMPLES

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, all_sent = np.zeros(rounds), 0
        for batch in batches:
            word, n = _column(batch, "word").view(np.uint64), _column(batch, "n")
            own += [Parent(types).seat(word, n, k).sum() for k in range(rounds)]
            all_sent += n.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(rounds), pa.int64()), pa.array(own),
             pa.array(np.full(rounds, float(all_sent)))], ["sweep", "own", "sent"])
    by_sweep = {r["sweep"]: r for r in single.mapInArrow(
        singles, "sweep bigint, own double, sent double").groupBy("sweep").agg(
        F.sum("own").alias("own"), F.sum("sent").alias("sent")).collect()}

    def seated(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = Parent(types).seat(_column(batch, "word").view(np.uint64),
                                         _column(batch, "sent").astype(np.int64), number)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)],
                                                 [*batch.schema.names, "own"])
        return run
    n = F.col("n")
    state = paired.select("word", n, F.least(n, 1 + n ** DISCOUNT).alias("tables"),
                          ((n + 1) / F.lit(float(tokens + types))).alias("parent"))
    tables = np.minimum(voc.counts, 1 + voc.counts ** DISCOUNT)
    parent = (voc.counts + 1) / max(1, tokens + types)
    starts, states, parents = [], [], []
    reach, mean = np.zeros(size), np.zeros(size)
    for number in range(rounds):
        start = context.broadcast([Sweep(number, tables, parent)])
        placed = _met(many, state.select("word", F.col("tables").alias("t0"),
                                         F.col("parent").alias("p0")), ["t0"], ["p0"])
        own, far = word_sums(placed, known, lambda batch, start=start: _reseat(
            batch, known.value, start.value))
        after, seen = cut_with(
            paired.join(far, "word").select(
                "word", "n", (F.col("lone_context") + F.col("context")).alias("tables"),
                F.round(F.col("lone_dish") + F.col("dish")).alias("sent")).mapInArrow(
                seated(number),
                "word bigint, n bigint, tables double, sent double, own double"),
            "state", sent=F.sum("sent"), own=F.sum("own"))
        above, sent = Parent(types), np.rint(lone[1] + own[1])
        at = above.seat(voc.words, sent.astype(np.int64), number)
        alone = by_sweep.get(number, {"own": 0.0, "sent": 0.0})
        above.sent = float(sent.sum() + (seen["sent"] or 0) + alone["sent"])
        above.tables = float(at.sum() + (seen["own"] or 0) + alone["own"])
        if number >= BURN_IN:
            starts += start.value
            states.append(state)
            parents.append(above)
        tables, parent = lone[0] + own[0], above.share(sent, at)
        state = after.select("word", "n", "tables", above.share(
            F.col("sent"), F.col("own")).alias("parent"))
        if number >= BURN_IN:
            reach += (STRENGTH + DISCOUNT * tables) / (voc.counts + STRENGTH) / SAMPLES
            mean += parent / SAMPLES
    told = state.select("word", "n", F.col("tables").alias("t"), F.col("parent").alias("p"))
    for k, s in enumerate(states):
        told = told.join(s.select("word", F.col("tables").alias(f"t{k}"),
                                  F.col("parent").alias(f"p{k}")), "word")
    told = cut(told, "told")

    def averaged(name: str) -> Column:
        return sum((F.col(f"{name}{k}") for k in range(1, SAMPLES)), F.col(name)) / SAMPLES

    def reached(tables: Column) -> Column:
        return (STRENGTH + DISCOUNT * tables) / (F.col("n") + STRENGTH)

    def of_single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = _column(batch, "word").view(np.uint64), _column(batch, "n")
            p = sum(a.share(n, a.seat(word, n, BURN_IN + k)) for k, a in enumerate(parents))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p / SAMPLES)],
                                             ["word", "n", "parent"])
    words = cut(told.select("word", n.alias("customers"), reached(averaged("t")).alias("reach"),
                            averaged("p").alias("parent")).unionByName(
        single.select("word", "n").mapInArrow(of_single, "word bigint, n bigint, parent double")
        .select("word", n.alias("customers"), reached(n).alias("reach"), "parent")), "words")
    shared = context.broadcast(starts)

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _reseat(batch, known.value, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in "uwn"), pa.array(own)], ["u", "w", "n", "own"])
    placed = _met(many, told, [f"t{k}" for k in range(SAMPLES)],
                  [f"p{k}" for k in range(SAMPLES)])
    found = _cut_kinds(placed.mapInArrow(settled, "u bigint, w bigint, n bigint, own double"),
                       size, "seated")
    once = pairs.where(~_bit(MANY)).select("u", "w", "n", F.lit(1.0).alias("own"), "kind")
    return Seating(reach, mean, words, found.unionByName(once),
                   sum(a.unseen() for a in parents) / SAMPLES)


def gain(n, own, customers, reach, parent):
    """What a pair's own customers add to the log10 probability that comes by the parent."""
    return np.log10(1 + (n - DISCOUNT * own) / (customers + STRENGTH) / (reach * parent))


@dataclass
class Model:
    voc: Vocabulary
    tokens: int
    types: int
    reach: np.ndarray
    parent: np.ndarray
    unseen: float
    pairs: np.ndarray
    gains: np.ndarray

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def step(self, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each pair of codes gains, and which pairs are not here, so that a join may still
        add to theirs."""
        if not len(self.pairs):
            return np.zeros(len(u)), np.ones(len(u), bool)
        pair = np.where(self.voc.holds(u) & self.voc.holds(w), u * len(self.voc.words) + w, -1)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        here = self.pairs[at] == pair
        return np.where(here, self.gains[at], 0.0), ~here


@dataclass
class Rest:
    """What is too much for a broadcast: training words (word, customers, reach, parent) outside
    the vocabulary, and pairs (number, gain) outside the model."""

    words: DataFrame
    pairs: DataFrame


def fit(train: DataFrame) -> tuple[Model, Rest]:
    """The model to broadcast, and the tables of all other words and pairs."""
    spark = train.sparkSession
    counts = cut(token_counts(train), "counts")
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    low, kept = frequent(counts, WORDS)
    voc = vocabulary(kept)
    known, size = spark.sparkContext.broadcast(voc), len(voc.words)
    pairs = _cut_kinds(pair_counts(train, known), size, "pairs")
    found = gibbs(pairs, counts.where(F.col("n") < low), known, int(tokens), int(types))
    rare = _bit(RARE_U | RARE_W)
    fewest, many = frequent(found.pairs.where(~rare), PAIRS)
    top = many.toArrow()
    u, w = top["u"].to_numpy(), top["w"].to_numpy()
    order = np.argsort(u * size + w)
    gains = gain(top["n"].to_numpy(), top["own"].to_numpy(), voc.counts[u], found.reach[u],
                 found.parent[w])
    model = Model(voc, int(tokens), int(types), found.reach, found.parent, found.unseen,
                  (u * size + w)[order], gains[order])
    shared = spark.sparkContext.broadcast((found.reach, found.parent))

    def priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, (reach, parent) = known.value, shared.value
        for batch in batches:
            u, w, n, own, *others = (_column(batch, c) for c in (
                "u", "w", "n", "own", "customers", "reach", "parent"))
            added = gain(n, own, voc.pick(voc.counts, u, others[0]),
                         voc.pick(reach, u, others[1]), voc.pick(parent, w, others[2]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(voc.pairs(u, w).view(np.int64)), pa.array(added)], ["number", "gain"])
    left = _met(found.pairs.where(rare), found.words, ["customers", "reach"], ["parent"])
    left = left.unionByName(found.pairs.where(~rare & (F.col("n") < fewest)),
                            allowMissingColumns=True)
    return model, Rest(found.words, left.mapInArrow(priced, "number bigint, gain double"))


def _per_text(text: np.ndarray, number: np.ndarray, texts: int) -> pa.ListArray:
    """For each text its distinct numbers with how often each occurs."""
    order = np.lexsort((number, text))
    text, number = text[order], number[order]
    new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (number[1:] != number[:-1]))
                         if len(text) else np.zeros(0, bool))
    times = np.diff(np.append(new, len(text)))
    items = pa.StructArray.from_arrays(
        [pa.array(number[new].astype(np.int64)), pa.array(times.astype(np.int64))],
        ["number", "times"])
    ends = np.append(0, np.cumsum(np.bincount(text[new], minlength=texts)))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)


def score(docs: DataFrame, model: Model, rest: Rest, held_out: Column, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Whole texts are read, null as empty: its one token is the end. Rows that repeat are
    scored each. Words and pairs that the model does not hold are counted per text and meet
    those of ``rest`` in joins. Without training texts every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ("row bigint, key bigint, held_out boolean, n_tokens bigint, n_known bigint, "
              "base double, score double, words array<struct<number:bigint,times:bigint>>, "
              "pairs array<struct<number:bigint,times:bigint>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        voc = m.voc
        base = np.append(m.base(voc.counts), 0.0)
        # Every token is a dish once and a context once.
        ways = np.append(np.log10(m.parent) + np.log10(m.reach), 0.0)
        last = voc.find(np.array([END]))
        end, absent = int(voc.codes(np.array([END]))[0]), len(voc.words)
        for batch in batches:
            parts = {name: [] for name in ("n", "known", "base", "score")}
            absences = [[], [], [], []]  # texts and numbers of words, then of pairs
            for block in words_of(batch.column(3), lower=True):
                at = voc.find(block.hashes)
                own = voc.codes(block.hashes)
                before, final = steps_of(block, own, end)
                some = block.counts() > 0
                text_of = np.repeat(np.arange(block.low, block.high), block.counts())

                def sums(x):
                    total = np.zeros(len(some))
                    if some.any():
                        total[some] = np.add.reduceat(x, block.first[:-1][some], dtype=float)
                    return total
                texts = np.arange(block.low, block.high)
                ends = np.full(len(texts), end)
                (steps, loose), (last_step, last_loose) = m.step(before, own), m.step(final, ends)
                parts["n"].append(block.counts() + 1)
                parts["known"].append(sums(at < absent).astype(np.int64) + (last < absent))
                parts["base"].append(sums(base[at]) + base[last])
                parts["score"].append(sums(steps + ways[at]) + last_step + ways[last])
                gone = at == absent
                absences[0].append(text_of[gone])
                absences[1].append(block.hashes[gone].view(np.int64))
                if last[0] == absent:
                    absences[0].append(texts)
                    absences[1].append(ends)
                absences[2] += [text_of[loose], texts[last_loose]]
                absences[3] += [voc.pairs(before[loose], own[loose]).view(np.int64),
                                voc.pairs(final[last_loose], ends[last_loose]).view(np.int64)]
            flat = [np.concatenate(parts[k]) if parts[k] else np.zeros(0) for k in parts]
            texts, words, pair_texts, pairs = (
                np.concatenate(x) if x else np.zeros(0, np.int64) for x in absences)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)),
                 pa.array(flat[2], pa.float64()), pa.array(flat[3], pa.float64()),
                 _per_text(texts, words, batch.num_rows),
                 _per_text(pair_texts, pairs, batch.num_rows)],
                ["row", "key", "held_out", "n_tokens", "n_known", "base", "score", "words",
                 "pairs"])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            way = np.log10(_column(batch, "parent")) + np.log10(_column(batch, "reach"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(m.base(_column(batch, "customers"))), pa.array(way)],
                ["number", "base", "way"])
    rows = cut(docs.select(F.monotonically_increasing_id().alias("row"),
                           F.col(key).cast("bigint").alias("key"), held_out.alias("held_out"),
                           F.col(text).cast("string").cast("binary").alias("text"))
               .mapInArrow(run, schema), "scored")
    unseen_base, unseen = float(model.base(np.zeros(1))[0]), math.log10(model.unseen)
    priced = rest.words.mapInArrow(told, "number bigint, base double, way double").withColumn(
        "seen", F.lit(1))
    times, zero = F.col("times"), F.lit(0.0)
    by_words = rows.select("row", F.inline("words")).join(priced, "number", "left").select(
        "row", (times * F.coalesce("seen", F.lit(0))).alias("known"),
        (times * F.coalesce("base", F.lit(unseen_base))).alias("base"),
        (times * F.coalesce("way", F.lit(unseen))).alias("score"))
    # A pair that no training text holds gains nothing.
    by_pairs = rows.select("row", F.inline("pairs")).join(rest.pairs, "number").select(
        "row", F.lit(0).cast("bigint").alias("known"), zero.alias("base"),
        (times * F.col("gain")).alias("score"))
    more = by_words.unionByName(by_pairs).groupBy("row").agg(
        *[F.sum(c).alias(f"more_{c}") for c in ("known", "base", "score")])

    def both(a: str, b: str) -> Column:
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return rows.drop("words", "pairs").join(more, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        both("n_known", "more_known").cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        both("base", "more_base").alias("base_score"), both("score", "more_score").alias("score"))


def perplexity(scores: DataFrame) -> float:
    """Of all texts of ``scores`` together."""
    total, n = scores.agg(F.sum("score"), F.sum("n_tokens")).first()
    return math.pow(10, -total / n) if n else float("nan")

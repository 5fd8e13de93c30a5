"""Language identification with averaged subword embeddings and a linear softmax.

A text's subwords are the runs of 3 and 4 bytes of its lower-cased words, a word
reaching from the space before it to the space after it. Each is hashed to one of
``BUCKETS`` embeddings; their mean is the text's vector, a linear layer scores it. The
model is trained by stochastic gradient descent in numpy on the driver, on a bounded
sample of labelled rows that the executors have turned into counts of buckets.

A fifth of the sample calibrates: a temperature makes the probabilities honest, and a
text is rejected when its best probability is below what ``reject`` of the calibration
texts reach, at most ``REJECT_BELOW``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, SIZE = 1 << 16, 16
REJECT_BELOW = 0.5
UNKNOWN = "und"

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = [b if chr(b).isalpha() else 0x20 for b in range(128)]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def subwords(text: bytes) -> np.ndarray:
    """The buckets of all subwords of a lower-cased UTF-8 text."""
    b = _PLAIN[np.frombuffer(b" " + text + b" ", np.uint8)]
    space = b == 0x20
    keep = np.append(True, ~(space[1:] & space[:-1]))
    b, space = b[keep].astype(np.uint32), space[keep]
    if len(b) < 3:
        return np.zeros(0, np.int64)
    three = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    four = three[:-1] | b[3:] << np.uint32(24)
    three = three[~space[1:-1]] * np.uint32(0x9E3779B1)
    four = four[~(space[1:-2] | space[2:-1])] * np.uint32(0x85EBCA77) ^ np.uint32(0x5BD1E995)
    both = np.concatenate([three, four])
    both ^= both >> np.uint32(15)
    return (both * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.int64)


@dataclass
class LanguageModel:
    """``scores`` holds each bucket's contribution to each language's score."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, idx: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.languages))
        for k in range(0, len(idx), 1 << 16):
            total += self.scores[idx[k: k + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return _softmax((total / max(1, len(idx)) + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def labelled_sample(docs: DataFrame, key: str, text: str, lang: str,
                    per_language: int) -> list[tuple]:
    """(lang, held back, buckets, shares) of about ``per_language`` rows per language.

    A row belongs to the sample by the hash of its key, so reruns agree.
    """
    rows = docs.where(F.col(lang).isNotNull() & has_letter(F.col(text)))
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang)).count().collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for name, n in sizes.items()
                           for x in (name, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.where(draw < F.element_at(share, F.col(lang)))
    back = F.pmod(F.xxhash64(F.lit("calibrate"), F.col(key)), F.lit(5)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, shares = [], []
            for value in batch.column(3):
                found, times = np.unique(subwords(value.as_py()), return_counts=True)
                idx.append(found.astype(np.uint16).tobytes())
                shares.append((times / max(1, times.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(idx, pa.binary()),
                 pa.array(shares, pa.binary())], ["key", "lang", "back", "idx", "shares"])
    counted = chosen.select(F.col(key).cast("string").alias("key"), F.col(lang).alias("lang"),
                            back.alias("back"), F.lower(text).cast("binary").alias("text"))
    rows = counted.mapInArrow(
        count, "key string, lang string, back boolean, idx binary, shares binary").collect()
    return [(r.lang, r.back, np.frombuffer(r.idx, np.uint16).astype(np.int64),
             np.frombuffer(r.shares, np.float32)) for r in sorted(
                 rows, key=lambda r: (r.key or "", r.lang, bytes(r.idx)))]


def train(sample: list[tuple], epochs: int = 12, rate: float = 8.0, reject: float = 0.001,
          seed: int = 5) -> LanguageModel:
    """Fit, then calibrate. Without rows the model knows no language."""
    names = sorted({s[0] for s in sample})
    fit = [s for s in sample if not s[1]] or sample
    back = [s for s in sample if s[1]] or sample
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1.0, (BUCKETS, SIZE)).astype(np.float32)
    layer = rng.normal(0, 0.1, (SIZE, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    label = {name: k for k, name in enumerate(names)}
    # Rare languages weigh as much as common ones.
    count = np.bincount([label[s[0]] for s in fit], minlength=len(names))
    weight = len(fit) / np.maximum(count, 1) / max(1, len(names))
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for k in rng.permutation(len(fit)):
            name, _, idx, share = fit[k]
            eta = rate * (1 - done / steps) * min(4.0, weight[label[name]])
            done += 1
            vector = share @ embed[idx]
            error = _softmax(vector @ layer + bias)
            error[label[name]] -= 1
            back_error = layer @ error
            layer -= 0.05 * eta * np.outer(vector, error)
            bias -= 0.005 * eta * error
            embed[idx] -= eta * share[:, None] * back_error
    model = LanguageModel(names, embed @ layer, bias)
    if not names:
        return model
    raw = np.array([share @ model.scores[idx] + bias for _, _, idx, share in back], np.float64)
    truth = np.array([label[s[0]] for s in back])

    def loss(t: float) -> float:
        return -np.log(_softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    model.temperature = min(np.geomspace(0.05, 5, 60), key=loss)
    best = _softmax(raw / model.temperature).max(axis=1)
    model.threshold = float(min(REJECT_BELOW, np.quantile(best, reject)))
    return model


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 400) -> LanguageModel:
    """A model from ``docs``; ``per_language`` bounds the labelled rows it is fitted on."""
    return train(labelled_sample(docs, key, text, lang, per_language))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", pred: str = "lang_pred",
            score: str = "score", accepted: str = "accepted") -> DataFrame:
    """``docs`` without its text, with the predicted language, its probability, and whether
    it is high enough. Whole texts are read. A text that is null or has no letter is
    ``und`` with score 0 and not accepted, as is every text when no language is known.
    Columns of ``docs`` of the same names as the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in (text, pred, score, accepted)]
    rows = docs.select(F.when(has_letter(F.col(text)), F.lower(text)).cast("binary").alias("_text"),
                       F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    schema = rows.select("_row").schema.add("p", "string").add("s", "double").add("a", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            names, scores, good = [], [], []
            for value in batch.column(0):
                text_ = value.as_py()
                if text_ is None or not m.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    good.append(False)
                    continue
                p = m.probabilities(subwords(text_))
                k = int(p.argmax())
                names.append(m.languages[k])
                scores.append(float(p[k]))
                good.append(bool(p[k] >= m.threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(good, pa.bool_())], ["_row", "p", "s", "a"])
    out = rows.mapInArrow(run, schema)
    return out.select("_row.*", F.col("p").alias(pred), F.col("s").alias(score),
                      F.col("a").alias(accepted))


def keep_accepted(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    order = docs.columns
    rows = docs.select(F.lower(F.col(text).cast("string")).cast("binary").alias("_asked"),
                       F.struct(*[F.col(f"`{c}`") for c in order]).alias("_row")).where(
        has_letter(F.col(f"_row.`{text}`")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            good = [bool(m.languages) and m.probabilities(subwords(t.as_py())).max() >= m.threshold
                    for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1)], ["_row"]).filter(
                pa.array(good, pa.bool_()))
    return rows.mapInArrow(run, rows.select("_row").schema).select("_row.*")

"""The state of ingestion: repeats, changes, late and simultaneous deliveries."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

from topicloom.streaming import upsert
from topicloom.streaming.upsert import NewestContent


class State:
    """Stands in for the state of one key."""

    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def deliver(processor, *rows):
    frame = pd.DataFrame([(pd.Timestamp(day), f"title {digest}", None, digest)
                          for day, digest in rows],
                         columns=["modified", "title", "abstract", "digest"])
    halves = [frame.iloc[:1], frame.iloc[1:]]
    out = list(processor.handleInputRows(("k",), iter(halves), None))
    return [(r.version, r.title) for f in out for r in f.itertuples()]


def test_versions():
    processor = NewestContent()
    processor.known = State()
    assert deliver(processor, ("2024-01-02", "a"), ("2024-01-01", "z")) == [(1, "title a")]
    assert deliver(processor, ("2024-01-03", "a")) == []
    assert deliver(processor, ("2024-01-01", "b")) == []
    assert deliver(processor, ("2024-01-05", "b"), ("2024-01-05", "c")) == [(2, "title c")]
    assert deliver(processor, ("2024-01-06", "a")) == [(3, "title a")]


def test_a_batch_folds_as_one_key_at_a_time(spark):
    """Batches of many keys, joined with what is known, give the versions of `NewestContent`."""
    rng = np.random.default_rng(11)
    known, keyed, seen = None, {}, 0
    for _ in range(4):
        rows = [(f"k{rng.integers(30)}", datetime(2024, 1, 1) + timedelta(int(d)),
                 f"title {g}", None, str(g)) for d, g in rng.integers(0, 5, size=(40, 2))]
        batch = spark.createDataFrame(rows, "key string, modified timestamp, title string, "
                                            "abstract string, digest string")
        got = upsert.fold(batch, known)
        want = set()
        for name in {r[0] for r in rows}:
            if name not in keyed:
                keyed[name] = NewestContent()
                keyed[name].known = State()
            mine = [(r[1], r[4]) for r in rows if r[0] == name]
            want |= {(name, version, title) for version, title in deliver(keyed[name], *mine)}
        assert {(r.key, r.version, r.title) for r in got.collect()} == want
        left = got.select("key", "digest", "version", "modified").localCheckpoint()
        known = left if known is None else known.unionByName(left)
        seen += len(want)
    assert seen > 30
    plan = upsert.fold(batch, known)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_upsert_of_files(spark, tmp_path):
    """Each run is a delivery: unchanged records add nothing, also after several batches."""
    from topicloom.sources import records
    from pyspark.sql import functions as F
    root, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for number, rows in enumerate([[("a", "1"), ("b", "1")], [("a", "1"), ("b", "2")],
                                   [("b", "2"), ("c", "1")]]):
        df = spark.createDataFrame(rows, "t string, x string").repartition(2)
        df.select(records.to_record([(F.col("t"), None)], F.col("x"))).write.text(f"{root}/{number}")
        upsert.ingest_upsert(spark, root, out, state, F.col("title"), pattern="*.txt",
                             record_end=records.RECORD_END, files_per_batch=1)
    got = {(r.key, r.version, r.abstract) for r in upsert.newest(spark, out).collect()}
    assert got == {("a", 1, "1"), ("b", 2, "2"), ("c", 1, "1")}
    assert spark.read.parquet(out).count() == 4

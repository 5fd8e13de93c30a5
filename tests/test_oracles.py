"""Every query that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, small, name):
    assert compare(spark, con, name, entry.queries()[name], SQL[name], small) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs_without_sql(spark, small, name):
    assert entry.queries()[name](spark, small).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cluster_id", "keywords", "name", "summary", "size"]
    assert df.count() > 0

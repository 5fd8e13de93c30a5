"""Run queries against their SQL and compare row by row.

    python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def value(x):
        if isinstance(x, bool) or x is None:
            return str(x)
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 6) + 0.0)
        return str(x)
    return sorted(tuple(value(row[k]) for k in order) for row in rows)


def compare(spark, con, name: str, query, sql: str, folder: str) -> list[str]:
    """Differences between a query and its SQL; empty when equal."""
    df = query(spark, folder)
    got = canonical(df.columns, df.collect())
    compare.spark_done = time.time()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = canonical(names, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not problems and got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        problems.append(f"{len(bad)} rows differ, e.g. {str(bad[0][0])[:300]} != {str(bad[0][1])[:300]}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from topicloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    con, queries, sql = connect(folder), entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = compare.spark_done = time.time()
        try:
            if name in sql:
                problems = compare(spark, con, name, queries[name], sql[name], folder)
                verdict = "equal" if not problems else "; ".join(problems)
            else:
                verdict, problems = f"{queries[name](spark, folder).count()} rows, no SQL", []
                compare.spark_done = time.time()
        except Exception as error:
            verdict, problems = f"error {str(error)[:600]}", ["error"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:26}{compare.spark_done - start:7.1f}s  {verdict}",
              flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())

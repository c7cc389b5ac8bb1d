"""Run every query and its SQL twin on one scale factor and compare the rows.

usage: python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from freshet.catalog import QUERIES, SQL  # noqa: E402
from freshet.session import local_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def normal(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """'' when columns and rows agree, otherwise what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    relation = connection.execute(SQL[name])
    columns = [d[0] for d in relation.description]
    want = rows_of(columns, relation.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if got != want:
        left, right = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} vs {len(want)} rows; only ours {sorted(left)[:3]}; only SQL {sorted(right)[:3]}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(8, "compare"), duck(sf_dir)
    spark.sparkContext.setLogLevel("OFF")
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report every query, whatever happens to one
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.perf_counter() - start:.2f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

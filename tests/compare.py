"""Run registered queries on Spark and their reference SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(found, key=repr)


def check(spark, con, name, queries, reference, folder, inspect=None):
    """Returns (problem or None, rows, seconds)."""
    start = time.time()
    df = queries[name](spark, folder)
    if inspect:
        inspect(df)
    got = df.collect()
    seconds = time.time() - start
    if name not in reference:
        return (None if got else "no rows"), len(got), seconds
    result = con.execute(reference[name])
    want_cols = [d[0] for d in result.description]
    cols, mine = rows_of(df.columns, got)
    want, theirs = rows_of(want_cols, result.fetchall())
    if cols != want:
        return f"columns {cols} != {want}", len(mine), seconds
    if not theirs:
        return "reference has no rows", len(mine), seconds
    if len(mine) != len(theirs):
        return f"{len(mine)} rows, reference {len(theirs)}", len(mine), seconds
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]} cols {cols}", len(mine), seconds
    return None, len(mine), seconds


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from marlake.queries import QUERIES, REFERENCE_SQL
    from marlake.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or list(QUERIES):
        try:
            problem, n, seconds = check(spark, con, name, QUERIES, REFERENCE_SQL, folder)
        except Exception as e:  # noqa: BLE001
            problem, n, seconds = f"{type(e).__name__}: {str(e)[:700]}", 0, 0.0
        kind = "sql" if name in REFERENCE_SQL else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {kind:4s} {n:8d} rows {seconds:6.2f}s {problem or ''}", flush=True)
        failed += bool(problem)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

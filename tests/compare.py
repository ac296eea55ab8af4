"""Compare registered queries with their SQL on DuckDB: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{source}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if ours != theirs:
        only = sorted(set(ours) - set(theirs))[:3], sorted(set(theirs) - set(ours))[:3]
        return f"rows {len(ours)} vs {len(theirs)}; only here {only[0]}; only there {only[1]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from dailymart.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(oracle)), "without query:", sorted(set(oracle) - set(queries)))
    bad = 0
    for name, query in queries.items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            problem = compare(spark, con, query, oracle[name], sf_dir)
        except Exception as error:  # keep going, report at the end
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print("differences:", bad)

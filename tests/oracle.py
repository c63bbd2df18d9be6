"""Compare every query with its SQL twin: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and the SQL result, or None."""
    result = con.sql(sql)
    if sorted(result.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(result.columns)}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(result.columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from propensa.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wanted = sys.argv[2:] or list(entry.queries())
    for name in wanted:
        started = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            verdict = f"{df.count()} rows" if sql is None else difference(df, con, sql) or "equal"
        except Exception as e:  # noqa: BLE001
            verdict = f"ERROR {type(e).__name__}: {str(e)[:300]}"
        print(f"{name:28s} {time.time() - started:6.2f}s  {verdict[:600]}", flush=True)

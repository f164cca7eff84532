"""Spark-vs-DuckDB result comparison, order-insensitive and by column name."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=_key)


def spark_rows(df):
    cols = df.columns
    return rows_of(cols, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return rows_of(cols, cur.fetchall())


def diff(a, b, limit=3):
    """Human-readable first differences between two sorted row lists."""
    sa, sb = set(a), set(b)
    only_a = [r for r in a if r not in sb][:limit]
    only_b = [r for r in b if r not in sa][:limit]
    return f"only spark: {only_a}\nonly oracle: {only_b}"

"""Spark-vs-DuckDB comparison used by the tests (row count, column names, order-free values)."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    return cols, rows


def compare(df, con, sql):
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    assert sc == dc, f"columns differ: spark={sc} duck={dc}"
    assert len(sr) == len(dr), f"row count: spark={len(sr)} duck={len(dr)}"
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    a, b = sorted(sr, key=key), sorted(dr, key=key)
    for x, y in zip(a, b):
        assert x == y, f"row differs:\n spark={x}\n duck ={y}"
    return len(sr)

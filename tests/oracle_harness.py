"""Run a registered Spark query and its DuckDB oracle side by side and compare
row count, column names and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, (dt.datetime,)):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in records)


def compare(spark, query_fn, sql: str, sf_dir: str, con=None):
    con = con or duck(sf_dir)
    sdf = query_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_cols": sorted(s_cols), "oracle_cols": sorted(d_cols)}
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if out["cols_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        out["hash_match"] = hashlib.sha256(repr(a).encode()).hexdigest() == hashlib.sha256(repr(b).encode()).hexdigest()
        if not out["hash_match"]:
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            out["diff"] = (diff_a, diff_b)
    else:
        out["hash_match"] = False
    out["ok"] = out["cols_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    return out

"""Compare a registered Spark query with its DuckDB oracle (as the driver does):
same column names, same row count, same multiset of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, key: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    out["rows_match"] = len(s_rows) == len(d_rows)
    if out["columns_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            out["only_spark"] = list((a - b).items())[:3]
            out["only_oracle"] = list((b - a).items())[:3]
    else:
        out["values_match"] = False
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    out["ok"] = out["columns_match"] and out["rows_match"] and out["values_match"]
    return out

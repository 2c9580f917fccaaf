"""Run a Spark query and its DuckDB oracle on the same tables and compare results
(row count, column names, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v == v.to_integral() else v.normalize()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_key(r):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in r)


def compare(spark_df, con, sql: str, max_show: int = 5):
    s_cols = spark_df.columns
    s_rows = [tuple(norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [x[0] for x in res.description]
    d_raw = res.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(norm(r[i]) for i in order) for r in d_raw]
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
    ss = sorted(s_rows, key=rows_key)
    dd = sorted(d_rows, key=rows_key)
    out["values_match"] = ss == dd
    if not out["values_match"]:
        sset, dset = set(map(repr, ss)), set(map(repr, dd))
        out["only_spark"] = sorted(sset - dset)[:max_show]
        out["only_oracle"] = sorted(dset - sset)[:max_show]
    return out

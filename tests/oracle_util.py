"""Run oracle SQL in DuckDB over the driver parquet files and compare with Spark results."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from fathom.sources.driver import DRIVER_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of_spark(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr), cols


def rows_of_duck(con, sql, cols=None):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    data = res.fetchall()
    cols = cols or sorted(names)
    idx = [names.index(c) for c in cols]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in data), key=repr), cols, names


def compare(df, con, sql, cols=None):
    """Return None when equal, else a short description of the first difference."""
    s_rows, s_cols = rows_of_spark(df, cols)
    d_rows, d_cols, names = rows_of_duck(con, sql, cols or None)
    if sorted(df.columns) != sorted(names) and cols is None:
        return f"columns differ: spark={sorted(df.columns)} duck={sorted(names)}"
    if len(s_rows) != len(d_rows):
        return f"row count spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return f"first diff cols={s_cols}\n spark={a}\n duck ={b}"
    return None

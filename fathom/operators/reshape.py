"""Pivot, unpivot and calendar gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_agg(df: DataFrame, rows: list[str], col: str, aggs: list[Column], values: list | None = None,
              fill=None) -> DataFrame:
    """One output column per value of ``col`` (discovered with one small distinct job when
    ``values`` is None). Two or more aliased aggregates give ``<value>_<alias>`` columns.
    ``fill`` replaces absent cells (a count over no rows is 0, not NULL)."""
    g = df.groupBy(*rows)
    p = g.pivot(col, values) if values is not None else g.pivot(col)
    out = p.agg(*aggs)
    if fill is not None:
        out = out.fillna(fill, subset=[c for c in out.columns if c not in rows])
    return out


def unpivot(df: DataFrame, ids: list[str], name: str, value: str, drop_nulls: bool = True) -> DataFrame:
    """All non-id columns to (name, value) rows; NULL values are dropped like SQL UNPIVOT."""
    cols = [c for c in df.columns if c not in ids]
    out = df.unpivot(ids, cols, name, value)
    return out.where(F.col(value).isNotNull()) if drop_nulls else out


def fill_days(keys: DataFrame, day: str, lo: Column, hi: Column) -> DataFrame:
    """Every key row repeated for each calendar day in [lo, hi] (explode, no join)."""
    return keys.select("*", F.explode(F.sequence(lo, hi)).alias(day))

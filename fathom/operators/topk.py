"""Keep-one / top-k per group.

``row_number() <= k`` over a partitioned window is planned with
``WindowGroupLimit``, which also runs a partial limit before the shuffle, so
a hot group sends at most k rows per map task instead of all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k(df: DataFrame, partition: list[str], order: list[Column], k: int, rank_col: str | None = None) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def keep_one(df: DataFrame, partition: list[str], order: list[Column]) -> DataFrame:
    return top_k(df, partition, order, 1)

"""Dense surrogate keys without a single-task global window.

``row_number() OVER (ORDER BY k)`` runs in one task. Here the rows are
range-partitioned on the order columns (every partition holds a contiguous
key range), sorted inside each partition, numbered locally, and shifted by
the row count of all earlier partitions. The offsets table has one row per
partition, so broadcasting it is bounded by the partition count.

The numbered rows are written to the shared folder before the counts are
taken, so the counts and the rows come from one materialization that does
not depend on any executor's disk, even where the order is not unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written

_LOCAL_BITS = 33


def _numbered(df: DataFrame, order_cols: list[str | Column], num_partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows tagged with (partition, local number), and one row per partition: _p, _n, _off (rows before it)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = written(ranged.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    tagged = tagged.withColumn("_p", F.shiftright("_mid", _LOCAL_BITS))
    counts = tagged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return tagged, counts.select("_p", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def _keyed(df: DataFrame, tagged: DataFrame, offsets: DataFrame, name: str, start: int) -> DataFrame:
    local = F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)
    out = tagged.join(F.broadcast(offsets.drop("_n")), "_p")
    return out.select(*df.columns, (F.col("_off") + local + F.lit(start)).cast("bigint").alias(name))


def dense_key(df: DataFrame, order_cols: list[str | Column], name: str, start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order_cols)`` from ``start``, by range partitions and offsets."""
    return _keyed(df, *_numbered(df, order_cols, num_partitions), name, start)


def ntile_global(df: DataFrame, order_cols: list[str | Column], buckets: int, name: str) -> DataFrame:
    """``ntile(buckets) OVER (ORDER BY order_cols)`` for any order, without a single-task window.

    The tile follows from the global rank and the row count (both from the
    offsets): the first ``N % buckets`` tiles hold one row more.
    """
    tagged, offsets = _numbered(df, order_cols, None)
    ranked = _keyed(df, tagged, offsets, "_rank", 1)
    total = offsets.agg(F.sum("_n")).first()[0] or 0
    q, m = divmod(total, buckets)
    r = F.col("_rank")
    big = m * (q + 1)
    tile = F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1)
    if q > 0:
        tile = tile.otherwise(F.floor((r - big - 1) / q) + m + 1)
    return ranked.withColumn(name, tile.cast("int")).drop("_rank")

"""As-of join: for each left row, the latest right row of the same key at or before it.

Spark has no ASOF join, and ``_joinAsOf`` plans a range nested loop. This is
the union-and-carry form: left and right rows are unioned, sorted by time
inside each key and ``last(right, ignorenulls)`` carries the latest right row
forward onto the left rows. Linear in the input, no pair generation.

A single key can hold a large share of the rows (one currency, one sensor).
With ``bucket`` the window partitions are (key, time bucket) instead of key,
so a hot key is spread over many tasks; the latest right row from earlier
buckets is carried in from a small per-(key, bucket) summary, which is itself
a window over one row per bucket.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
              how: str = "left", allow_exact: bool = True, direction: str = "backward",
              bucket: Callable[[Column], Column] | None = None) -> DataFrame:
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    by = list(by)
    rcols = [c for c in right.columns if c not in by]
    clash = [c for c in rcols if c in left.columns]
    if clash:
        raise ValueError(f"right columns clash with left: {clash}")
    lcols = left.columns
    backward = direction == "backward"
    # Order of equal times: a right row at the same instant counts when exact
    # matches are allowed, so it must be seen first (backward) / last (forward).
    right_first = allow_exact if backward else not allow_exact
    r_tag, l_tag = (0, 1) if right_first else (1, 0)

    L = left.select(*[F.col(c) for c in by], F.col(left_on).alias("_t"), F.lit(l_tag).alias("_tag"),
                    F.struct(*[F.col(c) for c in lcols]).alias("_l"), F.lit(None).alias("_r"))
    rstruct = F.struct(*[F.col(c) for c in rcols])
    R = right.select(*[F.col(c) for c in by], F.col(right_on).alias("_t"), F.lit(r_tag).alias("_tag"),
                     F.lit(None).alias("_l"), rstruct.alias("_r"))
    L = L.withColumn("_r", F.lit(None).cast(R.schema["_r"].dataType))
    R = R.withColumn("_l", F.lit(None).cast(L.schema["_l"].dataType))

    parts = list(by)
    if bucket is not None:
        L = L.withColumn("_b", bucket(F.col("_t")))
        R = R.withColumn("_b", bucket(F.col("_t")))
        # last right row of each (key, bucket) and the carry from earlier buckets
        edge = F.max_by if backward else F.min_by
        per_bucket = R.groupBy(*by, "_b").agg(edge("_r", F.col("_t")).alias("_edge_r"),
                                              (F.max if backward else F.min)("_t").alias("_edge_t"))
        buckets = L.select(*by, "_b").distinct().join(per_bucket, [*by, "_b"], "full")
        order = F.col("_b").asc() if backward else F.col("_b").desc()
        prior = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        carry = buckets.select(
            *by, "_b",
            F.last(F.struct(F.col("_edge_t").alias("t"), F.col("_edge_r").alias("r")), ignorenulls=True)
            .over(prior).alias("_c"))
        carry = carry.where(F.col("_c").isNotNull()).select(
            *by, F.col("_c.t").alias("_t"), F.lit(-1 if backward else 2).alias("_tag"),
            F.lit(None).cast(L.schema["_l"].dataType).alias("_l"), F.col("_c.r").alias("_r"), "_b")
        R = R.unionByName(carry)
        parts.append("_b")

    u = L.unionByName(R)
    if backward:
        w = Window.partitionBy(*parts).orderBy("_t", "_tag").rowsBetween(Window.unboundedPreceding, 0)
        match = F.last("_r", ignorenulls=True).over(w)
    else:
        w = Window.partitionBy(*parts).orderBy("_t", "_tag").rowsBetween(0, Window.unboundedFollowing)
        match = F.first("_r", ignorenulls=True).over(w)
    out = u.select("_l", match.alias("_m"), "_tag").where(F.col("_tag") == l_tag)
    if how == "inner":
        out = out.where(F.col("_m").isNotNull())
    elif how != "left":
        raise ValueError("how must be 'left' or 'inner'")
    return out.select(*[F.col("_l")[c].alias(c) for c in lcols], *[F.col("_m")[c].alias(c) for c in rcols])

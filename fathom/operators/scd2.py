"""Version intervals from events (E12, E13): slowly changing values folded in any order.

``fold_events`` merges value events (key, instant, value) into version intervals. Events
may come in any order and number: one that lies inside an old version splits it, one
that repeats the value in force makes no version, a null value ends the version in
force without a new one. Known versions are never dropped (facts point at them), and
folding the same events again changes nothing.

The order of a key's rows is only looked at inside a chunk of time (a month); what the
chunks before and after it contribute is a row per (key, chunk), so a key with a third
of all events is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def month_of(at: Column) -> Column:
    return F.date_trunc("month", at)


def with_neighbour(df: DataFrame, key: list[str], at: str, value: Column, name: str, after: bool = False,
                   chunk: Callable[[Column], Column] = month_of) -> DataFrame:
    """``df`` with ``value`` of the row before (or ``after``) it in its key, by ``at``; (key, at) is unique.

    ``lag``/``lead`` inside (key, chunk), and at the border of a chunk the edge value of the next chunk that has rows."""
    rows = df.withColumn("_chunk", chunk(F.col(at))).withColumn("_x", F.struct(value.alias("x")))
    inside = Window.partitionBy(*key, "_chunk").orderBy(at)
    edge = (F.min_by if after else F.max_by)("_x", at)
    chunks = rows.groupBy(*key, "_chunk").agg(edge.alias("_edge"))
    by_chunk = Window.partitionBy(*key).orderBy("_chunk")
    shift = F.lead if after else F.lag
    chunks = chunks.select(*key, "_chunk", shift("_edge").over(by_chunk).alias("_edge"))
    out = rows.withColumn("_near", shift("_x").over(inside)).join(chunks, [*key, "_chunk"])
    return out.withColumn(name, F.coalesce("_near", "_edge")["x"]).select(*df.columns, name)


def fold_events(versions: DataFrame, events: DataFrame, key: str, value: str, chunk: Callable[[Column], Column] = month_of) -> DataFrame:
    """``versions`` (key, valid_from, valid_to, value) after ``events`` (key, at, value, event_id): one row per version.

    At one instant the event with the highest id counts, and it overrides a version that begins there."""
    none = F.lit(None).cast("long")
    starts = versions.select(key, F.col("valid_from").alias("at"), F.col(value).alias("value"), none.alias("event_id"), F.lit(True).alias("known"))
    ends = versions.where("valid_to IS NOT NULL").select(key, F.col("valid_to").alias("at"), F.lit(None).cast(versions.schema[value].dataType).alias("value"),
                                                         F.lit(-1).cast("long").alias("event_id"), F.lit(False).alias("known"))
    new = events.select(key, "at", F.col(value).cast(versions.schema[value].dataType).alias("value"), F.col("event_id").cast("long").alias("event_id"),
                        F.lit(False).alias("known"))
    # at one instant: the newest event, else the version that begins there, else the end of one
    weight = F.when(F.col("event_id") >= 0, F.col("event_id") + 1).when(F.col("known"), F.lit(0)).otherwise(F.lit(-1))
    rows = starts.unionByName(ends).unionByName(new).groupBy(key, "at").agg(
        F.max_by(F.struct("value"), weight).alias("_v"), F.max("known").alias("known"), F.max("event_id").alias("event_id"))
    rows = rows.select(key, "at", F.col("_v.value").alias("value"), "known")
    rows = with_neighbour(rows, [key], "at", F.col("value"), "_before", chunk=chunk)
    kept = rows.where(F.col("known") | ~F.col("value").eqNullSafe(F.col("_before"))).drop("_before")
    kept = with_neighbour(kept, [key], "at", F.col("at"), "valid_to", after=True, chunk=chunk)
    return kept.where(F.col("value").isNotNull()).select(key, F.col("at").alias("valid_from"), "valid_to", F.col("value").alias(value))

"""Structured Streaming jobs for warehouse freshness (T-1..T-3).

* ``order_stream``: the order source as a file stream (new files = new rows).
  ``time_ordered_feed`` lays a source out as files in the order of a time, so that a
  stream reads them oldest first, a stated number a batch, and no row is later than the
  batches before it allow.
* ``dedup_stream`` (T-2): re-read overlap is harmless: duplicates of
  (id, updated_at) inside the watermark are dropped.
* ``live_counts`` (T-3): orders and distinct customers per event-time window,
  up to the newest order. A stateful aggregate per (window, customer) runs in
  update mode; every micro-batch upserts its changed rows into a table, and the
  windows are totals over that table, so open windows count as well. The
  watermark only bounds how long state is kept.
* ``upsert_stream`` (T-1): every micro-batch merges its rows into a versioned table
  (the newest version of a key wins, whichever batch brings it). The table lies in parts,
  and a batch reads and writes only the parts of its own keys; all others are named by
  the new manifest where they lie. A batch that is replayed after a failure changes
  nothing. ``incremental_stream`` runs the incremental warehouse load as the
  micro-batch action.

Checkpoints and outputs live under the session's shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted job resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.versions import Load, Version, current_version, next_version, publish
from ..session import ensure_checkpoint_dir


def _order_status():
    k = F.col("o_orderkey")
    return (F.when(k % 33 == 0, "cancelled").when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "shipped").when(k % 10 == 1, "pending").otherwise("paid"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:8]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def _as_events(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    placed = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k * 7919 % 86400).cast("decimal(18,6)"))
    return orders.select((k + 1).alias("id"), (F.col("o_custkey") + 1).alias("customer_id"), _order_status().alias("status"),
                         placed.cast("timestamp").alias("placed_at"), (placed + F.make_dt_interval(F.lit(2))).cast("timestamp").alias("updated_at"))


def time_ordered_feed(df: DataFrame, ts: str, files: int, path: str) -> str:
    """Write ``df`` as ``files`` Parquet files, each a stretch of time, with modification times in that order.

    A file stream takes new files by modification time, so it reads the oldest rows first."""
    spark = df.sparkSession
    df.repartitionByRange(files, ts).sortWithinPartitions(ts).write.mode("overwrite").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    first = fs.getFileStatus(parts[0]).getModificationTime() - 1000 * len(parts) if parts else 0
    for k, part in enumerate(parts):
        fs.setTimes(part, first + 1000 * k, -1)
    return path


def order_stream(spark: SparkSession, sf_dir: str, copies: int = 1, files: int | None = None, per_batch: int = 1) -> DataFrame:
    """Orders as an event stream: id, customer_id, status, placed_at, updated_at (UTC timestamps).

    ``copies`` > 1 unions the same source several times, i.e. overlapping re-reads. With ``files`` the orders
    come in the order of ``updated_at``, ``per_batch`` of so many files at a time; else in one batch."""
    if files is None:
        schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
        one = lambda: _as_events(spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir))
    else:
        feed = time_ordered_feed(_as_events(spark.read.parquet(f"{sf_dir}/orders.parquet")), "updated_at", files, scratch(spark, "feed"))
        kinds = spark.read.parquet(feed).schema
        one = lambda: spark.readStream.schema(kinds).option("maxFilesPerTrigger", per_batch).parquet(feed)
    out = one()
    for _ in range(copies - 1):
        out = out.unionByName(one())
    return out


def dedup_stream(sdf: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """T-2: drop repeats of ``keys`` seen within the watermark delay (state is bounded by it)."""
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def live_counts(sdf: DataFrame, ts: str, size: str, delay: str, name: str) -> DataFrame:
    """T-3: per event-time window: orders, exact distinct customers, last order time; open windows included.

    Runs the stream over everything available and returns the totals of the upserted table.
    """
    spark = sdf.sparkSession
    per = sdf.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w"), "customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).alias("last"))
    per = per.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "customer_id", "n", "last")
    root = scratch(spark, name)
    part = F.date_format("window_start", "yyyy-MM")  # a batch touches the windows it has rows of
    q = upsert_stream(per, ["window_start", "customer_id"], "n", f"{root}/table", f"{root}/checkpoint", mode="update", part=part)
    q.awaitTermination()
    table = upserted(spark, f"{root}/table", per.schema)
    return table.groupBy("window_start", "window_end").agg(
        F.sum("n").cast("bigint").alias("orders"), F.count(F.lit(1)).cast("bigint").alias("customers"),
        F.max("last").alias("last_order_at"))


def run_available(sdf: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming query over everything available (Trigger.AvailableNow) into a parquet
    sink and return the sink as a batch DataFrame."""
    spark = sdf.sparkSession
    root = scratch(spark, name)
    q = (sdf.writeStream.outputMode(mode).format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


# -- T-1 ---------------------------------------------------------------------------------
#: Parts of an upserted table where the caller names none: its keys are dealt over so many by their hash.
PARTS = 32


def _newest(rows: DataFrame, key: list[str], version_col: str, cols: list[str]) -> DataFrame:
    """The newest row of each key; a partial aggregate, so that a hot key never gathers its rows in one task."""
    return rows.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct(version_col, F.xxhash64(*cols))).alias("_r")).select("_r.*")


def merge_batch(spark: SparkSession, batch: DataFrame, key: list[str], version_col: str, root: str, part: Column) -> None:
    """Merge a batch into the versioned table under ``root``: only the parts of its keys are read and written."""
    cols = batch.columns
    rows = _newest(batch, key, version_col, cols).withColumn("part", part.cast("string"))
    rows = rows.persist()  # a small batch, read twice; lost blocks are computed again from the batch
    try:
        touched = [f"part={r.part}" for r in rows.select("part").distinct().collect()]
        if not touched:
            return
        old = Version.open(spark, root) if current_version(root) else None
        load = Load(spark, root, next_version(root), old)
        both = rows if old is None else old.read("table", "rows", touched).unionByName(rows)
        load.write(_newest(both, key, version_col, [*cols, "part"]).repartition("part"), "table", "rows", ("part",), touched)
        load.finish()
        publish(root, load.version)
    finally:
        rows.unpersist()


def upsert_stream(sdf: DataFrame, key: str | list[str], version_col: str, target_root: str, checkpoint: str, mode: str = "append",
                  part: Column | None = None):
    """Start a resumable micro-batch upsert into ``target_root``. ``part`` (made from the key or what never changes of a row) names
    the part of the table that a row lies in."""
    key = [key] if isinstance(key, str) else key
    where = F.pmod(F.xxhash64(*key), F.lit(PARTS)) if part is None else part

    def apply(batch: DataFrame, epoch_id: int):
        merge_batch(batch.sparkSession, batch, key, version_col, target_root, where)

    return (sdf.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def upserted(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """The table as the last finished batch left it (empty, with ``schema``, before the first)."""
    if current_version(root) is None:
        return spark.createDataFrame([], schema)
    return Version.open(spark, root).read("table", "rows").drop("part")


#: Batches of the registered streams.
FEED_FILES = 6


def upserted_orders(spark: SparkSession, sf_dir: str, files: int | None = FEED_FILES) -> DataFrame:
    """T-1 over the order stream read twice (overlap): the target ends with one row per order."""
    root = scratch(spark, "orders-upsert")
    part = F.date_format("placed_at", "yyyy-MM")
    q = upsert_stream(order_stream(spark, sf_dir, 2, files), "id", "updated_at", f"{root}/table", f"{root}/checkpoint", part=part)
    q.awaitTermination()
    return upserted(spark, f"{root}/table")


def incremental_stream(spark: SparkSession, changes_dir: str, schema: str, src, root: str, checkpoint: str, per_batch: int | None = None):
    """T-1, warehouse form: each micro-batch of change notifications (column ``max_order_id``) triggers one
    incremental load of the warehouse under ``root`` up to the highest of them (idempotent: a replayed batch changes nothing)."""
    from ..plans.incremental import build_incremental
    from ..plans.publish import PublishedWarehouse

    def apply(batch: DataFrame, epoch_id: int):
        upto = batch.agg(F.max("max_order_id")).first()[0]
        if upto is not None:
            build_incremental(batch.sparkSession, src, root, max(upto, PublishedWarehouse.open(batch.sparkSession, root).max_order_id))

    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    s = reader.parquet(changes_dir)
    return s.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def t02_dedup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = dedup_stream(order_stream(spark, sf_dir, 2, FEED_FILES), ["id", "updated_at"], "updated_at", "5 minutes")
    return run_available(s, "orders-dedup").select(
        "id", "customer_id", "status", F.col("placed_at").cast("timestamp_ntz").alias("placed_at"))


def t03_weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = live_counts(order_stream(spark, sf_dir, 1, FEED_FILES), "placed_at", "7 days", "2 days", "orders-weekly")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "orders", "customers",
                      F.col("last_order_at").cast("timestamp_ntz").alias("last_order_at"))


def t01_upserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserted_orders(spark, sf_dir).select(
        "id", "customer_id", "status", F.col("placed_at").cast("timestamp_ntz").alias("placed_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


STREAMS = {
    "t01_upserted_orders": t01_upserted_orders,
    "t02_dedup_orders": t02_dedup_orders,
    "t03_weekly_counts": t03_weekly_counts,
}

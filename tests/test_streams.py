"""Streams of several batches: the result does not depend on the batches, late rows count, a killed stream goes on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fathom.plans.incremental import build_incremental  # noqa: F401
from fathom.plans.publish import PublishedWarehouse, build_full
from fathom.plans.versions import Version
from fathom.sources.fixtures import Store
from fathom.streaming import jobs

SF = "/root/testdata/sf0.001"


def batches(query):
    return len({p["batchId"] for p in query.recentProgress if p["numInputRows"]})


@pytest.mark.parametrize("files", [None, 1, 7])
def test_upserts_whatever_the_batches(spark, files):
    got = jobs.upserted_orders(spark, SF, files)
    assert got.count() == spark.read.parquet(f"{SF}/orders.parquet").count() == got.select("id").distinct().count()


def test_feed_comes_in_time_order(spark):
    root = jobs.scratch(spark, "order-test")
    seen = []
    s = jobs.order_stream(spark, SF, 1, 6)
    q = s.writeStream.foreachBatch(lambda df, k: seen.append(df.agg(F.min("updated_at"), F.max("updated_at"), F.count("*")).first())) \
        .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    seen = [s for s in seen if s[2]]
    assert len(seen) >= 5 and all(a[1] <= b[0] for a, b in zip(seen, seen[1:]))


def test_dedup_whatever_the_batches(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    for files in (None, 1, 5, 9):
        s = jobs.dedup_stream(jobs.order_stream(spark, SF, 2, files), ["id", "updated_at"], "updated_at", "5 minutes")
        assert jobs.run_available(s, "dedup-test").count() == orders, files


def test_killed_between_batches_and_restarted(spark):
    """Late and older versions in later batches never replace newer ones; a stream that dies in its third batch goes on from there."""
    root = jobs.scratch(spark, "kill-test")
    base = dt.datetime(2000, 1, 1)
    for k in range(6):
        # every batch: some new keys, newer versions of old ones, and versions that are older than what is there
        rows = [(i, k * 100 + i, base + dt.timedelta(hours=24 * k)) for i in range(10 * k, 10 * k + 15)]
        rows += [(i, -k, base - dt.timedelta(hours=k + 1)) for i in range(0, 5)]
        spark.createDataFrame(rows, "id long, v long, at timestamp").coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    part = F.floor(F.col("id") / 10)
    calls = {"n": 0}
    real = jobs.merge_batch

    def dies(*args):
        calls["n"] += 1
        if calls["n"] == 3:
            raise RuntimeError("killed")
        real(*args)

    def start():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        return jobs.upsert_stream(s, "id", "at", f"{root}/table", f"{root}/checkpoint", part=part)

    jobs.merge_batch = dies
    try:
        q = start()
        with pytest.raises(Exception):
            q.awaitTermination()
    finally:
        jobs.merge_batch = real
    assert Version.open(spark, f"{root}/table").version == "v=000002"
    q = start()
    q.awaitTermination()
    assert batches(q) == 4  # the third batch again, and the rest
    want = {}
    for r in spark.read.parquet(f"{root}/in").collect():
        if r.id not in want or r["at"] > want[r.id]["at"]:
            want[r.id] = r
    got = {r.id: r for r in jobs.upserted(spark, f"{root}/table").collect()}
    assert {i: (r.v, r["at"]) for i, r in got.items()} == {i: (r.v, r["at"]) for i, r in want.items()}
    # the last batch holds keys of three parts: no other was written
    last = Version.open(spark, f"{root}/table")
    parts = {r.part for r in last.entries.where(F.col("folder").contains(f"load={last.version[2:]}")).select("part").distinct().collect()}
    assert parts == {"part=0", "part=5", "part=6"} and len(last.parts("table", "rows")) == 7


def test_warehouse_loaded_by_a_stream(spark):
    """Change notifications drive incremental loads; a replayed one changes nothing."""
    base = Store(spark, SF)
    top = base.orders.agg(F.max("id")).first()[0]
    root, changes = jobs.scratch(spark, "wh-stream"), jobs.scratch(spark, "wh-changes")
    build_full(spark, base, root, max_order_id=top // 2)
    for upto in (top * 3 // 4, top // 2, top):
        spark.createDataFrame([(upto,)], "max_order_id long").coalesce(1).write.mode("append").parquet(changes)
    q = jobs.incremental_stream(spark, changes, "max_order_id long", base, root, f"{root}-checkpoint", per_batch=1)
    q.awaitTermination()
    assert batches(q) == 3
    pub = PublishedWarehouse.open(spark, root)
    assert pub.max_order_id == top and pub.fact_orders.count() == base.orders.count()
    q = jobs.incremental_stream(spark, changes, "max_order_id long", base, root, f"{root}-checkpoint", per_batch=1)
    q.awaitTermination()
    assert PublishedWarehouse.open(spark, root).version.version == pub.version.version

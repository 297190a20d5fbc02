"""Incremental load == full build of the same source (C1), stable surrogate keys (E10),
and a repeated run with nothing new changes nothing."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from fathom.operators.quality import compare_warehouses
from changed_store import CHANGE_TS, ChangedStore
from fathom.plans.incremental import build_incremental, changed_versions, merge_dim_product
from fathom.plans.publish import PublishedWarehouse, build_full
from fathom.plans.warehouse import STAR_TABLES, ORDER_TABLES
from fathom.sources.fixtures import Store

SF = "/root/testdata/sf0.001"


def _tables(wh):
    t = {n: wh.table(n).drop("year", "month") if n == "fact_sales" else wh.table(n) for n in STAR_TABLES}
    t.update({f"raw.{n}": wh.raw(n) for n in ORDER_TABLES})
    return t


def test_incremental_equals_full(spark):
    base = Store(spark, SF)
    w = base.orders.agg(F.max("id")).first()[0]
    prev_w = w * 9 // 10
    inc_root = tempfile.mkdtemp(prefix="fathom-inc-", dir="/tmp")
    # the last extract began two minutes after the changes were stamped: only the overlap sees them
    at = dt.datetime.fromisoformat(CHANGE_TS) + dt.timedelta(minutes=2)
    build_full(spark, base, inc_root, max_order_id=prev_w, extracted_at=at)
    before = PublishedWarehouse.open(spark, inc_root)
    keys_before = {(r.product_id, r.valid_from): r.product_key for r in before.dim_product.collect()}

    changed = ChangedStore(base, prev_w)
    info = build_incremental(spark, changed, inc_root)
    assert info["previous_max_order_id"] == prev_w and info["max_order_id"] == w

    full_root = tempfile.mkdtemp(prefix="fathom-full-", dir="/tmp")
    build_full(spark, changed, full_root)
    inc = PublishedWarehouse.open(spark, inc_root)
    full = PublishedWarehouse.open(spark, full_root)
    res = compare_warehouses(_tables(inc), _tables(full), ignore=("product_key",)).collect()
    bad = [r.asDict() for r in res if r.only_a or r.only_b or r.rows_a != r.rows_b]
    assert not bad, bad

    # surrogate keys of versions that existed before did not move
    after = {(r.product_id, r.valid_from): r.product_key for r in inc.dim_product.collect()}
    assert all(after[k] == v for k, v in keys_before.items())
    assert len(set(after.values())) == len(after)

    # a second run with no new changes: nothing changes (overlap is harmless)
    build_incremental(spark, changed, inc_root)
    again = PublishedWarehouse.open(spark, inc_root)
    res2 = compare_warehouses(_tables(again), _tables(full), ignore=("product_key",)).collect()
    assert not [r for r in res2 if r.only_a or r.only_b]


def test_versions_missing_from_the_source_stay(spark, wh):
    dim = wh.dim_product
    gone = dim.orderBy("product_key").first()
    fresh = dim.where(F.col("product_key") != gone.product_key).withColumn(
        "product_name", F.when(F.col("product_id") == 5, F.lit(None).cast("string")).otherwise(F.col("product_name")))
    out = {r.product_key: r for r in merge_dim_product(dim, fresh).collect()}
    before = {r.product_key: r for r in dim.collect()}
    assert out.keys() == before.keys() and out[gone.product_key] == gone
    assert all(r.product_name is None for r in out.values() if r.product_id == 5)
    assert {r.product_id for r in changed_versions(dim, fresh).collect()} == {5}
    assert changed_versions(dim, dim).count() == 0


def test_files_stay_clustered(spark):
    """After an incremental load each month holds no more files than tasks wrote ranges into it."""
    root = tempfile.mkdtemp(prefix="fathom-inc-", dir="/tmp")
    base = Store(spark, SF)
    w = base.orders.agg(F.max("id")).first()[0]
    build_full(spark, base, root, max_order_id=w * 9 // 10)
    files = lambda: len(PublishedWarehouse.open(spark, root).fact_sales.inputFiles())
    before = files()
    build_incremental(spark, base, root)
    assert files() <= before + 12

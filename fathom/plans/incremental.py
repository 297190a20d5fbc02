"""Incremental warehouse load.

A run moves the warehouse from watermark ``prev`` to ``w``:

1. changed orders = new ids in (prev, w]  U  old ids updated since five minutes
   before the last extract began (the overlap is harmless: a changed order is
   replaced whole)  U  orders of returns filed since the last load (one distinct
   DataFrame; ids are never collected or pasted into query text);
2. the delta = every order-table row of a changed order (left semi join);
3. raw order tables: in the blocks of ids that hold a changed order, old rows of
   unchanged orders (left anti join) + the delta; other raw tables only where their
   digest differs from that of the last load;
4. ``dim_product``: surrogate keys stay stable and no version is ever dropped;
   versions whose attributes differ (null-safe) take the new ones, new versions
   are numbered above the current maximum;
5. facts of the delta are built by the same functions as a full build (a
   Warehouse whose raw layer is the delta), then replace the old facts of the
   changed orders in the months that hold them; ``customer_order_number`` is
   renumbered only for customers that have a changed order, from their slots of the
   index by customer, and months where a number moved are written as well;
6. dimensions and marts are rebuilt where one of their inputs changed.

All else is named by the new manifest where it lies. The version is published only
when it is complete.
"""

from __future__ import annotations

import datetime as dt
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.keys import dense_key
from ..session import shared_scratch, written
from ..sources.fixtures import STORE_TABLES, Store, StoreWrittenOnce
from .publish import (MADE_OF, MONTHS, STAR_WAVES, PublishedWarehouse, _PublishedStore, build_full, by_customer, counted_write, day_cuts, etl_runs,
                      finish_run, id_cuts, month_of, next_version, orders_by_day, part_of, utc_now, with_load_conf)
from .versions import Load, Version, digests, run_parallel
from .warehouse import ORDER_TABLES, STAR_TABLES, Warehouse

#: Changes are looked for from so long before the last extract began, so that what was committed while it read is seen.
OVERLAP = dt.timedelta(minutes=5)


# -- E9: changed orders and the delta ----------------------------------------------------
def changed_orders(src: Store, prev: int, w: int, changes_since, max_return_id: int) -> DataFrame:
    """Ids of orders that are new, or stamped at or after ``changes_since``, or have a new return."""
    o = src.table("orders")
    new = o.where((F.col("id") > F.lit(prev)) & (F.col("id") <= F.lit(w))).select("id")
    upd = o.where((F.col("id") <= F.lit(prev)) & (F.col("updated_at") >= F.lit(changes_since))).select("id")
    ret = src.table("returns").where((F.col("id") > F.lit(max_return_id)) & (F.col("order_id") <= F.lit(w))) \
        .select(F.col("order_id").alias("id"))
    return new.union(upd).union(ret).distinct()


class _DeltaWarehouse(Warehouse):
    """The full job's fact functions, fed with the delta's order tables."""

    def __init__(self, store: Store, w: int, delta: dict[str, DataFrame], dim_product: DataFrame,
                 fx_daily: DataFrame):
        super().__init__(store, w)
        self._delta = delta
        self.__dict__["dim_product"] = dim_product
        self.__dict__["fx_rates_daily"] = fx_daily

    @property
    def order_heads(self) -> DataFrame:
        return self.fact_orders

    def raw(self, name: str) -> DataFrame:
        if name in self._delta:
            return self._delta[name]
        return super().raw(name)


# -- E10: dim_product merge with stable keys ---------------------------------------------
def _differs(old: str, new: str, cols: list[str]):
    return reduce(lambda a, b: a | b, [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in cols])


def merge_dim_product(prev_dim: DataFrame, fresh: DataFrame) -> DataFrame:
    """``fresh``: the dimension rebuilt from the current source (its keys are ignored).

    A known version keeps its key; where any attribute differs (``IS DISTINCT FROM``) it takes
    the fresh ones. A version that the source no longer has stays as it was, since facts point
    at it. New versions get keys above the current maximum in (product_id, valid_from) order."""
    bk = ["product_id", "valid_from"]
    cols = [c for c in fresh.columns if c != "product_key"]
    attributes = [c for c in cols if c not in bk]
    max_key = prev_dim.agg(F.max("product_key")).first()[0] or 0
    o, n = prev_dim.alias("o"), fresh.select(*cols).alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in bk])
    found = F.col("n.product_id").isNotNull()
    changed = found & _differs("o", "n", attributes)
    known = o.join(n, on, "left").select(
        "o.product_key", *[F.col(f"o.{k}") for k in bk],
        *[F.when(changed, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in attributes]).select("product_key", *cols)
    new = dense_key(fresh.select(*cols).join(prev_dim.select(*bk), bk, "left_anti"), bk, "product_key", start=max_key + 1)
    return known.unionByName(new.select("product_key", *cols))


def changed_versions(prev_dim: DataFrame, fresh: DataFrame) -> DataFrame:
    """(product_id, valid_from) of known versions with an attribute that is distinct from the source's."""
    bk = ["product_id", "valid_from"]
    attributes = [c for c in fresh.columns if c not in ("product_key", *bk)]
    o, n = prev_dim.alias("o"), fresh.alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in bk])
    return o.join(n, on).where(_differs("o", "n", attributes)).select(*[F.col(f"o.{k}") for k in bk])


# -- E11: renumber order numbers for affected customers ------------------------------------
def renumber_orders(fact_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Recompute customer_order_number only for the given customers (semi join); the rest
    keep their stored numbers."""
    aff = fact_orders.join(customers.select("customer_id").distinct(), "customer_id", "left_semi")
    keep = fact_orders.join(customers.select("customer_id").distinct(), "customer_id", "left_anti")
    w = Window.partitionBy("customer_id").orderBy("placed_at", "order_id")
    fixed = aff.withColumn("customer_order_number", F.row_number().over(w))
    return keep.unionByName(fixed.select(*fact_orders.columns))


def _months(dates: DataFrame) -> set[str]:
    """Parts (``year=Y/month=M``) of the order dates in the only column of ``dates``."""
    day = F.col(dates.columns[0])
    return {f"year={r.y}/month={r.m}" for r in dates.select(F.year(day).alias("y"), F.month(day).alias("m")).distinct().collect()}


def _parts(ids: DataFrame, size: int, name: str) -> set[str]:
    """Parts (blocks or slots) of the ids in the only column of ``ids``."""
    return {f"{name}={r.p}" for r in ids.select(part_of(F.col(ids.columns[0]), size).alias("p")).distinct().collect()}


@with_load_conf
def build_incremental(spark: SparkSession, src: Store, root: str, w: int | None = None,
                      publish_version: bool = True, extracted_at: dt.datetime | None = None) -> dict:
    """Bring the published warehouse under ``root`` up to watermark ``w`` from ``src``.

    Only what changed is written: blocks of order tables and months of facts that hold changed
    orders, slots of their customers, and tables whose digest (or whose inputs' digest) differs.
    ``extracted_at``: the source's clock as this extract begins (default: now, UTC)."""
    t0 = time.time()
    data_until = extracted_at or utc_now()
    prev = PublishedWarehouse.open(spark, root)
    old, info = prev.version, prev.info
    prev_w, sizes = int(info["max_order_id"]), {"block": info["block"], "slot": info["slot"]}
    w = w if w is not None else int(src.table("orders").agg(F.max("id")).first()[0])
    max_ret = prev.raw("returns").agg(F.max("id")).first()[0] or 0
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    load = Load(spark, root, next_version(root), old)
    steps: list = []

    def step(layer, name, df, replaces=None, digest=None, cuts=None):
        counted_write(load, df, layer, name, n, sizes, steps, replaces, digest, cuts)

    # written once: every table below is cut by the same ids
    changed = written(changed_orders(src, prev_w, w, info["data_until"] - OVERLAP, max_ret), "changed-orders")
    blocks = _parts(changed, sizes["block"], "block")
    # new orders lie above a literal bound, which reaches the scan; ids are only joined for older ones, where any changed
    newer, older = changed.where(F.col("id") > F.lit(prev_w)), changed.where(F.col("id") <= F.lit(prev_w))
    any_older = not older.isEmpty()

    def of_changed(rows, key):
        """Rows of changed orders."""
        new = rows.where((F.col(key) > F.lit(prev_w)) & (F.col(key) <= F.lit(w))).join(newer.withColumnRenamed("id", key), key, "left_semi")
        return new.unionByName(rows.where(F.col(key) <= F.lit(prev_w)).join(older.withColumnRenamed("id", key), key, "left_semi")) if any_older else new

    def of_others(rows, key):
        """Rows that the last version has of unchanged orders: none of them is above its watermark."""
        return rows.join(older.withColumnRenamed("id", key), key, "left_anti") if any_older else rows

    # raw order tables: blocks that hold changed orders; other raw tables: those that differ
    block = F.concat(F.lit("block="), part_of(F.col("id"), sizes["block"]))
    near = {"order_id": id_cuts(src.table("orders").where((F.col("id") <= F.lit(w)) & block.isin(*blocks)), n)} if blocks else None

    def order_table(name, key):
        rows = of_others(old.read("raw", name, blocks).drop("block"), key).unionByName(of_changed(src.table(name), key))
        step("raw", name, rows, blocks, cuts=near)

    now = digests({t: src.table(t) for t in STORE_TABLES if t not in ORDER_TABLES})
    differ = {t for t, d in now.items() if d != old.digest("raw", t)}
    run_parallel([(lambda t=t, k=k: order_table(t, k),) for t, k in ORDER_TABLES.items() if blocks]
                 + [(lambda t=t: step("raw", t, src.table(t), digest=now[t]),) for t in differ], lambda job: job())
    if blocks:
        differ.add("orders")
    fresh = Warehouse(_PublishedStore(load), w)
    if "fx_rates" in differ:
        step("raw", "fx_rates_daily", fresh.fx_rates_daily)

    if differ & set(MADE_OF["dim_product"]):
        merged = merge_dim_product(prev.dim_product, written(fresh.dim_product, "dim-product"))
        step("dw", "dim_product", merged)

    rebuilt = PublishedWarehouse(load, raw_only=True)
    done = ("dim_product", "fact_orders", "fact_sales", "fact_returns")
    if blocks:
        def delta_of(name):
            return of_changed(load.read("raw", name, blocks).drop("block"), ORDER_TABLES[name])

        dwh = _DeltaWarehouse(_PublishedStore(load), w, {t: delta_of(t) for t in ORDER_TABLES}, load.read("dw", "dim_product"),
                              load.read("raw", "fx_rates_daily"))
        dwh.__dict__["fact_orders"] = delta = written(dwh.fact_orders, "delta-orders")
        before = old.read("raw", "orders", blocks).join(older, "id", "left_semi").select("customer_id", F.col("placed_at").cast("date").alias("order_date"))
        touched = written(before.unionByName(delta.select("customer_id", "order_date")), "touched")
        months, slots = _months(touched.select("order_date")), _parts(touched.select("customer_id"), sizes["slot"], "slot")

        # numbers of affected customers' orders, from the slots that hold them; an order whose number moves rewrites its month
        listed = old.read("idx", "orders_by_customer", slots).drop("slot")
        customers = renumber_orders(of_others(listed, "order_id").unionByName(by_customer(delta)), touched)
        step("idx", "orders_by_customer", customers, slots)
        numbers = load.read("idx", "orders_by_customer", slots).select("order_id", "order_date", F.col("customer_order_number").alias("_no"))
        # changed orders count as moved: the delta numbers them among themselves only
        moved = written(numbers.join(of_others(listed.select("order_id", "customer_order_number"), "order_id"), "order_id", "left")
                        .where(~F.col("customer_order_number").eqNullSafe(F.col("_no"))).drop("customer_order_number"), "renumbered")
        renumbered = months | _months(moved.select("order_date"))

        cols = [f.name for f in old.schema("dw", "fact_orders") if f.name not in MONTHS]
        kept = of_others(old.read("dw", "fact_orders", renumbered).select(*cols), "order_id")
        orders = kept.unionByName(delta.select(*cols)).join(moved.select("order_id", "_no"), "order_id", "left")
        orders = orders.withColumn("customer_order_number", F.coalesce("_no", "customer_order_number")).select(*cols)

        def facts(name):
            cols = [f.name for f in old.schema("dw", name) if f.name not in MONTHS]
            return of_others(old.read("dw", name, months).select(*cols), "order_id").unionByName(getattr(dwh, name).select(*cols))

        days = orders_by_day(load.read("raw", "orders"))

        def cuts(parts):
            return {"order_date": day_cuts([(day, c) for day, c in days if month_of(day) in parts], n)}

        # product keys never move, so sales and returns of unchanged orders are taken as they are; one after the other, as
        # each fills the cluster and its shuffle files lie on disk until it ends
        step("dw", "fact_orders", orders, renumbered, cuts=cuts(renumbered))
        step("dw", "fact_sales", facts("fact_sales"), months, cuts=cuts(months))
        step("dw", "fact_returns", facts("fact_returns"), months, cuts=cuts(months))

    for name in STAR_TABLES:
        if name in done or not differ & set(MADE_OF[name]):
            rebuilt.mark_written(name)
    for wave in STAR_WAVES:
        todo = [t for t in wave if t not in rebuilt._written]
        run_parallel([("dw", t, rebuilt.table(t)) for t in todo], step)
        for t in todo:
            rebuilt.mark_written(t)

    finish_run(load, "incremental", w, data_until, t0, sizes, steps, publish_version)
    return {"version": load.version, "path": load.path, "max_order_id": w, "previous_max_order_id": prev_w,
            "steps": steps, "seconds": round(time.time() - t0, 3)}


# -- E16/E17: additive upserts and stock movements ---------------------------------------------
def upsert_add(df: DataFrame, new: DataFrame, keys: list[str], qty: str) -> DataFrame:
    """Insert new keys, add quantities for existing ones (one grouped union, no row updates)."""
    cols = df.columns
    u = df.unionByName(new.select(*cols))
    others = [c for c in cols if c not in keys and c != qty]
    return u.groupBy(*keys).agg(F.sum(qty).cast(df.schema[qty].dataType).alias(qty),
                                *[F.max(c).alias(c) for c in others]).select(*cols)


def apply_stock(inventory: DataFrame, sold: DataFrame, returned: DataFrame) -> DataFrame:
    """inventory(warehouse_id, product_id, quantity_on_hand, ...) minus sold lines plus lines of
    newly cancelled orders; movements are aggregated per key before the join."""
    mv = sold.select("warehouse_id", "product_id", (-F.col("quantity")).alias("d")).unionByName(
        returned.select("warehouse_id", "product_id", F.col("quantity").alias("d")))
    agg = mv.groupBy("warehouse_id", "product_id").agg(F.sum("d").alias("d"))
    j = inventory.join(agg, ["warehouse_id", "product_id"], "left")
    return j.withColumn("quantity_on_hand", (F.col("quantity_on_hand") + F.coalesce("d", F.lit(0))).cast("int")) \
        .drop("d")


# -- registered: a warehouse loaded up to nine tenths of the orders, then brought up to date -----------------------
def over_written_store(wh: Warehouse) -> Warehouse:
    """The warehouse over a store that writes what most of its tables are derived from (once per warehouse)."""
    once = wh.__dict__.get("_over_written")
    if once is None:
        once = Warehouse(StoreWrittenOnce(wh.spark, wh.store.sf_dir), wh._w) if type(wh.store) is Store else wh
        wh.__dict__["_over_written"] = once
    return once


def _loaded_once(wh: Warehouse) -> str:
    """Full load of the older orders, in a fresh folder of the shared scratch (once per warehouse)."""
    root = wh.__dict__.get("_one_load")
    if root is None:
        root, src = shared_scratch(wh.spark, "incremental"), over_written_store(wh)
        build_full(wh.spark, src.store, root, max_order_id=src.max_order_id * 9 // 10)
        wh.__dict__["_one_load"] = root
    return root


def _loaded_in_two(wh: Warehouse) -> tuple[str, PublishedWarehouse]:
    """Full load of the older orders, incremental load of the rest (once per warehouse)."""
    root = wh.__dict__.get("_two_loads")
    if root is None:
        root = _loaded_once(wh)
        build_incremental(wh.spark, over_written_store(wh).store, root)
        wh.__dict__["_two_loads"] = root
    return root, PublishedWarehouse.open(wh.spark, root)


def first_load(wh: Warehouse) -> PublishedWarehouse:
    """The version that the full load of the older orders published; no other load is run for it."""
    root = _loaded_once(wh)
    return PublishedWarehouse(Version(wh.spark, root, "v=000001"))


def e09_incremental_sales(wh: Warehouse) -> DataFrame:
    """Sales after a full and an incremental load: those of one full load, versions by business key."""
    _, pub = _loaded_in_two(wh)
    dp = pub.dim_product.select("product_key", "valid_from")
    return pub.fact_sales.join(dp, "product_key").select("order_id", "line_no", "order_date", "customer_id", "product_id", "valid_from",
                                                         "quantity", "net_usd", "margin_usd")


def e11_incremental_order_numbers(wh: Warehouse) -> DataFrame:
    """Orders after a full and an incremental load, each numbered among its customer's."""
    _, pub = _loaded_in_two(wh)
    return pub.fact_orders.select("order_id", "customer_id", "status", "total_usd", F.col("customer_order_number").cast("bigint").alias("customer_order_number"))


def e14_etl_runs(wh: Warehouse) -> DataFrame:
    """The history after two loads: mode and watermark of each run."""
    root, _ = _loaded_in_two(wh)
    return etl_runs(wh.spark, root).select("version", "mode", "max_order_id")


def _cart_twice(wh: Warehouse) -> DataFrame:
    return wh.raw("cart_items").select("cart_id", "product_id", "quantity")


def e16_cart_upsert(wh: Warehouse) -> DataFrame:
    """Every cart's own lines put into it once more, and one line of the next product: quantities add up, new lines appear."""
    items = _cart_twice(wh)
    more = items.unionByName(items.groupBy("cart_id").agg((F.max("product_id") + 1).alias("product_id")).withColumn("quantity", F.lit(1)))
    return upsert_add(items, more, ["cart_id", "product_id"], "quantity")


def e17_stock_after_orders(wh: Warehouse) -> DataFrame:
    """Stock less the lines of pending orders plus those of cancelled ones."""
    lines = wh.raw("order_items").join(wh.raw("orders").select(F.col("id").alias("order_id"), "status"), "order_id")
    inv = wh.raw("inventory").select("warehouse_id", "product_id", "quantity_on_hand")
    return apply_stock(inv, lines.where("status = 'pending'"), lines.where("status = 'cancelled'"))


LOADS = {f.__name__: f for f in (e09_incremental_sales, e11_incremental_order_numbers, e14_etl_runs, e16_cart_upsert, e17_stock_after_orders)}

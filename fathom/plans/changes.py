"""What a store does in a day, as events, and the source after them.

``day_of_changes`` derives a batch of events from a store: old paid orders ship, shipped ones
arrive, some are cancelled, lines come back, products get new prices (several a
product, some dated back, some that change nothing) and new names. ``ChangedSource`` is the
store after any batch of events: the latest event of an order decides its status, prices
are folded into version intervals (``fold_events``), returns are added once.
Applying a batch twice gives what applying it once gives.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scd2 import fold_events
from ..session import written
from ..sources.fixtures import Store
from .warehouse import Warehouse

EVENTS = ["event_id", "kind", "order_id", "line_no", "product_id", "at", "price_usd", "name"]
STATUS = {"ship": "shipped", "deliver": "delivered", "cancel": "cancelled"}
#: New ids of returns lie above all ids of the store.
RETURN_IDS = 10 ** 12

_STEP = dt.timedelta(hours=1)


def day_of_changes(store: Store, upto: int, at: dt.datetime) -> DataFrame:
    """Events of a day that begins at ``at``, on orders with ids up to ``upto``. An order has at most one status event."""
    price = "decimal(12,2)"

    def events(df: DataFrame, kind: str, number: int, when: Column | dt.datetime, order=None, line=None, product=None, value=None, name=None) -> DataFrame:
        none = lambda t: F.lit(None).cast(t)
        subject = product if product is not None else order
        return df.select((subject * 16 + number).cast("long").alias("event_id"), F.lit(kind).alias("kind"), (order if order is not None else none("long")).alias("order_id"),
                         (line if line is not None else none("int")).cast("int").alias("line_no"), (product if product is not None else none("long")).alias("product_id"),
                         (when if isinstance(when, Column) else F.lit(when)).cast("timestamp_ntz").alias("at"),
                         (value if value is not None else none(price)).cast(price).alias("price_usd"), (name if name is not None else none("string")).alias("name"))

    old = store.table("orders").where(F.col("id") <= F.lit(upto))
    oid, pid = F.col("id"), F.col("id")
    paid, pending = F.col("status") == "paid", F.col("status") == "pending"
    cancel = (paid | pending) & (oid % 29 == 3)
    out = [events(old.where(paid & (oid % 13 == 1) & ~cancel), "ship", 1, at, order=oid),
           events(old.where((F.col("status") == "shipped") & (oid % 17 == 2)), "deliver", 2, at + _STEP, order=oid),
           events(old.where(cancel), "cancel", 3, at + 2 * _STEP, order=oid)]
    lines = store.table("order_items").where("line_no = 1").join(
        old.where((F.col("status") == "delivered") & (oid % 31 == 4)).select(oid.alias("order_id")), "order_id")
    lines = lines.join(store.table("returns").select("order_id", "line_no"), ["order_id", "line_no"], "left_anti")
    out.append(events(lines, "return", 4, at + 3 * _STEP, order=F.col("order_id"), line=F.col("line_no"), value=F.col("unit_price")))
    products = store.table("products")
    more = lambda p: F.round(F.col("price_usd") * F.lit(p).cast("decimal(5,3)"), 2)
    repriced = products.where(pid % 7 == 0)
    out += [events(repriced, "reprice", 5, at, product=pid, value=more("1.100")),
            events(repriced, "reprice", 6, at + _STEP, product=pid, value=more("1.100")),  # says the same again
            events(repriced.where(pid % 2 == 0), "reprice", 7, at + 2 * _STEP, product=pid, value=more("1.210")),
            events(repriced.where(pid % 3 == 0), "reprice", 8, at - dt.timedelta(days=400), product=pid, value=more("0.950")),  # comes late
            events(repriced.where(pid % 5 == 0), "reprice", 9, at + 3 * _STEP, product=pid),  # taken off the list
            events(products.where(pid % 97 == 0), "rename", 10, at, product=pid, name=F.concat("name", F.lit(" (renamed)")))]
    return reduce(DataFrame.unionByName, out)


class ChangedSource(Store):
    """The source ``base`` after ``events``."""

    def __init__(self, base: Store, events: DataFrame):
        super().__init__(base.spark, base.sf_dir)
        self.base = base
        self.events = written(events, "events")  # one batch, read by several tables

    @cached_property
    def _status(self) -> DataFrame:
        """The latest status event of each order."""
        its = self.events.where(F.col("kind").isin(*STATUS))
        return its.groupBy(F.col("order_id").alias("_order")).agg(F.max_by(F.struct("kind", "at"), F.struct("at", "event_id")).alias("_e"))

    @cached_property
    def orders(self) -> DataFrame:
        o = self.base.table("orders")
        kind = F.col("_e.kind")
        status = F.coalesce(*[F.when(kind == k, s) for k, s in STATUS.items()], F.col("status"))
        return o.join(self._status, o["id"] == F.col("_order"), "left").withColumns(
            {"status": status, "updated_at": F.coalesce("_e.at", "updated_at")}).select(*o.columns)

    @cached_property
    def shipments(self) -> DataFrame:
        """Parcels of orders that ship or arrive get their times."""
        s = self.base.table("shipments")
        kind, at = F.col("_e.kind"), F.col("_e.at")
        sent = kind.isin("ship", "deliver") & F.col("shipped_at").isNull()
        arrived = (kind == "deliver") & F.col("delivered_at").isNull()
        return s.join(self._status, s["order_id"] == F.col("_order"), "left").withColumns({
            "status": F.when(arrived, "delivered").when(sent, "in_transit").otherwise(F.col("status")),
            "shipped_at": F.when(sent, at).otherwise(F.col("shipped_at")),
            "delivered_at": F.when(arrived, at).otherwise(F.col("delivered_at"))}).select(*s.columns)

    @cached_property
    def returns(self) -> DataFrame:
        """One return a line: a line that has one is not returned again."""
        r = self.base.table("returns")
        new = self.events.where("kind = 'return'").groupBy("order_id", "line_no").agg(F.min_by(F.struct("at", "price_usd"), F.struct("at", "event_id")).alias("_e"))
        new = new.join(r.select("order_id", F.col("line_no").cast("int").alias("line_no")), ["order_id", "line_no"], "left_anti")
        values = {"id": F.lit(RETURN_IDS) + F.col("order_id") * 100 + F.col("line_no"), "quantity": F.lit(1), "reason": F.lit("changed_mind"),
                  "status": F.lit("requested"), "refund_amount": F.col("_e.price_usd"), "requested_at": F.col("_e.at")}
        new = new.withColumns(values)
        return r.unionByName(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in r.schema.fields]))

    @cached_property
    def product_prices(self) -> DataFrame:
        prices = self.events.where("kind = 'reprice'").select("product_id", "at", "price_usd", "event_id")
        base = self.base.table("product_prices")
        return fold_events(base, prices, "product_id", "price_usd").select(*base.columns)

    @cached_property
    def products(self) -> DataFrame:
        """Products carry the price now in force (the old one where none is) and their latest name."""
        p = self.base.table("products")
        now = self.product_prices.where("valid_to IS NULL").select(F.col("product_id").alias("_priced"), F.col("price_usd").alias("_price"))
        touched = self.events.where("kind = 'reprice'").select(F.col("product_id").alias("_priced")).distinct()
        names = self.events.where("kind = 'rename'").groupBy(F.col("product_id").alias("_named")).agg(F.max_by("name", F.struct("at", "event_id")).alias("_name"))
        j = p.join(now.join(touched, "_priced"), p["id"] == F.col("_priced"), "left").join(names, p["id"] == F.col("_named"), "left")
        return j.withColumns({"price_usd": F.coalesce("_price", "price_usd"), "name": F.coalesce("_name", "name")}).select(*p.columns)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name) if name in ("orders", "shipments", "returns", "product_prices", "products") else self.base.table(name)


def next_day(wh: Warehouse) -> dt.datetime:
    """Midnight after the newest order."""
    newest = wh.raw("orders").agg(F.max("placed_at")).first()[0]
    return dt.datetime.combine(newest.date() + dt.timedelta(days=1), dt.time())


def _after(wh: Warehouse) -> ChangedSource:
    return ChangedSource(wh.store, day_of_changes(wh.store, wh.max_order_id, next_day(wh)))


def e12_changed_orders(wh: Warehouse) -> DataFrame:
    """Every order after a day of changes, with its parcels and returned lines."""
    src = _after(wh)
    parcels = src.shipments.groupBy("order_id").agg(F.count("shipped_at").alias("sent"), F.count("delivered_at").alias("arrived"))
    back = src.returns.groupBy("order_id").agg(F.count(F.lit(1)).alias("returned"))
    o = src.orders.select(F.col("id").alias("order_id"), "status", "updated_at").join(parcels, "order_id", "left").join(back, "order_id", "left")
    return o.select("order_id", "status", "updated_at", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("sent", "arrived", "returned")])


def e13_price_versions(wh: Warehouse) -> DataFrame:
    """Price versions after a day of changes: several events a product, late ones and ones that change nothing."""
    return _after(wh).product_prices.select("product_id", "valid_from", "valid_to", "price_usd")


def e13_renamed_products(wh: Warehouse) -> DataFrame:
    """Products with the price now in force and their latest name."""
    return _after(wh).products.select("id", "name", "price_usd")


CHANGES = {f.__name__: f for f in (e12_changed_orders, e13_price_versions, e13_renamed_products)}

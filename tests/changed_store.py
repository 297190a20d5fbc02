"""A source after a batch of store activity, for the incremental tests."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.sources.fixtures import Store

CHANGE_TS = "2001-09-01 10:00:00"


# -- E12/E13: a deterministic change set applied to the source ---------------------------
class ChangedStore(Store):
    """The source after a batch of store activity: shipped, delivered and cancelled orders,
    new returns, price changes (new SCD2 versions) and renamed products."""

    def __init__(self, base: Store, prev_max_order_id: int, at: str = CHANGE_TS):
        super().__init__(base.spark, base.sf_dir)
        self.base = base
        self.prev = prev_max_order_id
        self.at = at

    def _ts(self):
        return F.to_timestamp_ntz(F.lit(self.at))

    @cached_property
    def orders(self) -> DataFrame:
        o = self.base.orders
        old = F.col("id") <= F.lit(self.prev)
        ship = old & (F.col("status") == "paid") & (F.col("id") % 13 == 1)
        deliver = old & (F.col("status") == "shipped") & (F.col("id") % 17 == 2)
        cancel = old & F.col("status").isin("paid", "pending") & (F.col("id") % 29 == 3)
        status = (F.when(cancel, "cancelled").when(deliver, "delivered").when(ship, "shipped")
                  .otherwise(F.col("status")))
        touched = ship | deliver | cancel
        # both new values are computed from the old row (one projection)
        return o.withColumns({"status": status,
                              "updated_at": F.when(touched, self._ts()).otherwise(F.col("updated_at"))})

    @cached_property
    def shipments(self) -> DataFrame:
        """Parcels of the orders that were shipped or delivered get their times."""
        now = self.orders.select(F.col("id").alias("order_id"), F.col("status").alias("_now"))
        was = self.base.orders.select(F.col("id").alias("order_id"), F.col("status").alias("_was"))
        s = self.base.shipments.join(now, "order_id").join(was, "order_id")
        sent = (F.col("_was") != F.col("_now")) & F.col("_now").isin("shipped", "delivered")
        s = s.withColumn("shipped_at", F.when(sent & F.col("shipped_at").isNull(), self._ts()).otherwise(F.col("shipped_at")))
        s = s.withColumn("delivered_at", F.when(sent & (F.col("_now") == "delivered"), self._ts()).otherwise(F.col("delivered_at")))
        return s.select(*self.base.shipments.columns)

    @cached_property
    def returns(self) -> DataFrame:
        """Existing returns plus new ones filed at the change time on old delivered lines."""
        r = self.base.returns
        o = self.base.orders.where((F.col("status") == "delivered") & (F.col("id") <= F.lit(self.prev))
                                   & (F.col("id") % 31 == 4)).select(F.col("id").alias("order_id"))
        li = self.base.order_items.join(o, "order_id").where(F.col("line_no") == 1)
        li = li.join(r.select("order_id", "line_no"), ["order_id", "line_no"], "left_anti")
        new = li.select((F.lit(10 ** 12) + F.col("order_id") * 100 + F.col("line_no")).alias("id"), "order_id", "line_no",
                        F.lit(1).alias("quantity"), F.lit("changed_mind").alias("reason"),
                        F.lit("refunded").alias("status"), F.col("unit_price").alias("refund_amount"),
                        self._ts().alias("requested_at"))
        return r.unionByName(new)

    @cached_property
    def products(self) -> DataFrame:
        p = self.base.products
        p = p.withColumn("price_usd", F.when(F.col("id") % 89 == 0, F.round(F.col("price_usd") * F.lit(1.10).cast("decimal(3,2)"), 2)
                                             .cast("decimal(12,2)")).otherwise(F.col("price_usd")))
        return p.withColumn("name", F.when(F.col("id") % 97 == 0, F.concat(F.col("name"), F.lit(" (new)")))
                            .otherwise(F.col("name")))

    @cached_property
    def product_prices(self) -> DataFrame:
        """Repriced products (+10%): the open version closes at the change time and a new one opens."""
        pp = self.base.product_prices
        hit = (F.col("product_id") % 89 == 0) & F.col("valid_to").isNull()
        closed = pp.withColumn("valid_to", F.when(hit, self._ts()).otherwise(F.col("valid_to")))
        new = pp.where(hit).select("product_id", self._ts().alias("valid_from"),
                                   F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                                   F.round(F.col("price_usd") * F.lit(1.10).cast("decimal(3,2)"), 2)
                                   .cast("decimal(12,2)").alias("price_usd"))
        return closed.unionByName(new)

    def table(self, name: str) -> DataFrame:
        if name in ("orders", "shipments", "returns", "products", "product_prices"):
            return getattr(self, name)
        return self.base.table(name)

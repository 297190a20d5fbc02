"""The star schema: raw layer, dimensions, facts and marts as DataFrame jobs.

Everything is lazy: a ``Warehouse`` hands out DataFrames, and ``build_full``
writes them (see ``publish``). Design choices for large inputs:

* the watermark is one scalar ``max(id)`` action, then a literal filter that
  Parquet pushes down;
* the daily fx calendar (currencies x days) is bounded by the calendar, not
  by the data, so it is broadcast; other dimensions are left to AQE, which
  broadcasts them only after measuring them;
* the per-order inputs of ``fact_orders`` (lines, payments, shipments,
  returns) are aggregated per ``order_id`` first, so every join is 1:1 on the
  same hash partitioning;
* no global windows: surrogate keys come from ``dense_key``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.money import line_net, to_usd
from ..functions.numeric import dround
from ..functions.timefn import date_key, minutes_between_boundaries
from ..operators.hierarchy import closure, flatten_tree
from ..operators.keys import dense_key
from ..operators.pairs import BULK, frequent, top_partners
from ..operators.topk import keep_one, top_k
from ..sources.fixtures import Store

ORDER_TABLES = {"orders": "id", "order_items": "order_id", "payments": "order_id", "shipments": "order_id",
                "returns": "order_id"}


def watermark(df: DataFrame, key: str = "id") -> int:
    """max(key) as a Python int: one small aggregate, used afterwards as a literal."""
    v = df.agg(F.max(key)).first()[0]
    return int(v) if v is not None else 0


def extract(df: DataFrame, key: str, max_key: int) -> DataFrame:
    return df.where(F.col(key) <= F.lit(max_key))


def daily_rates(fx: DataFrame, horizon_days: int = 365) -> DataFrame:
    """One rate per currency per calendar day; weekends/holidays carry the last business rate.

    Days run from the first rate of all currencies to the last + horizon; days
    before a currency's first rate have no row.
    """
    b = fx.groupBy("currency_code").agg(F.min("rate_date").alias("lo"), F.max("rate_date").alias("hi"))
    b = b.select("currency_code", F.min("lo").over(Window.partitionBy()).alias("lo"),
                 F.max("hi").over(Window.partitionBy()).alias("hi"))
    days = b.select("currency_code", F.explode(F.sequence("lo", F.date_add("hi", horizon_days))).alias("day"))
    j = days.join(fx.withColumnRenamed("rate_date", "day"), ["currency_code", "day"], "left")
    w = Window.partitionBy("currency_code").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    out = j.select("currency_code", "day", F.last("units_per_usd", ignorenulls=True).over(w).alias("units_per_usd"))
    return out.where(F.col("units_per_usd").isNotNull())


class Warehouse:
    def __init__(self, store: Store, max_order_id: int | None = None):
        self.store = store
        self.spark: SparkSession = store.spark
        self._w = max_order_id

    @cached_property
    def max_order_id(self) -> int:
        return self._w if self._w is not None else watermark(self.store.orders.select("id"))

    def raw(self, name: str) -> DataFrame:
        df = self.store.table(name)
        if name in ORDER_TABLES:
            df = extract(df, ORDER_TABLES[name], self.max_order_id)
        return df

    @cached_property
    def last_day(self):
        """Day of the newest order up to the watermark (cancelled included); a literal for filters."""
        newest = self.raw("orders").agg(F.max("placed_at")).first()[0]
        return newest.date() if newest is not None else None

    # -- few rows by key ------------------------------------------------------------------------
    @cached_property
    def watermark_customer(self) -> int:
        """The customer of the newest order."""
        return self.order_rows("orders", [self.max_order_id]).select("customer_id").first()[0]

    def orders_of(self, customer_id: int) -> DataFrame:
        """Orders of one customer: order_id, placed_at, status, currency_code, total."""
        o = self.raw("orders").where(F.col("customer_id") == customer_id)
        return o.select("customer_id", F.col("id").alias("order_id"), "placed_at", "status", "currency_code", "total")

    def order_facts_of(self, customer_id: int) -> DataFrame:
        """Order facts of one customer: order_id, placed_at, status, line_count, total_usd."""
        return self.fact_orders.where(F.col("customer_id") == customer_id)

    def order_rows(self, name: str, order_ids: list[int]) -> DataFrame:
        """Rows of an order table that belong to a few orders."""
        return self.raw(name).where(F.col(ORDER_TABLES[name]).isin(order_ids))

    def order_with_lines(self, order_id: int) -> DataFrame:
        """One order and its lines: a row per line (O9); an order without lines has one row."""
        o = self.order_rows("orders", [order_id]).select(F.col("id").alias("order_id"), "customer_id", "placed_at", "status", "currency_code", "total")
        li = self.order_rows("order_items", [order_id]).select("order_id", "line_no", "product_id", "quantity", "unit_price", "discount")
        return o.join(li, "order_id", "left")

    def sales_after(self, after, upto=None) -> DataFrame:
        """Sales with ``after`` < order_date (<= ``upto``). Where the table is partitioned by year and month, the same
        bounds are put on those, so other months are not even listed."""
        fs = self.fact_sales
        cond = F.col("order_date") > F.lit(after)
        if upto is not None:
            cond = cond & (F.col("order_date") <= F.lit(upto))
        if {"year", "month"} <= set(fs.columns):
            month = F.col("year") * 12 + F.col("month")
            cond = cond & (month >= after.year * 12 + after.month)
            if upto is not None:
                cond = cond & (month <= upto.year * 12 + upto.month)
        return fs.where(cond)

    @cached_property
    def fx_rates_daily(self) -> DataFrame:
        return daily_rates(self.raw("fx_rates"))

    # -- dimensions -------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        o = self.raw("orders")
        b = o.agg(F.min("placed_at").cast("date").alias("lo"),
                  F.date_add(F.max("placed_at").cast("date"), 365).alias("hi"))
        d = b.select(F.explode(F.sequence("lo", "hi")).alias("date"))
        dd = F.col("date")
        return d.select(
            date_key(dd).alias("date_key"), dd.alias("date"), F.year(dd).alias("year"),
            F.quarter(dd).alias("quarter"), F.month(dd).alias("month"),
            F.date_format(dd, "MMMM").alias("month_name"), F.date_format(dd, "yyyy-MM").alias("year_month"),
            F.weekofyear(dd).alias("iso_week"), (F.weekday(dd) + 1).alias("iso_day_of_week"),
            F.date_format(dd, "EEEE").alias("day_name"), (F.weekday(dd) >= 5).alias("is_weekend"))

    @cached_property
    def dim_category(self) -> DataFrame:
        t = flatten_tree(self.raw("categories"), "id", "parent_id", "name", levels=4)
        return t.select(F.col("id").alias("category_id"), F.col("name").alias("category"), "depth", "path",
                        "path_text", "level1", "level2", "level3", "level4", "is_leaf")

    @cached_property
    def dim_product(self) -> DataFrame:
        pp = self.raw("product_prices")
        p = self.raw("products").select(
            F.col("id").alias("product_id"), "sku", F.col("name").alias("product_name"), "brand_id", "category_id",
            "cost_usd", "attributes", "is_active")
        b = self.raw("brands").select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
        dc = self.dim_category.select("category_id", F.col("level1").alias("category_l1"),
                                      F.col("level2").alias("category_l2"), F.col("category").alias("category_leaf"),
                                      F.col("path_text").alias("category_path"))
        j = pp.join(p, "product_id").join(b, "brand_id").join(dc, "category_id")
        rows = j.select(
            "product_id", "sku", "product_name", "brand", "category_id", "category_l1", "category_l2",
            "category_leaf", "category_path", F.col("price_usd").alias("list_price_usd"), "cost_usd",
            F.get_json_object("attributes", "$.color").alias("color"),
            F.get_json_object("attributes", "$.warranty_months").cast("int").alias("warranty_months"),
            "is_active", "valid_from",
            F.coalesce("valid_to", F.to_timestamp_ntz(F.lit("9999-12-31 00:00:00"))).alias("valid_to"),
            F.col("valid_to").isNull().alias("is_current"))
        keyed = dense_key(rows, ["product_id", "valid_from"], "product_key")
        return keyed.select("product_key", *rows.columns)

    @cached_property
    def dim_employee(self) -> DataFrame:
        e = self.raw("employees").select("id", "manager_id", F.concat_ws(" ", "first_name", "last_name").alias("name"),
                                         "title", "department", "region")
        t = flatten_tree(e, "id", "manager_id", "name", levels=0, extra=["title", "department", "region"])
        return t.select(F.col("id").alias("employee_id"), "manager_id", "name", "title", "department", "region",
                        (F.col("depth") - 1).alias("level"), F.col("path_ids").alias("management_chain_ids"),
                        F.col("path_text").alias("management_chain"))

    @cached_property
    def referral(self) -> DataFrame:
        return closure(self.raw("customers"), "id", "referred_by_customer_id")

    @cached_property
    def dim_customer(self) -> DataFrame:
        c = self.raw("customers")
        co = self.raw("countries").select(F.col("code").alias("country_code"), F.col("name").alias("country"),
                                          "region", "currency_code")
        r = self.referral.select(F.col("id").alias("customer_id"), F.col("depth").alias("referral_depth"),
                                 F.col("root_id").alias("referral_root_id"))
        e = self.dim_employee.select(F.col("employee_id").alias("account_manager_id"),
                                     F.col("name").alias("account_manager"))
        j = (c.withColumnRenamed("id", "customer_id").join(F.broadcast(co), "country_code")
             .join(r, "customer_id").join(e, "account_manager_id", "left"))
        return j.select(
            "customer_id", F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "email", "segment",
            "country_code", "country", "region", "currency_code", F.col("created_at").alias("signup_at"),
            F.trunc(F.col("created_at").cast("date"), "month").alias("cohort_month"), "referred_by_customer_id",
            "referral_depth", "referral_root_id", "account_manager_id", "account_manager")

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        w = self.raw("warehouses")
        co = self.raw("countries").select(F.col("code").alias("country_code"), F.col("name").alias("country"), "region")
        e = self.dim_employee.select(F.col("employee_id").alias("manager_employee_id"), F.col("name").alias("manager"))
        j = w.join(co, "country_code").join(e, "manager_employee_id", "left")
        return j.select(F.col("id").alias("warehouse_id"), "code", "name", "city", "country_code", "country",
                        "region", "manager")

    @cached_property
    def dim_promotion(self) -> DataFrame:
        p = self.raw("promotions")
        pp = self.raw("promotion_products")
        per = pp.groupBy("promotion_id").agg(F.count("product_id").alias("n"))
        j = p.join(per, p.id == per.promotion_id, "left")
        return j.select(F.col("id").alias("promotion_id"), "code", "name", "discount_pct", "starts_at", "ends_at",
                        F.coalesce("n", F.lit(0)).cast("bigint").alias("product_count"))

    # -- facts ------------------------------------------------------------------
    @cached_property
    def rated_orders(self) -> DataFrame:
        """Orders with their day and its rate."""
        fx = F.broadcast(self.fx_rates_daily.select("currency_code", F.col("day").alias("order_date"),
                                                    F.col("units_per_usd").alias("fx_rate")))
        return self.raw("orders").withColumn("order_date", F.col("placed_at").cast("date")).join(fx, ["currency_code", "order_date"], "left")

    @property
    def order_heads(self) -> DataFrame:
        """What lines take of order facts. Where those are not written, it comes from the orders: what ``fact_orders`` adds
        (lines, payments, parcels and returns of an order, one row each, all by left joins) is neither used nor changes the rows."""
        return self.rated_orders.withColumnRenamed("id", "order_id").withColumn("date_key", date_key("order_date"))

    @property
    def most_lines(self) -> int:
        """Lines of the order that has most."""
        lines = self.raw("order_items").groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        return lines.agg(F.max("n")).first()[0] or 0

    @cached_property
    def fact_orders(self) -> DataFrame:
        items = self.raw("order_items").groupBy("order_id").agg(
            F.count(F.lit(1)).alias("line_count"), F.sum("quantity").cast("bigint").alias("units"))
        pay = self.raw("payments").groupBy("order_id").agg(
            F.max_by("method", F.struct("paid_at", "id")).alias("payment_method"),
            F.count_if(F.col("status") == "failed").alias("failed_payments"))
        s = self.raw("shipments").withColumn("shipment_count", F.count(F.lit(1)).over(Window.partitionBy("order_id")))
        ship = keep_one(s, ["order_id"], [F.col("delivered_at").desc_nulls_first(),
                                          F.col("shipped_at").desc_nulls_first(), F.col("id").desc()]).select(
            "order_id", F.col("warehouse_id").alias("ship_warehouse_id"), "carrier", "shipped_at", "delivered_at",
            "shipment_count")
        ret = self.raw("returns").groupBy("order_id").agg(
            F.count(F.lit(1)).alias("returned_lines"), F.sum("refund_amount").alias("refund_local"))
        # numbered before the joins, which neither add nor drop rows: the orders are dealt by customer while they are narrow
        number = F.row_number().over(Window.partitionBy("customer_id").orderBy("placed_at", "id")).alias("customer_order_number")
        heads = self.rated_orders.select(F.col("id").alias("order_id"), "order_date", "placed_at", "customer_id", "status", "promotion_id", "currency_code",
                                         "fx_rate", "subtotal", "discount", "shipping_fee", "tax", "total", number)
        j = (heads.join(items, "order_id", "left").join(pay, "order_id", "left")
             .join(ship, "order_id", "left").join(ret, "order_id", "left"))
        fxr = F.col("fx_rate")
        return j.select(
            "order_id", date_key("order_date").alias("date_key"), "order_date", "placed_at", "customer_id", "status",
            "promotion_id", "currency_code", "fx_rate", "line_count", "units", F.col("total").alias("total_local"),
            to_usd("subtotal", fxr).alias("subtotal_usd"), to_usd("discount", fxr).alias("discount_usd"),
            to_usd("shipping_fee", fxr).alias("shipping_usd"), to_usd("tax", fxr).alias("tax_usd"),
            to_usd("total", fxr).alias("total_usd"), "payment_method", "failed_payments",
            F.col("ship_warehouse_id").alias("warehouse_id"), "shipment_count", "carrier", "shipped_at",
            "delivered_at",
            dround(minutes_between_boundaries("placed_at", "shipped_at").cast("double") / 1440.0, 2)
            .alias("days_to_ship"),
            dround(minutes_between_boundaries("shipped_at", "delivered_at").cast("double") / 1440.0, 2)
            .alias("transit_days"),
            F.coalesce("returned_lines", F.lit(0)).alias("returned_lines"),
            to_usd(F.coalesce("refund_local", F.lit(0).cast("decimal(12,2)")), fxr).alias("refund_usd"),
            "customer_order_number")

    @property
    def sales_rows(self) -> DataFrame:
        """Lines of sales with what their columns are made of, for shuffles."""
        oi = self.raw("order_items")
        fo = self.order_heads.where(F.col("status") != "cancelled").select(
            "order_id", "placed_at", "customer_id", "promotion_id", F.col("status").alias("order_status"), "currency_code", "fx_rate")
        dp = self.dim_product.select(F.col("product_id").alias("dp_product_id"), "product_key",
                                     F.col("cost_usd").alias("unit_cost_usd"), "valid_from", "valid_to")
        j = oi.join(fo, "order_id")
        j = j.join(dp, (j.product_id == dp.dp_product_id) & (j.placed_at >= dp.valid_from) & (j.placed_at < dp.valid_to))
        return j.select("order_id", "line_no", F.col("placed_at").cast("date").alias("order_date"), "placed_at", "customer_id", "product_key", "product_id",
                        "promotion_id", "warehouse_id", "order_status", "currency_code", "fx_rate", "quantity", "unit_price", "discount", "unit_cost_usd")

    @staticmethod
    def as_sales(rows: DataFrame) -> DataFrame:
        """Sales of ``sales_rows``."""
        fxr = F.col("fx_rate")
        gross = F.col("unit_price") * F.col("quantity")
        cost = (F.col("unit_cost_usd") * F.col("quantity")).cast("decimal(14,2)")
        net = to_usd(line_net("unit_price", "quantity", "discount"), fxr)
        return rows.select(
            "order_id", "line_no", date_key("order_date").alias("date_key"), "order_date", "placed_at", "customer_id", "product_key", "product_id",
            "promotion_id", "warehouse_id", "order_status", "currency_code", "fx_rate", "quantity",
            F.col("unit_price").alias("unit_price_local"), to_usd(gross, fxr).alias("gross_usd"),
            to_usd("discount", fxr).alias("discount_usd"), net.alias("net_usd"), cost.alias("cost_usd"),
            (net - cost).cast("decimal(14,2)").alias("margin_usd"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self.as_sales(self.sales_rows)

    @cached_property
    def fact_returns(self) -> DataFrame:
        r = self.raw("returns")
        fs = self.fact_sales.select("order_id", "line_no", "order_date", "customer_id", "product_key", "product_id",
                                    "warehouse_id", "fx_rate")
        j = r.join(fs, ["order_id", "line_no"])
        rd = F.col("requested_at").cast("date")
        return j.select(
            F.col("id").alias("return_id"), "order_id", "line_no", rd.alias("return_date"), "order_date",
            "customer_id", "product_key", "product_id", "warehouse_id", "quantity", "reason", "status",
            to_usd("refund_amount", "fx_rate").alias("refund_usd"),
            F.datediff(rd, F.col("order_date")).alias("days_after_order"))

    @cached_property
    def fact_reviews(self) -> DataFrame:
        r = self.raw("reviews")
        return r.select(F.col("id").alias("review_id"), "product_id", "customer_id", "rating", "title",
                        F.col("created_at").cast("date").alias("review_date"))

    @cached_property
    def fact_inventory(self) -> DataFrame:
        i = self.raw("inventory")
        p = self.raw("products").select(F.col("id").alias("product_id"), "cost_usd")
        return i.join(p, "product_id").select(
            "warehouse_id", "product_id", "quantity_on_hand", "reorder_point",
            (F.col("quantity_on_hand") <= F.col("reorder_point")).alias("needs_reorder"),
            (F.col("quantity_on_hand") * F.col("cost_usd")).cast("decimal(14,2)").alias("stock_value_usd"))

    # -- marts --------------------------------------------------------------------
    @cached_property
    def product_pairs(self) -> DataFrame:
        """Frequently bought together: top 8 other products per product.

        Every pair of an order's lines with different products counts. What
        the lines say of bulk orders and hot products is for the plan only.
        """
        hot, bulky = frequent(self.raw("order_items").select("product_id"), "product_id"), self.most_lines > BULK
        top = top_partners(self.fact_sales, "order_id", "product_id", 8, hot, bulky)
        return top.select("product_id", F.col("other").alias("other_product_id"), F.col("together").alias("orders_together"))

    @cached_property
    def product_stats(self) -> DataFrame:
        p = self.dim_product.select("product_id").distinct()
        fs = self.fact_sales
        last = fs.agg(F.max("order_date")).first()[0]  # scalar, then a literal filter
        recent = fs.where(F.col("order_date") > F.date_sub(F.lit(last), 90))
        s = recent.groupBy("product_id").agg(F.sum("quantity").alias("units_90d"),
                                             F.sum("net_usd").alias("revenue_90d"))
        r = self.fact_reviews.groupBy("product_id").agg(F.count(F.lit(1)).alias("review_count"),
                                                        F.round(F.avg("rating"), 2).alias("avg_rating"))
        j = p.join(s, "product_id", "left").join(r, "product_id", "left")
        return j.select("product_id", F.coalesce("units_90d", F.lit(0)).cast("bigint").alias("units_90d"),
                        F.coalesce("revenue_90d", F.lit(0)).cast("decimal(18,2)").alias("revenue_usd_90d"),
                        "review_count", "avg_rating")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


STAR_TABLES = ("dim_date dim_category dim_product dim_employee dim_customer dim_warehouse dim_promotion "
               "fact_orders fact_sales fact_returns fact_reviews fact_inventory product_pairs product_stats").split()

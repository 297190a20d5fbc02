"""Dashboard and report queries on the star (D-01..D-12).

Every top-N here carries a total tie-break order so results are stable.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.money import line_net
from ..functions.numeric import dround, pct
from ..functions.timefn import month_start, months_between_boundaries
from ..operators.asof import asof_join
from ..operators.hierarchy import ancestor_pairs
from ..operators.stats import exact_percentiles
from ..operators.topk import top_k
from ..sources.fixtures import Store
from .incremental import first_load
from .publish import PublishedWarehouse
from .warehouse import Warehouse

MONEY = "decimal(18,2)"


def _last_day(df: DataFrame, col: str = "order_date"):
    """Scalar bound collected once and used as a literal (pushed into the scans)."""
    return df.agg(F.max(col)).first()[0]


# D-01 KPIs: last 30 days vs the 30 before, with % change ------------------------------
KPI_NAMES = ["revenue_usd", "orders", "avg_order_usd", "new_customers", "active_customers"]


def kpis(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders
    last = _last_day(fo)
    cur = F.col("order_date") > F.date_sub(F.lit(last), 30)
    p = fo.where((F.col("order_date") > F.date_sub(F.lit(last), 60)) & (F.col("status") != "cancelled"))
    p = p.withColumn("period", F.when(cur, "current").otherwise("previous"))
    g = p.groupBy("period").agg(
        F.sum("total_usd").cast("double").alias("revenue_usd"), F.count(F.lit(1)).cast("double").alias("orders"),
        (F.sum("total_usd").cast("double") / F.count(F.lit(1))).alias("avg_order_usd"),
        F.count_if(F.col("customer_order_number") == 1).cast("double").alias("new_customers"),
        F.count_distinct("customer_id").cast("double").alias("active_customers"))
    long = g.select("period", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kpi"), F.col(k).alias("v")) for k in KPI_NAMES])).alias("x"))
    long = long.select("period", "x.kpi", "x.v")
    w = long.groupBy("kpi").agg(F.max(F.when(F.col("period") == "current", F.col("v"))).alias("current_value"),
                                F.max(F.when(F.col("period") == "previous", F.col("v"))).alias("previous_value"))
    change = F.try_divide(F.col("current_value") - F.col("previous_value"), F.col("previous_value")) * 100.0
    return w.select("kpi", dround("current_value", 2).alias("current_value"),
                    dround("previous_value", 2).alias("previous_value"),
                    dround(F.when(F.col("previous_value") != 0, change), 1).alias("change_pct"))


# D-02 revenue by department and year, one column per year (values discovered) -----------
def revenue_pivot(wh: Warehouse) -> DataFrame:
    dp = wh.dim_product.select("product_key", F.col("category_l1").alias("category"))
    x = wh.fact_sales.join(dp, "product_key").select("category", F.year("order_date").alias("year"), "net_usd")
    p = x.groupBy("category").pivot("year").agg(dround(F.sum("net_usd").cast("double") / 1e6, 2))
    return p.orderBy("category")


# D-03 top 10 products, last N days --------------------------------------------------------
def top_products(wh: Warehouse, days: int = 90) -> DataFrame:
    fs = wh.fact_sales
    last = _last_day(fs)
    dp = wh.dim_product.select("product_key", "product_name", "brand")
    x = wh.sales_after(last - dt.timedelta(days=days)).join(dp, "product_key")
    g = x.groupBy("product_name", "brand").agg(F.sum("quantity").cast("bigint").alias("units"),
                                               F.sum("net_usd").cast(MONEY).alias("revenue_usd"))
    return g.orderBy(F.col("revenue_usd").desc(), "product_name", "brand").limit(10)


# D-04 cohort percentages and the heat-map matrix --------------------------------------------
def cohort_pct(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("status") != "cancelled")
    m = fo.select("customer_id", month_start("order_date").alias("month"))
    firsts = m.groupBy("customer_id").agg(F.min("month").alias("cohort"))
    counts = m.distinct().join(firsts, "customer_id").groupBy(
        "cohort", months_between_boundaries("cohort", "month").cast("int").alias("month_n")).agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"))
    lo = F.add_months(F.lit(_last_day(wh.fact_orders).replace(day=1)), -12)
    counts = counts.where((F.col("cohort") >= lo) & (F.col("month_n") <= 11))
    first = F.first("customers").over(Window.partitionBy("cohort").orderBy("month_n"))
    return counts.select("cohort", "month_n", "customers",
                         dround(F.col("customers") * 100.0 / first, 1).alias("pct")).orderBy("cohort", "month_n")


def cohort_matrix(wh: Warehouse) -> DataFrame:
    """Cohort x months-later matrix with listed pivot values 0..11."""
    c = cohort_pct(wh)
    return c.groupBy("cohort").pivot("month_n", list(range(12))).agg(F.first("pct")).orderBy("cohort")


# D-05 return rate by leaf category + most common reason ---------------------------------------
def return_rates(wh: Warehouse) -> DataFrame:
    fs = wh.fact_sales.where(F.col("order_status") == "delivered")
    dp = wh.dim_product.select("product_key", F.col("category_leaf").alias("category"),
                               F.col("category_l1").alias("department"))
    fr = wh.fact_returns.select("order_id", "line_no", F.col("quantity").alias("r_qty"), "reason")
    x = fs.join(dp, "product_key").join(fr, ["order_id", "line_no"], "left")
    g = x.groupBy("category", "department").agg(
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.coalesce(F.sum("r_qty"), F.lit(0)).cast("bigint").alias("units_returned"),
        F.mode("reason", deterministic=True).alias("top_reason"))
    g = g.withColumn("return_rate_pct", pct("units_returned", "units_sold"))
    return g.select("category", "department", "units_sold", "units_returned", "return_rate_pct", "top_reason") \
        .orderBy(F.col("return_rate_pct").desc(), "category", "department").limit(10)


# D-06 delivery by carrier on transit_days --------------------------------------------------------
def carrier_delivery(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("delivered_at").isNotNull())
    g = fo.groupBy("carrier").agg(
        F.count(F.lit(1)).cast("bigint").alias("deliveries"),
        F.count_if(F.col("transit_days") > 7).alias("_over"))
    p = exact_percentiles(fo, ["carrier"], "transit_days", {"p50": 0.5, "p90": 0.9})
    g = g.join(p, "carrier").withColumn("p50_days", dround("p50", 1)).withColumn("p90_days", dround("p90", 1))
    return g.select("carrier", "deliveries", "p50_days", "p90_days",
                    pct("_over", "deliveries", 1).alias("over_7_days_pct")).orderBy(F.col("p90_days").desc(), "carrier")


# D-07 sales leaders by name, 365 days -------------------------------------------------------------
def sales_leaders(wh: Warehouse) -> DataFrame:
    fs = wh.fact_sales
    last = _last_day(fs)
    dc = wh.dim_customer.where(F.col("account_manager_id").isNotNull()).select("customer_id", "account_manager_id")
    rev = wh.sales_after(last - dt.timedelta(days=365)).join(dc, "customer_id") \
        .groupBy("account_manager_id").agg(F.sum("net_usd").alias("revenue"))
    e = wh.dim_employee
    below = ancestor_pairs(e, "employee_id", "management_chain_ids").withColumnRenamed("employee_id", "ae_id")
    leaders = e.where((F.col("department") == "Sales") & (F.col("level") <= 3)).select(
        F.col("employee_id").alias("ancestor_id"), "level", "name", "title")
    j = leaders.join(below, "ancestor_id").join(rev, F.col("ae_id") == F.col("account_manager_id"))
    g = j.groupBy("level", "name", "title").agg(F.count_distinct("ae_id").cast("bigint").alias("account_executives"),
                                                F.sum("revenue").cast(MONEY).alias("revenue_usd"))
    return g.select(F.col("level").cast("int").alias("level"), "name", "title", "account_executives",
                    "revenue_usd").orderBy("level", F.col("revenue_usd").desc(), "name")


# D-08 unusual days, newest 12 ----------------------------------------------------------------------
def unusual_days_recent(wh: Warehouse) -> DataFrame:
    daily = wh.fact_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))
    w = Window.orderBy("order_date").rowsBetween(-7, -1)
    s = daily.select("order_date", "orders", F.avg("orders").over(w).alias("avg7"),
                     F.min("order_date").over(Window.partitionBy()).alias("first_day"))
    s = s.where((F.col("order_date") > F.date_add("first_day", 30))
                & ((F.col("orders") < 0.6 * F.col("avg7")) | (F.col("orders") > 1.8 * F.col("avg7"))))
    return s.select("order_date", F.col("orders").cast("bigint").alias("orders"), dround("avg7", 0).alias("avg_prev_7d"),
                    dround(F.col("orders") * 100.0 / F.col("avg7") - 100, 1).alias("change_pct")) \
        .orderBy(F.col("order_date").desc()).limit(12)


# D-09 sales by country with share of total ------------------------------------------------------------
def sales_by_country(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("status") != "cancelled")
    dc = wh.dim_customer.select("customer_id", "region", "country")
    g = fo.join(dc, "customer_id").groupBy("region", "country").agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"),
        F.count_distinct("customer_id").cast("bigint").alias("customers"),
        F.sum("total_usd").cast(MONEY).alias("revenue_usd"))
    # one row per country: the window over all of them is bounded by the country list
    share = pct(F.col("revenue_usd"), F.sum("revenue_usd").over(Window.partitionBy()))
    return g.select("region", "country", "orders", "customers", "revenue_usd", share.alias("share_pct")) \
        .orderBy(F.col("revenue_usd").desc(), "country")


# D-10 orders since the last load ------------------------------------------------------------------------
def orders_since(store: Store, loaded: PublishedWarehouse) -> DataFrame:
    """Orders in the source above the watermark of what was loaded (its ``etl_info``): one pushed-down literal filter."""
    o = store.table("orders").where(F.col("id") > F.lit(loaded.max_order_id))
    return o.agg(F.count(F.lit(1)).cast("bigint").alias("orders"),
                 F.count_distinct("customer_id").cast("bigint").alias("customers"),
                 F.max("placed_at").alias("last_order_at"))


def _orders_since_first_load(wh: Warehouse) -> DataFrame:
    return orders_since(wh.store, first_load(wh))


# D-11 monthly revenue report -------------------------------------------------------------------------------
def monthly_report(wh: Warehouse) -> DataFrame:
    return wh.fact_sales.groupBy(month_start("order_date").alias("month")).agg(
        F.sum("net_usd").cast(MONEY).alias("revenue_usd"),
        F.count_distinct("order_id").cast("bigint").alias("orders")).orderBy("month")


# D-12 engine-race forms: raw tables with an as-of rate, unrounded sum then round --------------------------
def _raw_asof_lines(wh: Warehouse) -> DataFrame:
    o = wh.raw("orders").where(F.col("status") != "cancelled").select(
        F.col("id").alias("order_id"), "currency_code", "placed_at", F.col("placed_at").cast("date").alias("_day"))
    fx = wh.raw("fx_rates").select("currency_code", "rate_date", "units_per_usd")
    # month buckets: a hot currency is spread over many window partitions
    ofx = asof_join(o, fx, ["currency_code"], "_day", "rate_date", how="inner",
                    bucket=lambda t: F.trunc(t, "month"))
    oi = wh.raw("order_items").select("order_id", "product_id", "unit_price", "quantity", "discount")
    x = oi.join(ofx, "order_id")
    return x.withColumn("usd", line_net("unit_price", "quantity", "discount").cast("double")
                        / F.col("units_per_usd").cast("double"))


def race_monthly_revenue(wh: Warehouse) -> DataFrame:
    x = _raw_asof_lines(wh)
    return x.groupBy(month_start("placed_at").alias("month")).agg(
        dround(F.sum("usd"), 2).alias("revenue_usd"), F.count_distinct("order_id").cast("bigint").alias("orders"))


def race_category_rollup(wh: Warehouse) -> DataFrame:
    from .questions import _store_tree, rollup_orders
    x = _raw_asof_lines(wh)
    p = wh.raw("products").select(F.col("id").alias("product_id"), "category_id")
    x = x.join(p, "product_id").join(_store_tree(wh), "category_id")
    return rollup_orders(x, "usd").select("level1", "level2", "orders", dround("value", 2).alias("revenue_usd"))


REPORTS = {
    "d01_kpis": kpis,
    "d02_revenue_pivot": revenue_pivot,
    "d03_top_products": top_products,
    "d04_cohort_pct": cohort_pct,
    "d04_cohort_matrix": cohort_matrix,
    "d05_return_rates": return_rates,
    "d06_carrier_delivery": carrier_delivery,
    "d07_sales_leaders": sales_leaders,
    "d08_unusual_days_recent": unusual_days_recent,
    "d09_sales_by_country": sales_by_country,
    "d10_orders_since_load": _orders_since_first_load,
    "d11_monthly_report": monthly_report,
    "d12_race_monthly_revenue": race_monthly_revenue,
    "d12_race_category_rollup": race_category_rollup,
}

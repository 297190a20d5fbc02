"""The fifteen business questions, each on the store tables and on the star.

Both forms must return the same rows (the store-vs-star equality test).
Store forms read the raw layer (order tables cut at the watermark) and
convert money with the daily fx calendar at query time; star forms read the
facts, where money is already in USD.

Output types are fixed per column so both models (and the SQL oracle) agree:
months/dates DATE, counts BIGINT, money DECIMAL(18,2), ratios DOUBLE.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.money import line_net, to_usd
from ..functions.numeric import dround, pct
from ..functions.timefn import epoch_seconds, month_start, months_between_boundaries
from ..operators.asof import asof_join
from ..operators.hierarchy import ancestor_pairs, flatten_tree
from ..operators.keys import ntile_global
from ..operators.pairs import pairs
from ..operators.stats import exact_percentiles
from ..operators.topk import keep_one, top_k
from .warehouse import Warehouse

MONEY = "decimal(18,2)"


def _money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


# -- shared store-side building blocks ---------------------------------------------
def _fx(wh: Warehouse) -> DataFrame:
    """The daily calendar: bounded by currencies x days, so broadcast."""
    return F.broadcast(wh.fx_rates_daily.select("currency_code", F.col("day").alias("_day"),
                                                F.col("units_per_usd").alias("_rate")))


def _live_orders(wh: Warehouse, since=None) -> DataFrame:
    o = wh.raw("orders").where(F.col("status") != "cancelled")
    if since is not None:  # a literal bound that reaches the scan
        o = o.where(F.col("placed_at") >= F.lit(dt.datetime.combine(since, dt.time())).cast("timestamp_ntz"))
    o = o.withColumn("_day", F.col("placed_at").cast("date"))
    return o.join(_fx(wh), ["currency_code", "_day"])


def _store_lines(wh: Warehouse, since=None) -> DataFrame:
    """Non-cancelled order lines (from day ``since``) with their USD net value (rate of the order day)."""
    o = _live_orders(wh, since).select(F.col("id").alias("order_id"), "customer_id", "placed_at", "_day", "_rate")
    oi = wh.raw("order_items")
    j = oi.join(o, "order_id")
    return j.withColumn("net_usd", to_usd(line_net("unit_price", "quantity", "discount"), "_rate"))


def _store_tree(wh: Warehouse) -> DataFrame:
    """category id -> department (level1) and level2 of the walked tree."""
    if "_store_tree" not in wh.__dict__:  # its check runs once per warehouse
        t = flatten_tree(wh.raw("categories"), "id", "parent_id", "name", levels=2)
        wh.__dict__["_store_tree"] = t.select(F.col("id").alias("category_id"), F.col("level1"), F.col("level2"))
    return wh.__dict__["_store_tree"]


def _max_day_store(wh: Warehouse):
    """Newest order day up to the watermark (cancelled included), as a literal."""
    return wh.last_day


def _max_day_star(wh: Warehouse):
    return wh.last_day


# -- Q-01 monthly revenue ------------------------------------------------------------
def q01_store(wh: Warehouse) -> DataFrame:
    x = _store_lines(wh)
    return x.groupBy(month_start("placed_at").alias("month")).agg(
        F.count_distinct("order_id").cast("bigint").alias("orders"), _money(F.sum("net_usd")).alias("revenue_usd"))


def q01_star(wh: Warehouse) -> DataFrame:
    fs = wh.fact_sales
    return fs.groupBy(month_start("order_date").alias("month")).agg(
        F.count_distinct("order_id").cast("bigint").alias("orders"), _money(F.sum("net_usd")).alias("revenue_usd"))


# -- Q-02 category rollup -------------------------------------------------------------
def rollup_orders(x: DataFrame, value: str) -> DataFrame:
    """ROLLUP of level1 and level2: distinct orders and the sum of ``value``.

    A row per (order, level1, level2) tells whether it is the first of its order, and of its order in that level1. Distinct
    orders of each level are then sums over the cells, and only the cells (a row per category) are expanded by ROLLUP."""
    per = x.where(F.col("order_id").isNotNull()).groupBy("level1", "level2", "order_id").agg(F.sum(value).alias("value"))
    of_order = Window.partitionBy("order_id").orderBy("level1", "level2")
    of_level = Window.partitionBy("order_id", "level1").orderBy("level2")
    firsts = per.select("level1", "level2", "value", (F.row_number().over(of_order) == 1).alias("_first"),
                        (F.row_number().over(of_level) == 1).alias("_first_1"))
    cells = firsts.groupBy("level1", "level2").agg(F.count(F.lit(1)).alias("n2"), F.count_if("_first_1").alias("n1"),
                                                   F.count_if("_first").alias("n0"), F.sum("value").alias("value"))
    level = F.grouping_id()
    orders = F.when(level == 0, F.sum("n2")).when(level == 1, F.sum("n1")).otherwise(F.sum("n0"))
    return cells.rollup("level1", "level2").agg(orders.cast("bigint").alias("orders"), F.sum("value").alias("value"))


def _rollup(x: DataFrame) -> DataFrame:
    r = rollup_orders(x, "net_usd").select("level1", "level2", "orders", _money("value").alias("revenue_usd"))
    return r.orderBy(F.col("level1").asc_nulls_last(), F.col("level2").asc_nulls_first())


def q02_store(wh: Warehouse) -> DataFrame:
    x = _store_lines(wh)
    p = wh.raw("products").select(F.col("id").alias("product_id"), "category_id")
    x = x.join(p, "product_id").join(_store_tree(wh), "category_id")
    return _rollup(x)


def q02_star(wh: Warehouse) -> DataFrame:
    dp = wh.dim_product.select("product_key", F.col("category_l1").alias("level1"),
                               F.col("category_l2").alias("level2"))
    return _rollup(wh.fact_sales.join(dp, "product_key"))


# -- Q-03 active customers --------------------------------------------------------------
def _active(o: DataFrame, day: str) -> DataFrame:
    return o.groupBy(month_start(day).alias("month")).agg(
        F.count_distinct("customer_id").cast("bigint").alias("active_customers"),
        F.count(F.lit(1)).cast("bigint").alias("orders"))


def q03_store(wh: Warehouse) -> DataFrame:
    return _active(wh.raw("orders").where(F.col("status") != "cancelled"), "placed_at")


def q03_star(wh: Warehouse) -> DataFrame:
    return _active(wh.fact_orders.where(F.col("status") != "cancelled"), "order_date")


# -- Q-04 cohort retention ----------------------------------------------------------------
def _cohorts(o: DataFrame, day: str) -> DataFrame:
    m = o.select("customer_id", month_start(day).alias("month"))
    firsts = m.groupBy("customer_id").agg(F.min("month").alias("cohort"))
    activity = m.distinct()
    pairs = activity.join(firsts, "customer_id").select(
        "cohort", months_between_boundaries("cohort", "month").alias("months_later"))
    return pairs.where(F.col("months_later") <= 12).groupBy("cohort", "months_later").agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"))


def q04_store(wh: Warehouse) -> DataFrame:
    return _cohorts(wh.raw("orders").where(F.col("status") != "cancelled"), "placed_at")


def q04_star(wh: Warehouse) -> DataFrame:
    return _cohorts(wh.fact_orders.where(F.col("status") != "cancelled"), "order_date")


# -- Q-05 RFM segments ----------------------------------------------------------------------
def _rfm(per: DataFrame) -> DataFrame:
    s = ntile_global(per, [F.col("recency_days").desc(), F.col("customer_id").asc()], 5, "r")
    s = ntile_global(s, [F.col("frequency").asc(), F.col("customer_id").asc()], 5, "f")
    r, f = F.col("r"), F.col("f")
    seg = (F.when((r >= 4) & (f >= 4), "Champions").when(f >= 4, "Loyal").when((r <= 2) & (f >= 3), "At risk")
           .when(r >= 4, "Recent, occasional").when(r <= 2, "Hibernating").otherwise("Needs attention"))
    return s.groupBy(seg.alias("segment")).agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        dround(F.avg("frequency"), 2).alias("avg_orders"),
        dround(F.avg("monetary").cast("double"), 2).alias("avg_spend_usd"))


def q05_store(wh: Warehouse) -> DataFrame:
    last = _max_day_store(wh)
    o = _live_orders(wh)
    per = o.groupBy("customer_id").agg(
        F.datediff(F.lit(last), F.max("_day")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"), F.sum(to_usd("total", "_rate")).alias("monetary"))
    return _rfm(per)


def q05_star(wh: Warehouse) -> DataFrame:
    last = _max_day_star(wh)
    per = wh.fact_orders.where(F.col("status") != "cancelled").groupBy("customer_id").agg(
        F.datediff(F.lit(last), F.max("order_date")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"), F.sum("total_usd").alias("monetary"))
    return _rfm(per)


# -- Q-06 top products per department --------------------------------------------------------
def _top3(rev: DataFrame) -> DataFrame:
    t = top_k(rev, ["department"], [F.col("revenue_usd").desc(), F.col("product_id")], 3, rank_col="rank")
    return t.select("department", F.col("rank").cast("int").alias("rank"), "product_id", "product_name",
                    _money("revenue_usd").alias("revenue_usd"))


def q06_store(wh: Warehouse) -> DataFrame:
    last = _max_day_store(wh)
    x = _store_lines(wh, last - dt.timedelta(days=364)).groupBy("product_id").agg(F.sum("net_usd").alias("net_usd"))
    p = wh.raw("products").select(F.col("id").alias("product_id"), F.col("name").alias("product_name"), "category_id")
    x = x.join(p, "product_id").join(_store_tree(wh), "category_id")
    rev = x.groupBy(F.col("level1").alias("department"), "product_id", "product_name").agg(
        F.sum("net_usd").alias("revenue_usd"))
    return _top3(rev)


def q06_star(wh: Warehouse) -> DataFrame:
    last = _max_day_star(wh)
    fs = wh.sales_after(last - dt.timedelta(days=365)).groupBy("product_key", "product_id").agg(F.sum("net_usd").alias("net_usd"))
    dp = wh.dim_product.select("product_key", F.col("category_l1").alias("department"), "product_name")
    rev = fs.join(dp, "product_key").groupBy("department", "product_id").agg(
        F.max("product_name").alias("product_name"), F.sum("net_usd").alias("revenue_usd"))
    return _top3(rev)


# -- Q-07 basket pairs ---------------------------------------------------------------------------
def _pairs(recent: DataFrame, names: DataFrame) -> DataFrame:
    """Top 20 pairs by common orders; an order with very many products is paired in blocks over many tasks."""
    met = pairs(recent.withColumn("one", F.lit(1)), "order_id", "product_id", "one", ordered=True)
    c = met.groupBy(F.col("product_id").alias("product_a"), F.col("other").alias("product_b")).agg(
        F.count(F.lit(1)).cast("bigint").alias("orders_together"))
    top = c.orderBy(F.col("orders_together").desc(), "product_a", "product_b").limit(20)
    na = names.select(F.col("pid").alias("product_a"), F.col("pname").alias("name_a"))
    nb = names.select(F.col("pid").alias("product_b"), F.col("pname").alias("name_b"))
    out = top.join(na, "product_a").join(nb, "product_b")
    return out.select("product_a", "name_a", "product_b", "name_b", "orders_together").orderBy(
        F.col("orders_together").desc(), "product_a", "product_b")


def q07_store(wh: Warehouse) -> DataFrame:
    last = _max_day_store(wh)
    o = wh.raw("orders").where((F.col("status") != "cancelled")
                               & (F.col("placed_at").cast("date") > F.date_sub(F.lit(last), 90)))
    recent = wh.raw("order_items").join(o.select(F.col("id").alias("order_id")), "order_id").select(
        "order_id", "product_id").distinct()
    names = wh.raw("products").select(F.col("id").alias("pid"), F.col("name").alias("pname"))
    return _pairs(recent, names)


def q07_star(wh: Warehouse) -> DataFrame:
    last = _max_day_star(wh)
    recent = wh.sales_after(last - dt.timedelta(days=90)).select(
        "order_id", "product_id").distinct()
    names = wh.dim_product.where("is_current").select(F.col("product_id").alias("pid"),
                                                       F.col("product_name").alias("pname"))
    return _pairs(recent, names)


# -- Q-08 brand returns -----------------------------------------------------------------------------
def _brand_rates(x: DataFrame) -> DataFrame:
    g = x.groupBy("brand").agg(F.sum("quantity").cast("bigint").alias("units_sold"),
                               F.coalesce(F.sum("r_qty"), F.lit(0)).cast("bigint").alias("units_returned"))
    g = g.where(F.col("units_sold") > 1000).withColumn("return_rate_pct", pct("units_returned", "units_sold"))
    return g.orderBy(F.col("return_rate_pct").desc(), "brand").limit(15)


def q08_store(wh: Warehouse) -> DataFrame:
    o = wh.raw("orders").where(F.col("status") == "delivered").select(F.col("id").alias("order_id"))
    oi = wh.raw("order_items").join(o, "order_id")
    p = wh.raw("products").select(F.col("id").alias("product_id"), "brand_id")
    b = wh.raw("brands").select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    r = wh.raw("returns").select("order_id", "line_no", F.col("quantity").alias("r_qty"))
    x = oi.join(p, "product_id").join(b, "brand_id").join(r, ["order_id", "line_no"], "left")
    return _brand_rates(x)


def q08_star(wh: Warehouse) -> DataFrame:
    fs = wh.fact_sales.where(F.col("order_status") == "delivered")
    dp = wh.dim_product.select("product_key", "brand")
    fr = wh.fact_returns.select("order_id", "line_no", F.col("quantity").alias("r_qty"))
    x = fs.join(dp, "product_key").join(fr, ["order_id", "line_no"], "left")
    return _brand_rates(x)


# -- Q-09 delivery percentiles -------------------------------------------------------------------------
def _delivery(d: DataFrame) -> DataFrame:
    """Exact percentiles by distributed ranking (a carrier's rows never meet in one task)."""
    g = d.groupBy("carrier").agg(F.count(F.lit(1)).cast("bigint").alias("deliveries"),
                                 F.count_if(F.col("days") > 7).alias("_over"))
    p = exact_percentiles(d, ["carrier"], "days", {"p50": 0.5, "p90": 0.9})
    j = g.join(p, "carrier")
    return j.select("carrier", "deliveries", dround("p50", 2).alias("p50_days"), dround("p90", 2).alias("p90_days"),
                    pct("_over", "deliveries").alias("over_7_days_pct")).orderBy(F.col("p90_days").desc(), "carrier")


def _days(a: str, b: str) -> Column:
    return (epoch_seconds(b) - epoch_seconds(a)) / 86400.0


def q09_store(wh: Warehouse) -> DataFrame:
    s = wh.raw("shipments")
    last = keep_one(s, ["order_id"], [F.col("delivered_at").desc_nulls_first(),
                                      F.col("shipped_at").desc_nulls_first(), F.col("id").desc()])
    d = last.where(F.col("delivered_at").isNotNull()).select("carrier", _days("shipped_at", "delivered_at").alias("days"))
    return _delivery(d)


def q09_star(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("delivered_at").isNotNull())
    return _delivery(fo.select("carrier", _days("shipped_at", "delivered_at").alias("days")))


# -- Q-10 sales hierarchy -----------------------------------------------------------------------------------
def _leaders(chain: DataFrame, revenue: DataFrame) -> DataFrame:
    """chain: employee_id, level, name, title, department, path_ids (root..self)."""
    below = ancestor_pairs(chain, "employee_id", "path_ids").withColumnRenamed("employee_id", "ae_id")
    leaders = chain.where((F.col("department") == "Sales") & (F.col("level") <= 3)).select(
        F.col("employee_id").alias("ancestor_id"), "level", "name", "title")
    j = leaders.join(below, "ancestor_id").join(revenue, F.col("ae_id") == F.col("account_manager_id"))
    g = j.groupBy("level", F.col("ancestor_id").alias("employee_id"), "name", "title").agg(
        F.count_distinct("ae_id").cast("bigint").alias("account_executives"),
        _money(F.sum("revenue")).alias("revenue_usd"))
    return g.select(F.col("level").cast("int").alias("level"), "employee_id", "name", "title", "account_executives",
                    "revenue_usd").orderBy("level", F.col("revenue_usd").desc(), "employee_id")


def q10_store(wh: Warehouse) -> DataFrame:
    last = _max_day_store(wh)
    e = wh.raw("employees").select("id", "manager_id", F.concat_ws(" ", "first_name", "last_name").alias("name"),
                                   "title", "department")
    t = flatten_tree(e, "id", "manager_id", "name", levels=0, extra=["title", "department"])
    chain = t.select(F.col("id").alias("employee_id"), (F.col("depth") - 1).alias("level"), "name", "title",
                     "department", "path_ids")
    c = wh.raw("customers").where(F.col("account_manager_id").isNotNull()).select(
        F.col("id").alias("customer_id"), "account_manager_id")
    x = _store_lines(wh, last - dt.timedelta(days=364)).groupBy("customer_id").agg(F.sum("net_usd").alias("net_usd"))
    rev = x.join(c, "customer_id").groupBy("account_manager_id").agg(F.sum("net_usd").alias("revenue"))
    return _leaders(chain, rev)


def q10_star(wh: Warehouse) -> DataFrame:
    last = _max_day_star(wh)
    dc = wh.dim_customer.where(F.col("account_manager_id").isNotNull()).select("customer_id", "account_manager_id")
    fs = wh.sales_after(last - dt.timedelta(days=365)).groupBy("customer_id").agg(F.sum("net_usd").alias("net_usd"))
    rev = fs.join(dc, "customer_id").groupBy("account_manager_id").agg(F.sum("net_usd").alias("revenue"))
    chain = wh.dim_employee.select("employee_id", "level", "name", "title", "department",
                                   F.col("management_chain_ids").alias("path_ids"))
    return _leaders(chain, rev)


# -- Q-11 unusual days ----------------------------------------------------------------------------------------
def _unusual(daily: DataFrame) -> DataFrame:
    """Days whose order count is < 0.6x or > 1.8x the mean of the 7 previous rows.

    The window runs over one row per day (bounded by the calendar, not by the
    data), so a single ordered partition is fine.
    """
    w = Window.orderBy("order_date").rowsBetween(-7, -1)
    s = daily.select("order_date", "orders", F.avg("orders").over(w).alias("avg7"),
                     F.min("order_date").over(Window.partitionBy()).alias("first_day"))
    s = s.where((F.col("order_date") > F.date_add("first_day", 30))
                & ((F.col("orders") < 0.6 * F.col("avg7")) | (F.col("orders") > 1.8 * F.col("avg7"))))
    return s.select("order_date", F.col("orders").cast("bigint").alias("orders"),
                    dround("avg7", 1).alias("avg_prev_7d"),
                    dround(F.col("orders") * 100.0 / F.col("avg7") - 100, 1).alias("change_pct")).orderBy("order_date")


def q11_store(wh: Warehouse) -> DataFrame:
    o = wh.raw("orders")
    return _unusual(o.groupBy(F.col("placed_at").cast("date").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders")))


def q11_star(wh: Warehouse) -> DataFrame:
    return _unusual(wh.fact_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders")))


# -- Q-12 year-over-year growth --------------------------------------------------------------------------------
def _yoy(monthly: DataFrame, current_month) -> DataFrame:
    m = monthly.where((F.col("month") >= F.add_months(F.lit(current_month), -12))
                      & (F.col("month") < F.lit(current_month)))
    p = monthly.select("department", F.add_months("month", 12).alias("month"), F.col("revenue").alias("prev"))
    j = m.join(p, ["department", "month"], "left")
    growth = dround((F.col("revenue").cast("double") / F.col("prev").cast("double") - 1) * 100.0, 1)
    return j.select("department", "month", _money("revenue").alias("revenue_usd"),
                    _money("prev").alias("revenue_prev_year_usd"), growth.alias("growth_pct")).orderBy(
        "department", "month")


def q12_store(wh: Warehouse) -> DataFrame:
    current = _max_day_store(wh).replace(day=1)
    first = current.replace(year=current.year - 2)  # twelve months and the twelve before them
    x = _store_lines(wh, first).groupBy("product_id", month_start("placed_at").alias("month")).agg(F.sum("net_usd").alias("net_usd"))
    p = wh.raw("products").select(F.col("id").alias("product_id"), "category_id")
    x = x.join(p, "product_id").join(_store_tree(wh), "category_id")
    monthly = x.groupBy(F.col("level1").alias("department"), "month").agg(F.sum("net_usd").alias("revenue"))
    return _yoy(monthly, current)


def q12_star(wh: Warehouse) -> DataFrame:
    current = _max_day_star(wh).replace(day=1)
    dp = wh.dim_product.select("product_key", F.col("category_l1").alias("department"))
    first = current.replace(year=current.year - 2) - dt.timedelta(days=1)
    fs = wh.sales_after(first).groupBy("product_key", month_start("order_date").alias("month")).agg(F.sum("net_usd").alias("net_usd"))
    monthly = fs.join(dp, "product_key").groupBy("department", "month").agg(F.sum("net_usd").alias("revenue"))
    return _yoy(monthly, current)


# -- Q-13 CLV buckets --------------------------------------------------------------------------------------------
def _clv(spend: DataFrame) -> DataFrame:
    v = F.col("lifetime_usd")
    bucket = (F.when(v < 100, "1. under $100").when(v < 250, "2. $100 to $250").when(v < 500, "3. $250 to $500")
              .when(v < 1000, "4. $500 to $1,000").when(v < 2500, "5. $1,000 to $2,500")
              .when(v < 5000, "6. $2,500 to $5,000").otherwise("7. $5,000 or more"))
    g = spend.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).cast("bigint").alias("customers"),
                                                  _money(F.sum("lifetime_usd")).alias("revenue_usd"))
    # at most 7 rows: the window over all of them is tiny
    share = pct(F.col("customers"), F.sum("customers").over(Window.partitionBy()))
    return g.select("bucket", "customers", share.alias("share_pct"), "revenue_usd").orderBy("bucket")


def q13_store(wh: Warehouse) -> DataFrame:
    o = _live_orders(wh)
    return _clv(o.groupBy("customer_id").agg(F.sum(to_usd("total", "_rate")).alias("lifetime_usd")))


def q13_star(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("status") != "cancelled")
    return _clv(fo.groupBy("customer_id").agg(F.sum("total_usd").alias("lifetime_usd")))


# -- Q-14 detail extract ------------------------------------------------------------------------------------------
DETAIL_COLS = ["order_id", "line_no", "placed_at", "customer_id", "product_id", "product_name", "quantity",
               "currency_code", "unit_price_local", "net_usd"]


def q14_store(wh: Warehouse) -> DataFrame:
    last = _max_day_store(wh)
    o = wh.raw("orders").where((F.col("status") != "cancelled") & (F.col("placed_at") >= F.lit(last)))
    o = o.withColumn("_day", F.col("placed_at").cast("date")).join(_fx(wh), ["currency_code", "_day"])
    oi = wh.raw("order_items").join(o.select(F.col("id").alias("order_id"), "placed_at", "customer_id",
                                             "currency_code", "_rate"), "order_id")
    p = wh.raw("products").select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    x = oi.join(p, "product_id").select(
        *DETAIL_COLS[:8], F.col("unit_price").alias("unit_price_local"),
        to_usd(line_net("unit_price", "quantity", "discount"), "_rate").alias("net_usd"))
    return x.orderBy("order_id", "line_no")


def q14_star(wh: Warehouse) -> DataFrame:
    last = _max_day_star(wh)
    fs = wh.sales_after(last - dt.timedelta(days=1), last)
    dp = wh.dim_product.select("product_key", "product_name")
    return fs.join(dp, "product_key").select(*DETAIL_COLS).orderBy("order_id", "line_no")


# -- Q-15 customer orders -----------------------------------------------------------------------------------------
def q15_store(wh: Warehouse, customer_id: int | None = None) -> DataFrame:
    cid = customer_id if customer_id is not None else wh.watermark_customer
    o = wh.orders_of(cid).select("order_id", "placed_at", "status", "currency_code", "total", F.col("placed_at").cast("date").alias("_day"))
    latest = o.orderBy(F.col("placed_at").desc(), F.col("order_id").desc()).limit(20)
    fx = wh.raw("fx_rates").select(F.col("currency_code").alias("currency_code"), "rate_date", "units_per_usd")
    # as-of lookup of the rate (latest business day <= order day) instead of a per-row LATERAL
    with_fx = asof_join(latest, fx.withColumnRenamed("currency_code", "currency_code"), ["currency_code"],
                        "_day", "rate_date", how="inner")
    ids = [r.order_id for r in latest.select("order_id").collect()]  # at most 20
    lines = wh.order_rows("order_items", ids).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    j = with_fx.join(lines, "order_id", "left")
    return j.select("order_id", "placed_at", "status", F.coalesce("n", F.lit(0)).cast("bigint").alias("line_count"),
                    to_usd("total", "units_per_usd").cast(MONEY).alias("total_usd")).orderBy(
        F.col("placed_at").desc(), F.col("order_id").desc())


def q15_star(wh: Warehouse, customer_id: int | None = None) -> DataFrame:
    cid = customer_id if customer_id is not None else wh.watermark_customer
    out = wh.order_facts_of(cid).select("order_id", "placed_at", "status", F.coalesce("line_count", F.lit(0)).cast("bigint")
                                        .alias("line_count"), _money("total_usd").alias("total_usd"))
    return out.orderBy(F.col("placed_at").desc(), F.col("order_id").desc()).limit(20)


QUESTIONS = {
    "monthly_revenue": (q01_store, q01_star),
    "category_rollup": (q02_store, q02_star),
    "active_customers": (q03_store, q03_star),
    "cohort_retention": (q04_store, q04_star),
    "rfm_segments": (q05_store, q05_star),
    "top_products_per_department": (q06_store, q06_star),
    "basket_pairs": (q07_store, q07_star),
    "brand_returns": (q08_store, q08_star),
    "delivery_percentiles": (q09_store, q09_star),
    "sales_hierarchy": (q10_store, q10_star),
    "unusual_days": (q11_store, q11_star),
    "yoy_growth": (q12_store, q12_star),
    "clv_buckets": (q13_store, q13_star),
    "detail_extract": (q14_store, q14_star),
    "customer_orders": (q15_store, q15_star),
}

"""Lesson queries (L-01..L-20) and the two macros (M1, M2), re-aimed at whole tables.

Display limits of the teaching scripts (LIMIT 5 on a projection) are dropped;
limits that are the feature (top-k reports) stay, with a total tie-break.
Queries that looked at one id are run for every id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.money import to_usd
from ..functions.numeric import dround, pct
from ..functions.timefn import iso_dow, month_start
from ..operators.asof import asof_join
from ..operators.hierarchy import ancestor_pairs
from ..operators.keys import ntile_global
from ..operators.reshape import fill_days, pivot_agg, unpivot
from ..operators.stats import exact_percentiles
from ..operators.topk import top_k
from ..sources.fixtures import Store
from .incremental import first_load, over_written_store
from .publish import PublishedWarehouse
from .warehouse import Warehouse

MONEY = "decimal(18,2)"


def _last(df: DataFrame, col: str = "order_date"):
    return df.agg(F.max(col)).first()[0]


# L-01 orders by year and status (GROUP BY ALL / ORDER BY ALL) ------------------------------
def l01_orders_by_year_status(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders
    return fo.groupBy(F.year("order_date").cast("int").alias("year"), "status").agg(
        F.count(F.lit(1)).cast("bigint").alias("orders")).orderBy("year", "status")


# L-02 revenue per month, running total, growth % ---------------------------------------------
def l02_revenue_running(wh: Warehouse) -> DataFrame:
    m = wh.fact_sales.groupBy(month_start("order_date").alias("month")).agg(F.sum("net_usd").alias("revenue"))
    w = Window.orderBy("month")  # one row per month: bounded by the calendar
    run = F.sum("revenue").over(w.rowsBetween(Window.unboundedPreceding, 0))
    growth = (F.col("revenue").cast("double") / F.lag("revenue").over(w).cast("double") - 1) * 100.0
    return m.select("month", F.round("revenue", 0).cast("decimal(18,0)").alias("revenue_usd"),
                    F.round(run, 0).cast("decimal(18,0)").alias("running_total_usd"),
                    dround(growth, 1).alias("growth_pct")).orderBy("month")


# L-03 7-day moving average and max (named window, 2 functions) ---------------------------------
def l03_moving_avg(wh: Warehouse) -> DataFrame:
    d = wh.fact_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))
    w7 = Window.orderBy("order_date").rowsBetween(-6, 0)
    return d.select("order_date", F.col("orders").cast("bigint").alias("orders"),
                    dround(F.avg("orders").over(w7), 1).alias("avg_7d"),
                    F.max("orders").over(w7).cast("bigint").alias("max_7d")).orderBy(F.col("order_date").desc())


# L-04 days between consecutive orders, quartiles -----------------------------------------------
def l04_order_gaps(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("status") != "cancelled")
    w = Window.partitionBy("customer_id").orderBy("placed_at", "order_id")
    g = fo.select(F.datediff("order_date", F.lag("order_date").over(w)).alias("gap"))
    names = {"p25_days": 0.25, "p50_days": 0.5, "p75_days": 0.75, "p90_days": 0.9}
    q = exact_percentiles(g, [], "gap", names, count_name="repeat_orders")
    return q.select(*[dround(k, 4).alias(k) for k in names], "repeat_orders")


# L-05 biggest order per country (arg_max) ---------------------------------------------------------
def l05_biggest_order_per_country(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.select("order_id", "customer_id", "total_usd")
    dc = wh.dim_customer.select("customer_id", "country", "full_name")
    j = fo.join(dc, "customer_id")
    key = F.struct(F.col("total_usd"), (-F.col("order_id")).alias("tie"))
    g = j.groupBy("country").agg(F.max("total_usd").cast(MONEY).alias("biggest_order_usd"),
                                 F.max_by("order_id", key).alias("biggest_order_id"),
                                 F.max_by("full_name", key).alias("placed_by"))
    return g.orderBy(F.col("biggest_order_usd").desc(), "country")


# L-06 spend deciles and share ------------------------------------------------------------------------
def l06_spend_deciles(wh: Warehouse) -> DataFrame:
    s = wh.fact_orders.where(F.col("status") != "cancelled").groupBy("customer_id").agg(
        F.sum("total_usd").alias("lifetime_usd"))
    d = ntile_global(s, [F.col("lifetime_usd").desc(), F.col("customer_id").asc()], 10, "decile")
    g = d.groupBy("decile").agg(F.count(F.lit(1)).cast("bigint").alias("customers"),
                                F.sum("lifetime_usd").alias("rev"))
    share = pct(F.col("rev"), F.sum("rev").over(Window.partitionBy()), 1)  # 10 rows
    return g.select("decile", "customers", F.round("rev", 0).cast("decimal(18,0)").alias("revenue_usd"),
                    share.alias("share_pct")).orderBy("decile")


# L-07 revenue of every category including its descendants -------------------------------------------
def l07_category_rollup_tree(wh: Warehouse) -> DataFrame:
    dc = wh.dim_category
    # ancestor closure from the flattened tree: explode each category's id path
    t = _category_ids(wh)
    pairs = t.select(F.explode("path_ids").alias("ancestor_id"), F.col("id").alias("category_id"))
    dp = wh.dim_product.select("product_key", "category_id")
    rev = wh.fact_sales.join(dp, "product_key").groupBy("category_id").agg(F.sum("net_usd").alias("net"))
    j = rev.join(pairs, "category_id").join(
        dc.select(F.col("category_id").alias("ancestor_id"), "path_text", "depth", "path"), "ancestor_id")
    g = j.groupBy("path", "path_text", "depth").agg(dround(F.sum("net").cast("double") / 1e6, 2).alias("revenue_musd"))
    return g.orderBy("path").select(F.col("path_text").alias("category"), F.col("depth").cast("int").alias("depth"),
                                    "revenue_musd")


def _category_ids(wh: Warehouse) -> DataFrame:
    from ..operators.hierarchy import flatten_tree
    return flatten_tree(wh.raw("categories"), "id", "parent_id", "name", levels=0)


# L-08 indented trees, span of control, referral chains -------------------------------------------------
def l08_category_tree(wh: Warehouse) -> DataFrame:
    dc = wh.dim_category
    return dc.select(F.concat(F.repeat(F.lit("    "), F.col("depth") - 1), F.col("category")).alias("category"),
                     F.col("depth").cast("int").alias("depth"), F.col("path_text").alias("full_path"), "path") \
        .orderBy("path").drop("path")


def l08_org_chart(wh: Warehouse) -> DataFrame:
    e = wh.dim_employee.where(F.col("department").isin("Executive", "Sales") & (F.col("level") <= 3))
    return e.select(F.concat(F.repeat(F.lit("    "), F.col("level")), F.col("name")).alias("employee"), "title",
                    "department", "management_chain_ids").orderBy("management_chain_ids").drop("management_chain_ids")


def l08_span_of_control(wh: Warehouse) -> DataFrame:
    e = wh.dim_employee
    pairs = ancestor_pairs(e.select("employee_id", "manager_id", "management_chain_ids"), "employee_id",
                           "management_chain_ids")
    pairs = pairs.where(F.col("ancestor_id") != F.col("employee_id"))
    mgr = e.select("employee_id", "manager_id")
    j = pairs.join(mgr, "employee_id")
    g = j.groupBy("ancestor_id").agg(F.count_if(F.col("manager_id") == F.col("ancestor_id")).alias("direct_reports"),
                                     F.count(F.lit(1)).cast("bigint").alias("everyone_below"))
    m = e.select(F.col("employee_id").alias("ancestor_id"), "name", "title")
    out = g.join(m, "ancestor_id").select("name", "title", "direct_reports", "everyone_below")
    return out.orderBy(F.col("everyone_below").desc(), "name").limit(10)


def l08_referral_chains(wh: Warehouse) -> DataFrame:
    spend = wh.fact_orders.where(F.col("status") != "cancelled").groupBy("customer_id").agg(
        F.sum("total_usd").alias("spend_usd"))
    dc = wh.dim_customer.select("customer_id", "referral_root_id", "referral_depth")
    root = wh.dim_customer.select(F.col("customer_id").alias("referral_root_id"),
                                  F.col("full_name").alias("chain_started_by"))
    j = dc.join(root, "referral_root_id").join(spend, "customer_id", "left")
    referred = F.col("customer_id") != F.col("referral_root_id")
    g = j.groupBy("chain_started_by").agg(
        (F.count(F.lit(1)) - 1).cast("bigint").alias("customers_referred"),
        F.max("referral_depth").cast("bigint").alias("deepest_level"),
        F.round(F.sum(F.when(referred, F.col("spend_usd"))), 0).cast("decimal(18,0)").alias("spend_of_referred_usd"))
    return g.orderBy(F.col("customers_referred").desc(), "chain_started_by").limit(10)


# L-09 weekend orders with the rate date used (as-of join) ------------------------------------------------
def l09_weekend_rates(wh: Warehouse) -> DataFrame:
    o = wh.raw("orders").where(iso_dow(F.col("placed_at").cast("date")).isin(6, 7)).select(
        "id", "currency_code", F.col("placed_at").cast("date").alias("order_date"))
    fx = wh.raw("fx_rates")
    j = asof_join(o, fx, ["currency_code"], "order_date", "rate_date", how="inner",
                  bucket=lambda t: F.trunc(t, "month"))
    return j.select("id", "order_date", F.date_format("order_date", "EEEE").alias("order_day"), "rate_date",
                    F.date_format("rate_date", "EEEE").alias("rate_day"), "units_per_usd").orderBy("id")


# L-10 price then vs price now for old-version sales -----------------------------------------------------
def l10_price_then_now(wh: Warehouse) -> DataFrame:
    dp = wh.dim_product
    then_ = dp.where(~F.col("is_current")).select("product_key", "product_name",
                                                   F.col("list_price_usd").alias("list_price_then"))
    now_ = dp.where("is_current").select("product_id", F.col("list_price_usd").alias("list_price_today"))
    j = wh.fact_sales.select("product_key", "product_id").join(then_, "product_key").join(now_, "product_id")
    g = j.groupBy("product_key", "product_name", "list_price_then", "list_price_today").agg(
        F.count(F.lit(1)).cast("bigint").alias("lines_sold_at_old_price"))
    ch = dround((F.col("list_price_today").cast("double") / F.col("list_price_then").cast("double") - 1) * 100.0, 1)
    out = g.select("product_key", "product_name", "lines_sold_at_old_price", "list_price_then", "list_price_today",
                   ch.alias("change_pct"))
    return out.orderBy(F.abs("change_pct").desc(), "product_key").limit(10)


# L-11 catalog as of a date, by department (SCD2 point in time) ---------------------------------------------
def l11_catalog_as_of(wh: Warehouse, as_of: dt.datetime | None = None) -> DataFrame:
    """``as_of``: an instant (default: the newest order)."""
    t = F.lit(as_of or wh.raw("orders").agg(F.max("placed_at")).first()[0]).cast("timestamp_ntz")
    dp = wh.dim_product.where((t >= F.col("valid_from")) & (t < F.col("valid_to")))
    return dp.groupBy(F.col("category_l1").alias("department")).agg(
        F.count(F.lit(1)).cast("bigint").alias("products"),
        dround(F.avg("list_price_usd").cast("double"), 2).alias("avg_list_price_usd")).orderBy("department")


# L-12 daily units including zero days (gap fill) ------------------------------------------------------------
def l12_daily_units_filled(wh: Warehouse, days: int = 14) -> DataFrame:
    last = _last(wh.fact_sales)
    prods = wh.product_stats.where(F.col("units_90d").between(5, 15)).select("product_id")
    grid = fill_days(prods, "day", F.date_sub(F.lit(last), days - 1), F.lit(last))
    sales = wh.sales_after(last - dt.timedelta(days=days)).groupBy(
        "product_id", F.col("order_date").alias("day")).agg(F.sum("quantity").alias("q"))
    j = grid.join(sales, ["product_id", "day"], "left")
    return j.select("product_id", "day", F.date_format("day", "EEEE").alias("weekday"),
                    F.coalesce("q", F.lit(0)).cast("bigint").alias("units_sold")).orderBy("product_id", "day")


# L-13 orders per week ------------------------------------------------------------------------------------------
def l13_weekly_orders(wh: Warehouse) -> DataFrame:
    return wh.fact_orders.groupBy(F.date_trunc("week", "placed_at").cast("date").alias("week_starting")).agg(
        F.count(F.lit(1)).cast("bigint").alias("orders")).orderBy(F.col("week_starting").desc())


# L-14 pivot / unpivot --------------------------------------------------------------------------------------------
def l14a_payment_methods_by_year(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("payment_method").isNotNull()).select(
        F.year("order_date").cast("int").alias("year"), "payment_method")
    return pivot_agg(fo, ["year"], "payment_method", [F.count(F.lit(1))], fill=0).orderBy("year")


def l14b_department_year_two_aggs(wh: Warehouse) -> DataFrame:
    dp = wh.dim_product.select("product_key", F.col("category_l1").alias("department"))
    x = wh.fact_sales.join(dp, "product_key").select("department", F.year("order_date").alias("year"), "net_usd",
                                                     "quantity")
    return pivot_agg(x, ["department"], "year", [
        F.round(F.sum("net_usd"), 0).cast("decimal(18,0)").alias("revenue"),
        F.sum("quantity").cast("bigint").alias("units")]).orderBy("department")


def l14c_status_by_currency(wh: Warehouse) -> DataFrame:
    return pivot_agg(wh.fact_orders, ["currency_code"], "status", [F.count(F.lit(1))],
                     values=["delivered", "shipped", "cancelled"], fill=0).orderBy("currency_code")


def l14d_order_money_parts(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.select("order_id", "subtotal_usd", "discount_usd", "shipping_usd", "tax_usd", "total_usd")
    return unpivot(fo, ["order_id"], "component", "usd")


def l14e_price_versions_round_trip(wh: Warehouse) -> DataFrame:
    x = wh.dim_product.select("category_l1", F.year("valid_from").alias("year"))
    wide = pivot_agg(x, ["category_l1"], "year", [F.count(F.lit(1))], fill=0)
    return unpivot(wide, ["category_l1"], "year", "price_versions").orderBy("category_l1", "year")


# L-15 nested types and JSON --------------------------------------------------------------------------------------
def l15a_order_product_lists(wh: Warehouse) -> DataFrame:
    dp = wh.dim_product.select("product_key", "product_name")
    x = wh.fact_sales.join(dp, "product_key")
    g = x.groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "product_name"))).alias("l"))
    return g.select("order_id", F.array_join(F.col("l.product_name"), " | ").alias("products"),
                    F.size("l").cast("bigint").alias("line_count"))


def l15b_biggest_order_struct(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders
    key = F.struct(F.col("total_usd"), (-F.col("order_id")).alias("tie"))
    g = fo.groupBy("customer_id").agg(
        F.max_by(F.struct("order_id", "total_usd", "order_date"), key).alias("biggest_order"))
    return g.select("customer_id", F.col("biggest_order.order_id").alias("biggest_order_id"),
                    F.col("biggest_order.total_usd").alias("biggest_total_usd"),
                    F.col("biggest_order.order_date").alias("biggest_order_date"))


def l15c_payment_histogram(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("payment_method").isNotNull())
    c = fo.groupBy(F.year("order_date").cast("int").alias("year"), "payment_method").agg(F.count(F.lit(1)).alias("n"))
    h = c.groupBy("year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("payment_method", "n"))))
                              .alias("orders_by_method"))
    text = F.array_join(F.transform(F.map_entries("orders_by_method"),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")
    return h.select("year", text.alias("orders_by_method")).orderBy("year")


def l15d_json_sizes(wh: Warehouse) -> DataFrame:
    p = wh.raw("products").where(F.get_json_object("attributes", "$.sizes").isNotNull())
    return p.select("id", F.get_json_object("attributes", "$.color").alias("color"),
                    F.get_json_object("attributes", "$.warranty_months").cast("int").alias("warranty_months"),
                    F.json_array_length(F.get_json_object("attributes", "$.sizes")).cast("bigint").alias("size_count"))


def l15e_json_key_census(wh: Warehouse) -> DataFrame:
    p = wh.raw("products").select(F.explode(F.json_object_keys("attributes")).alias("key"))
    return p.groupBy("key").agg(F.count(F.lit(1)).cast("bigint").alias("products")).orderBy(
        F.col("products").desc(), "key")


def l15f_json_typed(wh: Warehouse) -> DataFrame:
    schema = "color STRING, warranty_months INT, sizes ARRAY<STRING>"
    p = wh.raw("products").select("id", F.from_json("attributes", schema).alias("a"))
    return p.select("id", F.col("a.color").alias("color"), F.col("a.warranty_months").alias("warranty_months"),
                    F.array_join("a.sizes", ",").alias("sizes"))


def l15g_list_lambdas(wh: Warehouse) -> DataFrame:
    oi = wh.raw("order_items")
    g = oi.groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "quantity"))).alias("l"))
    q = F.col("l.quantity")
    return g.select(
        "order_id",
        F.size(F.filter(q, lambda x: x > 20)).cast("bigint").alias("over_20"),
        F.aggregate(F.transform(q, lambda x: x * 10), F.lit(0).cast("bigint"),
                    lambda acc, x: acc + x).alias("times_10_sum"),
        F.aggregate(q, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"),
        F.array_join(F.slice(q, 2, 2).cast("array<string>"), ",").alias("second_and_third"))


def l15h_manager_chain_unnested(wh: Warehouse) -> DataFrame:
    e = wh.dim_employee.select("employee_id", F.posexplode("management_chain_ids").alias("pos", "manager_id"))
    return e.select("employee_id", (F.col("pos") + 1).cast("int").alias("position"), "manager_id")


# L-16 days of stock left: live stock / warehouse sales speed ----------------------------------------------------
def l16_days_of_stock(wh: Warehouse) -> DataFrame:
    stock = wh.raw("inventory").groupBy("product_id").agg(F.sum("quantity_on_hand").cast("bigint").alias("stock_now"))
    ps = wh.product_stats.where(F.col("units_90d") > 0)
    dp = wh.dim_product.where("is_current").select("product_id", "product_name")
    j = ps.join(dp, "product_id").join(stock, "product_id")
    days = dround(F.col("stock_now").cast("double") / (F.col("units_90d").cast("double") / 90.0), 0)
    out = j.select("product_id", "product_name", "units_90d", "stock_now", days.alias("days_of_stock_left"))
    return out.orderBy("days_of_stock_left", "product_id").limit(10)


# L-17 up-to-the-second total: warehouse as of the last load UNION ALL live orders since -------------------------
def history_plus_live(store: Store, loaded: PublishedWarehouse) -> DataFrame:
    """Totals of the loaded warehouse, and of the source's orders above its watermark (its ``etl_info``) at the rates of their days."""
    w = loaded.max_order_id
    hist = loaded.fact_orders.agg(F.lit("warehouse (last ETL)").alias("source"),
                               F.count(F.lit(1)).cast("bigint").alias("orders"),
                               dround(F.sum("total_usd").cast("double"), 0).alias("revenue_usd"))
    live = store.table("orders").where(F.col("id") > F.lit(w)).select(
        "id", "currency_code", "total", F.col("placed_at").cast("date").alias("_day"))
    lj = asof_join(live, store.table("fx_rates"), ["currency_code"], "_day", "rate_date", how="inner")
    tail = lj.agg(F.lit("postgres (since ETL)").alias("source"), F.count(F.lit(1)).cast("bigint").alias("orders"),
                  dround(F.sum(F.col("total").cast("double") / F.col("units_per_usd").cast("double")), 0)
                  .alias("revenue_usd"))
    return hist.unionByName(tail)


def l17_history_plus_live(wh: Warehouse) -> DataFrame:
    """With the full load that a later incremental one has yet to follow."""
    return history_plus_live(over_written_store(wh).store, first_load(wh))


# L-18 VIP spend summary with and without a delete filter (temp view + cache) ------------------------------------
def l18_vip_spend(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("status") != "cancelled")
    dc = wh.dim_customer.where(F.col("segment") == "vip").select("customer_id")
    vip = fo.join(dc, "customer_id").groupBy("customer_id").agg(F.sum("total_usd").alias("spend_usd"))
    return vip.agg(F.count(F.lit(1)).cast("bigint").alias("vip_customers"),
                   dround(F.avg("spend_usd").cast("double"), 0).alias("avg_spend_usd"),
                   F.count_if(F.col("spend_usd") >= 20000).cast("bigint").alias("rows_after_delete"),
                   F.count(F.lit(1)).cast("bigint").alias("rows_after_rollback"))


# L-19 yearly orders and customers (store tables) -----------------------------------------------------------------
def l19_yearly(wh: Warehouse) -> DataFrame:
    o = wh.raw("orders")
    return o.groupBy(F.trunc(F.col("placed_at").cast("date"), "year").alias("year")).agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"),
        F.count_distinct("customer_id").cast("bigint").alias("customers")).orderBy("year")


# L-20 exercises --------------------------------------------------------------------------------------------------
def l20a_best_weekday(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders
    return fo.groupBy(F.date_format("order_date", "EEEE").alias("weekday")).agg(
        dround(F.avg("total_usd").cast("double"), 2).alias("avg_order_usd")).orderBy(
        F.col("avg_order_usd").desc(), "weekday")


def l20b_top_brand_per_department(wh: Warehouse) -> DataFrame:
    last = _last(wh.fact_sales)
    dp = wh.dim_product.select("product_key", F.col("category_l1").alias("department"), "brand")
    x = wh.fact_sales.where(F.col("order_date") > F.add_months(F.lit(last), -12)).join(dp, "product_key")
    g = x.groupBy("department", "brand").agg(F.sum("net_usd").cast(MONEY).alias("revenue_usd"))
    return top_k(g, ["department"], [F.col("revenue_usd").desc(), F.col("brand")], 1).orderBy("department")


def l20c_new_customer_share(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("promotion_id").isNotNull())
    p = wh.dim_promotion.select("promotion_id", "code")
    g = fo.join(p, "promotion_id").groupBy("promotion_id", "code").agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"),
        F.count_if(F.col("customer_order_number") == 1).cast("bigint").alias("new_customer_orders"))
    return g.withColumn("new_share_pct", pct("new_customer_orders", "orders")).orderBy("promotion_id")


def l20d_region_segment_pivot(wh: Warehouse) -> DataFrame:
    dc = wh.dim_customer.select("customer_id", "region", "segment")
    x = wh.fact_orders.where(F.col("status") != "cancelled").join(dc, "customer_id")
    return pivot_agg(x, ["region"], "segment", [dround(F.sum("total_usd").cast("double") / 1e6, 2)],
                     values=["business", "consumer", "vip"]).orderBy("region")


def l20e_slowest_cross_country_warehouse(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders.where(F.col("delivered_at").isNotNull())
    w = wh.dim_warehouse.select("warehouse_id", F.col("name").alias("warehouse"),
                                F.col("country_code").alias("w_country"))
    c = wh.dim_customer.select("customer_id", F.col("country_code").alias("c_country"))
    x = fo.join(w, "warehouse_id").join(c, "customer_id").where(F.col("w_country") != F.col("c_country"))
    g = x.groupBy("warehouse").agg(F.count(F.lit(1)).cast("bigint").alias("deliveries"))
    p = exact_percentiles(x, ["warehouse"], "transit_days", {"p90": 0.9})
    g = g.join(p, "warehouse").select("warehouse", "deliveries", dround("p90", 2).alias("p90_days"))
    return g.orderBy(F.col("p90_days").desc(), "warehouse")


def l20f_repeated_price_raises(wh: Warehouse) -> DataFrame:
    dp = wh.dim_product.select("product_id", "valid_from", "list_price_usd")
    w = Window.partitionBy("product_id").orderBy("valid_from")
    x = dp.withColumn("up", (F.col("list_price_usd") > F.lag("list_price_usd").over(w)).cast("int"))
    g = x.groupBy("product_id").agg(
        F.sum("up").cast("bigint").alias("raises"),
        F.array_sort(F.collect_list(F.struct("valid_from", "list_price_usd"))).alias("l"))
    g = g.where(F.col("raises") >= 2)
    return g.select("product_id", "raises",
                    F.array_join(F.col("l.list_price_usd").cast("array<string>"), " -> ").alias("prices"))


def l20g_busiest_customers(wh: Warehouse, days: int = 30) -> DataFrame:
    o = wh.raw("orders")
    last = o.agg(F.max("placed_at")).first()[0]
    r = o.where(F.col("placed_at") > F.lit(last) - F.expr(f"INTERVAL {days} DAYS"))
    g = r.groupBy("customer_id").agg(F.count(F.lit(1)).cast("bigint").alias("orders"))
    return g.orderBy(F.col("orders").desc(), "customer_id").limit(5)


# M1 scalar macro as a SQL function; M2 table macro as a DataFrame function -----------------------------------------
def m1_to_usd_function(wh: Warehouse) -> DataFrame:
    spark: SparkSession = wh.spark
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION to_usd_cents(amount DECIMAL(14,2), rate DECIMAL(18,8))
                 RETURNS DECIMAL(14,2)
                 RETURN CAST((CAST(CAST(amount * 100 AS DECIMAL(38,0)) * 200000000
                                   + CAST(rate * 100000000 AS DECIMAL(38,0)) AS DECIMAL(38,0))
                              div CAST(rate * 200000000 AS DECIMAL(38,0))) * 0.01 AS DECIMAL(14,2))""")
    fo = wh.fact_orders.select("order_id", "currency_code", "total_local", "fx_rate")
    return fo.select("order_id", "currency_code", "total_local",
                     F.call_function("to_usd_cents", "total_local", "fx_rate").alias("total_usd"))


def top_products(wh: Warehouse, department: str | None = None, n: int = 5) -> DataFrame:
    """Table macro: top n products by revenue, for one department or for every department."""
    dp = wh.dim_product.select("product_key", F.col("category_l1").alias("department"), "product_name")
    x = wh.fact_sales.join(dp, "product_key")
    if department is not None:
        x = x.where(F.col("department") == department)
    g = x.groupBy("department", "product_name").agg(F.round(F.sum("net_usd"), 0).cast("decimal(18,0)")
                                                    .alias("revenue_usd"))
    return top_k(g, ["department"], [F.col("revenue_usd").desc(), F.col("product_name")], n)


def m2_top_products_macro(wh: Warehouse) -> DataFrame:
    return top_products(wh, None, 5)


LESSONS = {k: v for k, v in globals().items() if (k[:1] == "l" and k[1:3].isdigit() or k[:3] in ("m1_", "m2_")) and callable(v)}

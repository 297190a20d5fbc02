"""Store-page queries re-aimed as batch views over all keys (V-01..V-19).

The store answers one product / customer / cart at a time; here each view is
computed for every key in one job, joined on keys (no per-key loops). "now"
is an explicit ``as_of`` taken from the data (the newest order; for promotions the start
of the newest one that covers a product), never the wall clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numeric import dround
from ..functions.text import trigram_similarity, words
from ..operators.hierarchy import ancestor_pairs, flatten_tree
from ..operators.stats import group_rank
from ..operators.topk import keep_one, top_k
from .warehouse import Warehouse


def _now(wh: Warehouse):
    return wh.raw("orders").agg(F.max("placed_at")).first()[0]


def _promotion_start(wh: Warehouse):
    """When the newest promotion that covers a product begins."""
    covering = wh.raw("promotion_products").select(F.col("promotion_id").alias("id")).distinct()
    return wh.raw("promotions").join(covering, "id").agg(F.max("starts_at")).first()[0]


def _half_up(x):
    """Round half away from zero to a whole number (money in cents from doubles)."""
    return F.signum(x) * F.floor(F.abs(x) + 0.5)


# V-01 best sellers, last 7 days (top 8) -------------------------------------------------
def v01_best_sellers(wh: Warehouse, days: int = 7) -> DataFrame:
    now = _now(wh)
    o = wh.raw("orders").where((F.col("placed_at") >= F.lit(now) - F.expr(f"INTERVAL {days} DAYS"))
                               & (F.col("status") != "cancelled")).select(F.col("id").alias("order_id"))
    x = wh.raw("order_items").join(o, "order_id")
    g = x.groupBy("product_id").agg(F.sum("quantity").cast("bigint").alias("units"))
    p = wh.raw("products").select(F.col("id").alias("product_id"), "name", "brand_id", "price_usd")
    b = wh.raw("brands").select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    j = g.join(p, "product_id").join(b, "brand_id")
    return j.select("product_id", "name", "brand", F.col("price_usd").cast("double").alias("price_usd"), "units") \
        .orderBy(F.col("units").desc(), "product_id").limit(8)


# V-02 trending, 90 days, with rating (top 8) ---------------------------------------------
def v02_trending(wh: Warehouse) -> DataFrame:
    return wh.product_stats.select("product_id", "units_90d", "avg_rating", "review_count").orderBy(
        F.col("units_90d").desc(), "product_id").limit(8)


# V-03 active promotion per product at a time, and the promo price ---------------------------
def v03_active_promotion(wh: Warehouse, as_of: dt.datetime | None = None) -> DataFrame:
    t = F.lit(as_of or _promotion_start(wh)).cast("timestamp_ntz")
    pr = wh.raw("promotions").where((t >= F.col("starts_at")) & (t < F.col("ends_at")))
    pp = wh.raw("promotion_products").join(pr.withColumnRenamed("id", "promotion_id"), "promotion_id")
    best = keep_one(pp, ["product_id"], [F.col("discount_pct").desc(), F.col("promotion_id")])
    p = wh.raw("products").select(F.col("id").alias("product_id"), "price_usd")
    j = best.join(p, "product_id")
    promo = F.round(F.col("price_usd") * (F.lit(100) - F.col("discount_pct")) / 100, 2).cast("decimal(12,2)")
    return j.select("product_id", "code", "name", F.col("discount_pct").cast("double").alias("discount_pct"),
                    "ends_at", "price_usd", promo.alias("promo_price_usd"))


# V-04 stock per warehouse and in total ----------------------------------------------------------
def v04_stock(wh: Warehouse) -> DataFrame:
    i = wh.raw("inventory")
    w = wh.raw("warehouses").select(F.col("id").alias("warehouse_id"), "code", "city", "country_code")
    co = wh.raw("countries").select(F.col("code").alias("country_code"), F.col("name").alias("country"))
    j = i.join(w, "warehouse_id").join(co, "country_code")
    tot = F.sum("quantity_on_hand").over(Window.partitionBy("product_id"))  # a handful of rows per product
    return j.select("product_id", "code", "city", "country", "quantity_on_hand",
                    tot.cast("bigint").alias("total_on_hand"))


# V-05 rating summary per product ------------------------------------------------------------------
def v05_rating_summary(wh: Warehouse) -> DataFrame:
    r = wh.raw("reviews")
    return r.groupBy("product_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("reviews"),
        dround(F.avg("rating"), 4).alias("avg_rating"),
        *[F.count_if(F.col("rating") == k).cast("bigint").alias(f"r{k}") for k in (5, 4, 3, 2, 1)])


# V-06 latest 5 reviews per product ------------------------------------------------------------------
def v06_latest_reviews(wh: Warehouse) -> DataFrame:
    r = wh.raw("reviews")
    c = wh.raw("customers").select(F.col("id").alias("customer_id"), "first_name", "country_code")
    t = top_k(r, ["product_id"], [F.col("created_at").desc(), F.col("id").desc()], 5)
    return t.join(c, "customer_id").select("product_id", "id", "rating", "title", "body", "created_at", "first_name",
                                           "country_code")


# V-07 price history -----------------------------------------------------------------------------------
def v07_price_history(wh: Warehouse) -> DataFrame:
    return wh.raw("product_prices").select("product_id", "valid_from", "valid_to",
                                           F.col("price_usd").cast("double").alias("price_usd")) \
        .orderBy("product_id", "valid_from")


# V-08 frequently bought together ---------------------------------------------------------------------
def v08_bought_together(wh: Warehouse) -> DataFrame:
    return wh.product_pairs.select("product_id", "other_product_id",
                                   F.col("orders_together").cast("bigint").alias("orders_together"))


# V-09 category page: a category and all its descendants, with brand and ratings, in the store's four sorts -------
PAGE_SIZE = 24
CATEGORY_SORTS = {
    "name": lambda: [F.col("name"), F.col("product_id")],
    "price": lambda: [F.col("price_usd"), F.col("product_id")],
    "price_desc": lambda: [F.col("price_usd").desc(), F.col("product_id")],
    "newest": lambda: [F.col("created_at").desc(), F.col("product_id")],
}


def v09_category_pages(wh: Warehouse) -> DataFrame:
    """A row per category, active product below it and sort: its position, page number and the total.

    Positions come from distributed ranks (``group_rank`` over category and sort), so a root category that
    holds a third of the catalog is spread over many tasks."""
    tree = flatten_tree(wh.raw("categories"), "id", "parent_id", "name", levels=0)
    sub = ancestor_pairs(tree, "id").withColumnRenamed("id", "category_id")  # (ancestor, category)
    p = wh.raw("products").where("is_active").select(F.col("id").alias("product_id"), "name", "price_usd", "brand_id", "created_at",
                                                     "category_id")
    x = sub.join(p, "category_id").select(F.col("ancestor_id").alias("category_id"), "product_id", "name", "price_usd", "brand_id",
                                          "created_at")
    places = None
    for sort, order in CATEGORY_SORTS.items():
        one = group_rank(x, ["category_id"], order(), "position", "total").withColumn("sort", F.lit(sort))
        places = one if places is None else places.unionByName(one)
    rating = wh.raw("reviews").groupBy("product_id").agg(F.avg("rating").alias("rating"), F.count(F.lit(1)).alias("reviews"))
    b = wh.raw("brands").select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    out = places.join(b, "brand_id").join(rating, "product_id", "left")
    return out.select("category_id", "sort", "position", ((F.col("position") - 1) / PAGE_SIZE).cast("bigint").alias("page_index"), "total",
                      "product_id", "name", "brand", F.col("price_usd").cast("double").alias("price_usd"),
                      dround(F.coalesce("rating", F.lit(0.0)), 4).alias("rating"), F.coalesce("reviews", F.lit(0)).cast("bigint").alias("reviews"))


# V-10 search ranked by trigram similarity, for every word of the catalog -----------------------------
def _pieces(c):
    """Distinct substrings of one, two and three letters."""
    low = F.lower(c)

    def of(n: int):
        cut = F.transform(F.sequence(F.lit(1), F.length(low) - (n - 1)), lambda i: low.substr(i, F.lit(n)))
        return F.when(F.length(low) >= n, cut).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def v10_search(wh: Warehouse, top: int = 48) -> DataFrame:
    """Every catalog word is a search term; a product matches when its name contains the term (ILIKE).

    A name that contains a term contains each of the term's pieces of up to three letters, terms of one or two
    letters included. Each term looks up the one of its longest pieces that the fewest names have, so a common
    piece brings no candidates where a rarer one is at hand; then the exact ILIKE check and the similarity rank.
    Products of one name are equally similar to a term and rank by id, so only the first ``top`` of them can be among
    the ``top`` of a term. Postings and candidates are shuffled, never broadcast: Spark's estimate of them leaves out the explode."""
    p = wh.raw("products").where("is_active").select(F.col("id").alias("product_id"), "name")
    p = top_k(p, ["name"], [F.col("product_id")], top)
    posting = p.select("product_id", F.explode(_pieces(F.col("name"))).alias("g"))
    freq = posting.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    terms = p.select(F.explode(words("name")).alias("term")).distinct()
    tg = terms.select("term", F.explode(_pieces(F.col("term"))).alias("g")).where(F.length("g") == F.least(F.length("term"), F.lit(3)))
    rare = tg.join(freq.hint("merge"), "g").groupBy("term").agg(F.min_by("g", F.struct("n", "g")).alias("g"))
    cand = rare.join(posting.hint("merge"), "g").select("term", "product_id")
    hit = cand.join(p.hint("merge"), "product_id").where(F.contains(F.lower("name"), F.col("term")))
    hit = hit.withColumn("similarity", dround(trigram_similarity("name", "term"), 6))
    return top_k(hit, ["term"], [F.col("similarity").desc(), F.col("product_id")], top).select(
        "term", "product_id", "name", "similarity")


# V-11 account summary per customer: profile, account manager, orders that were not cancelled ------------------
def v11_account_summary(wh: Warehouse) -> DataFrame:
    c = wh.raw("customers").select(F.col("id").alias("customer_id"), "email", F.col("created_at").alias("signup_at"), "account_manager_id")
    e = wh.raw("employees").select(F.col("id").alias("account_manager_id"), F.concat_ws(" ", "first_name", "last_name").alias("account_manager"))
    o = wh.raw("orders").where(F.col("status") != "cancelled").groupBy("customer_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"), F.min("placed_at").alias("first_order_at"))
    j = c.join(e, "account_manager_id", "left").join(o, "customer_id", "left")
    return j.select("customer_id", "email", "signup_at", "account_manager", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
                    "first_order_at")


# V-12 customer profile with the latest rate of their currency and cart units ----------------------------
def v12_customer_profile(wh: Warehouse) -> DataFrame:
    c = wh.raw("customers").select(F.col("id").alias("customer_id"), "segment", "country_code")
    co = wh.raw("countries").select(F.col("code").alias("country_code"), "currency_code")
    fx = wh.raw("fx_rates").groupBy("currency_code").agg(
        F.max_by("units_per_usd", "rate_date").alias("fx"), F.max("rate_date").alias("rate_date"))
    carts = wh.raw("carts").select(F.col("id").alias("cart_id"), "customer_id")
    ci = wh.raw("cart_items").join(carts, "cart_id").groupBy("customer_id").agg(
        F.sum("quantity").cast("bigint").alias("cart_units"))
    j = c.join(co, "country_code").join(fx, "currency_code", "left").join(ci, "customer_id", "left")
    return j.select("customer_id", "segment", "country_code", "currency_code", "fx", "rate_date",
                    F.coalesce("cart_units", F.lit(0)).cast("bigint").alias("cart_units"))


# V-13 default shipping address per customer ---------------------------------------------------------------
def v13_default_address(wh: Warehouse) -> DataFrame:
    a = wh.raw("addresses").where(F.col("kind") == "shipping")
    k = keep_one(a, ["customer_id"], [F.col("is_default").desc(), F.col("id")])
    return k.select("customer_id", F.col("id").alias("address_id"), "line1", "city", "postal_code", "country_code")


# V-14 cart lines with price and total stock ----------------------------------------------------------------
def v14_cart_lines(wh: Warehouse) -> DataFrame:
    ci = wh.raw("cart_items")
    p = wh.raw("products").select(F.col("id").alias("product_id"), "name", "price_usd", "brand_id")
    b = wh.raw("brands").select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    stock = wh.raw("inventory").groupBy("product_id").agg(F.sum("quantity_on_hand").cast("bigint").alias("in_stock"))
    return ci.join(p, "product_id").join(b, "brand_id").join(stock, "product_id", "left").select(
        "cart_id", "product_id", "name", "brand", "quantity", "price_usd", F.coalesce("in_stock", F.lit(0)).alias("in_stock"))


# V-15 order lines with returned units, and per-order payment / shipment counts -----------------------------
def v15_order_detail(wh: Warehouse) -> DataFrame:
    oi = wh.raw("order_items")
    r = wh.raw("returns").groupBy("order_id", "line_no").agg(F.sum("quantity").alias("returned"))
    pay = wh.raw("payments").groupBy("order_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("payments"),
        F.sum(F.when(F.col("status") == "captured", F.col("amount"))).cast("decimal(18,2)").alias("captured"))
    sh = wh.raw("shipments").groupBy("order_id").agg(F.count(F.lit(1)).cast("bigint").alias("shipments"))
    j = oi.join(r, ["order_id", "line_no"], "left").join(pay, "order_id", "left").join(sh, "order_id", "left")
    return j.select("order_id", "line_no", "product_id", "quantity", "unit_price",
                    F.coalesce("returned", F.lit(0)).cast("bigint").alias("returned_units"),
                    F.coalesce("payments", F.lit(0)).alias("payments"), "captured",
                    F.coalesce("shipments", F.lit(0)).alias("shipments"))


# V-15 the order page in full: header, lines, payments, shipments, returns of every order ---------------------------
def v15_order_headers(wh: Warehouse) -> DataFrame:
    """Each order with its shipping address, promotion code, currency sign and customer."""
    o = wh.raw("orders").withColumnRenamed("id", "order_id")
    sign = wh.raw("currencies").select(F.col("code").alias("currency_code"), "symbol")
    to = wh.raw("addresses").select(F.col("id").alias("shipping_address_id"), "line1", "city", "postal_code", "country_code")
    who = wh.raw("customers").select(F.col("id").alias("customer_id"), F.concat_ws(" ", "first_name", "last_name").alias("customer"))
    code = wh.raw("promotions").select(F.col("id").alias("promotion_id"), F.col("code").alias("promo_code"))
    j = o.join(sign, "currency_code").join(to, "shipping_address_id").join(who, "customer_id").join(code, "promotion_id", "left")
    return j.select("order_id", "customer_id", "customer", "status", "placed_at", "updated_at", "currency_code", "symbol", "subtotal", "discount",
                    "shipping_fee", "tax", "total", "line1", "city", "postal_code", "country_code", "promo_code")


def v15_order_lines(wh: Warehouse) -> DataFrame:
    """Each line with its product's name and the units that came back."""
    back = wh.raw("returns").groupBy("order_id", "line_no").agg(F.sum("quantity").cast("bigint").alias("returned"))
    p = wh.raw("products").select(F.col("id").alias("product_id"), "name")
    j = wh.raw("order_items").join(p, "product_id").join(back, ["order_id", "line_no"], "left")
    return j.select("order_id", "line_no", "product_id", "name", "quantity", "unit_price", "discount", F.coalesce("returned", F.lit(0)).alias("returned"))


def v15_order_payments(wh: Warehouse) -> DataFrame:
    """Each attempt to pay, numbered in the order of the page (a failed one and its repeat are two)."""
    place = F.row_number().over(Window.partitionBy("order_id").orderBy("paid_at", "id"))  # a few attempts an order
    return wh.raw("payments").select("order_id", place.alias("place"), "method", "status", "amount", "paid_at")


def v15_order_shipments(wh: Warehouse) -> DataFrame:
    """Each parcel with its warehouse."""
    w = wh.raw("warehouses").select(F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse"))
    return wh.raw("shipments").join(w, "warehouse_id").select("order_id", "id", "status", "carrier", "tracking_number", "shipped_at", "delivered_at", "warehouse")


def v15_order_returns(wh: Warehouse) -> DataFrame:
    """Each return, numbered in the order of the page."""
    place = F.row_number().over(Window.partitionBy("order_id").orderBy("requested_at", "id"))
    return wh.raw("returns").select("order_id", place.alias("place"), "line_no", "quantity", "reason", "status", "refund_amount", "requested_at")


# V-16 returnable units and unit refund per line (integer cents) ----------------------------------------------
def v16_returnable(wh: Warehouse) -> DataFrame:
    o = wh.raw("orders").where(F.col("status") == "delivered").select(F.col("id").alias("order_id"))
    oi = wh.raw("order_items").join(o, "order_id")
    r = wh.raw("returns").groupBy("order_id", "line_no").agg(F.sum("quantity").alias("returned"))
    j = oi.join(r, ["order_id", "line_no"], "left")
    # whole cents: the unit price less the unit's share of the discount, rounded down
    unit = (F.col("unit_price") * 100).cast("bigint")
    return j.select("order_id", "line_no", "product_id",
                    (F.col("quantity") - F.coalesce("returned", F.lit(0))).cast("bigint").alias("returnable_units"),
                    (unit - F.expr("CAST(discount * 100 AS BIGINT) div quantity")).cast("bigint").alias("unit_refund_cents"))


# V-17 warehouse choice per order line ------------------------------------------------------------------------
def v17_warehouse_choice(wh: Warehouse) -> DataFrame:
    """Each line ships from the preferred warehouse with enough stock: same country first, then
    same region, then lowest id. Lines meet candidate stock rows by an equi join on product."""
    o = wh.raw("orders").select(F.col("id").alias("order_id"), "customer_id")
    cu = wh.raw("customers").select(F.col("id").alias("customer_id"), F.col("country_code").alias("c_country"))
    co = wh.raw("countries").select("code", "region")
    lines = wh.raw("order_items").select("order_id", "line_no", "product_id", "quantity").join(o, "order_id") \
        .join(cu, "customer_id").join(co.withColumnRenamed("code", "c_country").withColumnRenamed("region", "c_region"),
                                       "c_country")
    w = wh.raw("warehouses").select(F.col("id").alias("warehouse_id"), F.col("country_code").alias("w_country"))
    w = w.join(co.withColumnRenamed("code", "w_country").withColumnRenamed("region", "w_region"), "w_country")
    stock = wh.raw("inventory").select("warehouse_id", "product_id", "quantity_on_hand").join(w, "warehouse_id")
    cand = lines.join(stock, "product_id").where(F.col("quantity_on_hand") >= F.col("quantity"))
    best = keep_one(cand, ["order_id", "line_no"], [
        (F.col("w_country") == F.col("c_country")).desc(), (F.col("w_region") == F.col("c_region")).desc(),
        F.col("warehouse_id")])
    chosen = best.select("order_id", "line_no", "warehouse_id")
    return lines.select("order_id", "line_no", "product_id", "quantity").join(chosen, ["order_id", "line_no"], "left")


# V-18 cart pricing in cents ---------------------------------------------------------------------------------
def price_carts(wh: Warehouse, codes: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Price every cart as an order, with the promotion code that ``codes`` (cart_id, code) gives it, if any.

    A code that is not active at ``as_of``, or that covers no product of the cart, is a problem: such a cart gets no price.
    Unit = price cents x rate; discount on the lines that the code covers; shipping 5.99 USD unless the customer is vip
    or the rest is worth 5,000 US cents or more; tax on the rest. Each amount is rounded half up to whole cents."""
    t = F.lit(as_of).cast("timestamp_ntz")
    carts = wh.raw("carts").select(F.col("id").alias("cart_id"), "customer_id").join(codes, "cart_id", "left")
    active = wh.raw("promotions").where((t >= F.col("starts_at")) & (t < F.col("ends_at"))).select("code", F.col("id").alias("promotion_id"), "discount_pct")
    cu = wh.raw("customers").select(F.col("id").alias("customer_id"), "segment", "country_code")
    co = wh.raw("countries").select(F.col("code").alias("country_code"), "currency_code", "tax_rate")
    fx = wh.fx_rates_daily.where(F.col("day") == F.lit(as_of.date())).select("currency_code", F.col("units_per_usd").cast("double").alias("fx"))
    covered = wh.raw("promotion_products").select("promotion_id", "product_id", F.lit(True).alias("covered"))
    p = wh.raw("products").select(F.col("id").alias("product_id"), "price_usd")
    head = carts.join(active, "code", "left").join(cu, "customer_id").join(co, "country_code").join(fx, "currency_code")
    lines = wh.raw("cart_items").select("cart_id", "product_id", "quantity").join(head, "cart_id").join(p, "product_id")
    lines = lines.join(covered, ["promotion_id", "product_id"], "left").withColumn("covered", F.coalesce("covered", F.lit(False)))
    gross = _half_up((F.col("price_usd") * 100).cast("double") * F.col("fx")) * F.col("quantity")
    off = F.when(F.col("covered"), _half_up(gross * F.col("discount_pct").cast("double") / 100)).otherwise(0.0)
    by_cart = lines.groupBy("cart_id", "code", "promotion_id", "segment", "fx", "tax_rate").agg(
        F.sum(gross).alias("subtotal"), F.sum(off).alias("discount"), F.max("covered").alias("covered"))
    problem = F.when(F.col("code").isNotNull() & F.col("promotion_id").isNull(), "code is not active").when(
        F.col("code").isNotNull() & ~F.col("covered"), "code covers no product of the cart")
    rest = F.col("subtotal") - F.col("discount")
    shipping = F.when((F.col("segment") != "vip") & (rest / F.col("fx") < 5000), _half_up(599 * F.col("fx"))).otherwise(0.0)
    amounts = {"subtotal_cents": F.col("subtotal"), "discount_cents": F.col("discount"), "shipping_cents": shipping,
               "tax_cents": _half_up(rest * F.col("tax_rate").cast("double"))}
    out = by_cart.withColumn("problem", problem)
    out = out.select("cart_id", "code", "problem", *[F.when(F.col("problem").isNull(), v).cast("bigint").alias(k) for k, v in amounts.items()])
    return out.withColumn("total_cents", F.col("subtotal_cents") - F.col("discount_cents") + F.col("shipping_cents") + F.col("tax_cents"))


def v18_price_carts(wh: Warehouse) -> DataFrame:
    """Every cart priced at the start of the newest promotion: every second one tries its code, every third of the others that of some other promotion."""
    as_of = _promotion_start(wh)
    pr = wh.raw("promotions")
    newest = pr.where(F.col("starts_at") == F.lit(as_of)).agg(F.min("code").alias("now"))
    other = pr.where(F.col("starts_at") != F.lit(as_of)).select((F.col("id") % 5).alias("k"), "code").groupBy("k").agg(F.min("code").alias("other"))
    k = wh.raw("carts").select(F.col("id").alias("cart_id"), F.floor(F.col("id") / 10).alias("n")).withColumn("one", F.lit(1)).withColumn("k", F.col("n") % 5)
    codes = k.join(newest.withColumn("one", F.lit(1)), "one").join(other, "k", "left").select(
        "cart_id", F.when(F.col("n") % 2 == 0, F.col("now")).when(F.col("n") % 3 == 0, F.col("other")).alias("code"))
    return price_carts(wh, codes, as_of)


# V-19 product admin list: search, active filter, six sorts, pages -----------------------------------------------------
ADMIN_SORTS = {
    "id": lambda: [F.col("id")], "id_desc": lambda: [F.col("id").desc()],
    "price": lambda: [F.col("price_usd"), F.col("id")], "price_desc": lambda: [F.col("price_usd").desc(), F.col("id")],
    "name": lambda: [F.col("name"), F.col("id")], "name_desc": lambda: [F.col("name").desc(), F.col("id")],
    "created": lambda: [F.col("created_at"), F.col("id")],
}


def product_admin(wh: Warehouse, search: str | None = None, only_active: bool = False, sort: str = "id", page_size: int = PAGE_SIZE) -> DataFrame:
    """Products whose name or SKU contains ``search`` (any case; blanks around it do not count), by ``sort``, with position and page.

    A sort that is not known goes by id; a page holds 1 to 200 products."""
    from ..operators.keys import dense_key
    page_size = min(max(page_size, 1), 200)
    p = wh.raw("products").select("id", "sku", "name", "price_usd", "is_active", "created_at", "brand_id", "category_id")
    term = (search or "").strip().lower()
    if term:
        p = p.where(F.contains(F.lower("name"), F.lit(term)) | F.contains(F.lower("sku"), F.lit(term)))
    if only_active:
        p = p.where("is_active")
    b = wh.raw("brands").select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    c = wh.raw("categories").select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    rows = p.join(b, "brand_id").join(c, "category_id").select("id", "sku", "name", "brand", "category", "price_usd", "is_active", "created_at")
    keyed = dense_key(rows, ADMIN_SORTS.get(sort, ADMIN_SORTS["id"])(), "position")
    return keyed.withColumn("page", F.floor((F.col("position") - 1) / page_size).cast("bigint") + 1)


def v19_product_admin(wh: Warehouse) -> DataFrame:
    """The whole list by name."""
    return product_admin(wh, sort="name").drop("category", "created_at")


def v19_product_admin_sorts(wh: Warehouse) -> DataFrame:
    """Active products that a search for the first word (by alphabet) of all names finds, in every sort."""
    term = wh.raw("products").agg(F.min(F.split("name", " ")[0])).first()[0]
    out = None
    for sort in ADMIN_SORTS:
        one = product_admin(wh, f" {term} ".upper(), True, sort, 10).withColumn("sort", F.lit(sort))
        out = one if out is None else out.unionByName(one)
    return out


VIEWS = {k: v for k, v in globals().items() if k[:1] == "v" and k[1:3].isdigit() and callable(v)}

"""Data-quality reports over the store and the star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import check_fk, check_rules, check_unique
from .warehouse import Warehouse

# table -> primary / unique keys of the store model
KEYS = {
    "currencies": ["code"], "countries": ["code"], "fx_rates": ["currency_code", "rate_date"],
    "employees": ["id"], "warehouses": ["id"], "customers": ["id"], "addresses": ["id"], "categories": ["id"],
    "brands": ["id"], "suppliers": ["id"], "products": ["id"], "product_prices": ["product_id", "valid_from"],
    "product_suppliers": ["product_id", "supplier_id"], "inventory": ["warehouse_id", "product_id"],
    "promotions": ["id"], "promotion_products": ["promotion_id", "product_id"], "orders": ["id"],
    "order_items": ["order_id", "line_no"], "payments": ["id"], "shipments": ["id"], "returns": ["id"],
    "reviews": ["id"], "carts": ["id"], "cart_items": ["cart_id", "product_id"],
    "warehouses.code": ["code"], "customers.email": ["email"], "categories.slug": ["slug"], "products.sku": ["sku"],
    "promotions.code": ["code"], "carts.customer": ["customer_id"], "reviews.one_per_customer": ["product_id", "customer_id"],
    "product_prices.one_open": ["product_id"],
}
# keys that hold for a part of a table only
KEY_FILTERS = {"product_prices.one_open": "valid_to IS NULL"}

# (child table, child keys, parent table, parent keys)
FOREIGN_KEYS = [
    ("countries", ["currency_code"], "currencies", ["code"]),
    ("fx_rates", ["currency_code"], "currencies", ["code"]),
    ("employees", ["manager_id"], "employees", ["id"]),
    ("warehouses", ["country_code"], "countries", ["code"]),
    ("warehouses", ["manager_employee_id"], "employees", ["id"]),
    ("customers", ["country_code"], "countries", ["code"]),
    ("customers", ["referred_by_customer_id"], "customers", ["id"]),
    ("customers", ["account_manager_id"], "employees", ["id"]),
    ("addresses", ["customer_id"], "customers", ["id"]),
    ("categories", ["parent_id"], "categories", ["id"]),
    ("products", ["category_id"], "categories", ["id"]),
    ("products", ["brand_id"], "brands", ["id"]),
    ("product_prices", ["product_id"], "products", ["id"]),
    ("product_suppliers", ["product_id"], "products", ["id"]),
    ("product_suppliers", ["supplier_id"], "suppliers", ["id"]),
    ("inventory", ["warehouse_id"], "warehouses", ["id"]),
    ("inventory", ["product_id"], "products", ["id"]),
    ("promotion_products", ["promotion_id"], "promotions", ["id"]),
    ("promotion_products", ["product_id"], "products", ["id"]),
    ("orders", ["customer_id"], "customers", ["id"]),
    ("orders", ["shipping_address_id"], "addresses", ["id"]),
    ("orders", ["promotion_id"], "promotions", ["id"]),
    ("orders", ["currency_code"], "currencies", ["code"]),
    ("order_items", ["order_id"], "orders", ["id"]),
    ("order_items", ["product_id"], "products", ["id"]),
    ("order_items", ["warehouse_id"], "warehouses", ["id"]),
    ("payments", ["order_id"], "orders", ["id"]),
    ("shipments", ["order_id"], "orders", ["id"]),
    ("shipments", ["warehouse_id"], "warehouses", ["id"]),
    ("returns", ["order_id", "line_no"], "order_items", ["order_id", "line_no"]),
    ("employees", ["warehouse_id"], "warehouses", ["id"]),
    ("addresses", ["country_code"], "countries", ["code"]),
    ("suppliers", ["country_code"], "countries", ["code"]),
    ("carts", ["customer_id"], "customers", ["id"]),
    ("cart_items", ["cart_id"], "carts", ["id"]),
    ("cart_items", ["product_id"], "products", ["id"]),
    ("reviews", ["product_id"], "products", ["id"]),
    ("reviews", ["customer_id"], "customers", ["id"]),
]


def c06_key_checks(wh: Warehouse) -> DataFrame:
    parts = []
    for name, keys in KEYS.items():
        table = name.split(".")[0]
        d = check_unique(wh.raw(table).where(KEY_FILTERS.get(name, "true")).select(*keys), keys)
        parts.append(d.agg(F.count(F.lit(1)).cast("bigint").alias("duplicate_keys")).select(
            F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "duplicate_keys"))
    return reduce(DataFrame.unionByName, parts)


def c07_foreign_key_checks(wh: Warehouse) -> DataFrame:
    parts = []
    for child, ck, parent, pk in FOREIGN_KEYS:
        o = check_fk(wh.raw(child).select(*ck), wh.raw(parent), ck, pk)
        parts.append(o.agg(F.count(F.lit(1)).cast("bigint").alias("orphans")).select(
            F.lit(child).alias("table_name"), F.lit(",".join(ck)).alias("fk_columns"), F.lit(parent).alias("parent"),
            "orphans"))
    return reduce(DataFrame.unionByName, parts)


def c08_row_rules(wh: Warehouse) -> DataFrame:
    o, oi, s, r = wh.raw("orders"), wh.raw("order_items"), wh.raw("shipments"), wh.raw("reviews")
    pp = wh.raw("product_prices")
    parts = [
        check_rules(o, {"orders.total_identity": F.col("total") == F.col("subtotal") - F.col("discount")
                        + F.col("shipping_fee") + F.col("tax"),
                        "orders.non_negative": (F.col("total") >= 0) & (F.col("tax") >= 0) & (F.col("discount") >= 0),
                        "orders.status_known": F.col("status").isin("pending", "paid", "shipped", "delivered",
                                                                     "cancelled")}),
        check_rules(oi, {"order_items.quantity_positive": F.col("quantity") > 0,
                         "order_items.price_non_negative": F.col("unit_price") >= 0,
                         "order_items.discount_within_line": F.col("discount") <= F.col("unit_price")
                         * F.col("quantity")}),
        check_rules(s, {"shipments.delivered_after_shipped": F.col("delivered_at") >= F.col("shipped_at"),
                        "shipments.delivered_needs_shipped": ~(F.col("delivered_at").isNotNull()
                                                               & F.col("shipped_at").isNull())}),
        check_rules(r, {"reviews.rating_range": F.col("rating").between(1, 5)}),
        check_rules(pp, {"product_prices.range_ordered": F.col("valid_to") > F.col("valid_from"),
                         "product_prices.price_positive": F.col("price_usd") > 0}),
        check_rules(wh.raw("countries"), {"countries.tax_rate_range": (F.col("tax_rate") >= 0) & (F.col("tax_rate") < 1)}),
        check_rules(wh.raw("fx_rates"), {"fx_rates.positive": F.col("units_per_usd") > 0}),
        check_rules(wh.raw("employees"), {"employees.department_known": F.col("department").isin(
            "Executive", "Sales", "Operations", "Purchasing", "Support", "Finance")}),
        check_rules(wh.raw("customers"), {"customers.segment_known": F.col("segment").isin("consumer", "business", "vip")}),
        check_rules(wh.raw("addresses"), {"addresses.kind_known": F.col("kind").isin("shipping", "billing")}),
        check_rules(wh.raw("suppliers"), {"suppliers.rating_range": F.col("rating").between(1, 5)}),
        check_rules(wh.raw("products"), {"products.price_positive": F.col("price_usd") > 0, "products.cost_positive": F.col("cost_usd") > 0}),
        check_rules(wh.raw("inventory"), {"inventory.not_negative": F.col("quantity_on_hand") >= 0}),
        check_rules(wh.raw("promotions"), {"promotions.discount_range": (F.col("discount_pct") > 0) & (F.col("discount_pct") < 100),
                                           "promotions.range_ordered": F.col("ends_at") > F.col("starts_at")}),
        check_rules(wh.raw("cart_items"), {"cart_items.quantity_positive": F.col("quantity") > 0}),
        check_rules(wh.raw("payments"), {
            "payments.method_known": F.col("method").isin("card", "paypal", "bank_transfer", "gift_card", "pix"),
            "payments.status_known": F.col("status").isin("authorized", "captured", "refunded", "failed")}),
        check_rules(wh.raw("returns"), {"returns.quantity_positive": F.col("quantity") > 0, "returns.reason_known": F.col("reason").isin(
            "damaged", "wrong_item", "wrong_size", "not_as_described", "changed_mind", "late_delivery")}),
    ]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("rule", "rule_name")


def c09_fact_completeness(wh: Warehouse) -> DataFrame:
    o = wh.raw("orders").where(F.col("status") != "cancelled").select(F.col("id").alias("order_id"))
    expected = wh.raw("order_items").join(o, "order_id").agg(F.count(F.lit(1)).cast("bigint").alias("expected"))
    actual = wh.fact_sales.agg(F.count(F.lit(1)).cast("bigint").alias("actual"))
    u = expected.select(F.lit("expected").alias("k"), F.col("expected").alias("v")).unionByName(
        actual.select(F.lit("actual").alias("k"), F.col("actual").alias("v")))
    p = u.groupBy().pivot("k", ["expected", "actual"]).agg(F.first("v"))
    return p.select("expected", "actual", (F.col("expected") == F.col("actual")).alias("complete"))


def c10_fixture_sanity(wh: Warehouse) -> DataFrame:
    c, e, pp = wh.raw("customers"), wh.raw("employees"), wh.raw("product_prices")
    parts = [
        check_rules(c, {"customers.referrer_earlier": F.col("referred_by_customer_id") < F.col("id")}),
        check_rules(e, {"employees.manager_id_smaller": F.col("manager_id") < F.col("id")}),
        check_rules(pp.where(F.col("valid_to").isNotNull()),
                    {"product_prices.versions_ordered": F.col("valid_from") < F.col("valid_to")}),
    ]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("rule", "rule_name")


def c11_product_rules(wh: Warehouse) -> DataFrame:
    p = wh.raw("products")
    return check_rules(p, {
        "sku_length": F.length("sku").between(3, 32),
        "price_range": F.col("price_usd").between(0.01, 100000),
        "cost_not_above_price": F.col("cost_usd") <= F.col("price_usd"),
        "attributes_is_object": F.coalesce(F.trim("attributes").startswith("{")
                                           & F.json_object_keys("attributes").isNotNull(), F.lit(False)),
        "name_present": F.length(F.trim("name")) > 0,
    }).withColumnRenamed("rule", "rule_name")


def c02_sale_versions(wh: Warehouse) -> DataFrame:
    """Every sale points at the version valid when it was placed, by business key
    (product_id, valid_from): sales whose version key disagrees with a fresh SCD2 lookup."""
    dp = wh.dim_product.select("product_key", "product_id", "valid_from")
    fs = wh.fact_sales.select("order_id", "line_no", "product_key", "product_id", "placed_at")
    got = fs.join(dp.drop("product_id"), "product_key").select("order_id", "line_no", "product_id", "valid_from")
    pp = wh.raw("product_prices").select("product_id", F.col("valid_from").alias("vf"), F.col("valid_to").alias("vt"))
    want = fs.join(pp, (fs.product_id == pp.product_id) & (fs.placed_at >= pp.vf)
                   & ((fs.placed_at < pp.vt) | pp.vt.isNull())).select(
        "order_id", "line_no", fs.product_id, F.col("vf").alias("valid_from"))
    # rows of one side that the other lacks, repeats counted: both sides are read once, not once for each direction
    sides = got.withColumn("n", F.lit(1)).unionByName(want.withColumn("n", F.lit(-1)))
    bad = sides.groupBy("order_id", "line_no", "product_id", "valid_from").agg(F.abs(F.sum("n")).alias("n"))
    return bad.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("mismatched_sales"))


CHECKS = {
    "c02_sale_versions": c02_sale_versions,
    "c06_key_checks": c06_key_checks,
    "c07_foreign_key_checks": c07_foreign_key_checks,
    "c08_row_rules": c08_row_rules,
    "c09_fact_completeness": c09_fact_completeness,
    "c10_fixture_sanity": c10_fixture_sanity,
    "c11_product_rules": c11_product_rules,
}

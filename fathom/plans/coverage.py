"""Star tables, file sources and reconciliations as queries of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.digests import compare_by_digest
from ..operators.quality import normalize, same_result
from ..session import LOAD_CONF, settings, shared_scratch, written
from ..sources import files
from ..sources.fixtures import STORE_TABLES
from . import questions as Q
from .incremental import _loaded_in_two, over_written_store
from .warehouse import STAR_TABLES, Warehouse


def e01_dim_date(wh: Warehouse) -> DataFrame:
    return wh.dim_date


def e06_dim_promotion(wh: Warehouse) -> DataFrame:
    return wh.dim_promotion.select("promotion_id", "code", "name", "discount_pct", "starts_at", "ends_at",
                                   F.col("product_count").cast("bigint").alias("product_count"))


def e06_dim_warehouse(wh: Warehouse) -> DataFrame:
    return wh.dim_warehouse.select("warehouse_id", "code", "name", "city", "country_code", "country", "region", "manager")


def e08_fact_inventory(wh: Warehouse) -> DataFrame:
    return wh.fact_inventory


def s09_file_as_table(wh: Warehouse) -> DataFrame:
    """A Parquet file named in SQL as a table."""
    return wh.spark.sql(f"SELECT o_orderstatus, count(*) AS orders FROM parquet.`{wh.store.sf_dir}/orders.parquet` GROUP BY o_orderstatus")


def s10_csv_inferred(wh: Warehouse) -> DataFrame:
    """Products out as CSV with a header and back with inferred types."""
    p = wh.raw("products").select("id", "sku", "price_usd", "is_active")
    back = files.csv_round_trip(p, shared_scratch(wh.spark, "csv"))
    return back.select(F.col("id").cast("bigint").alias("id"), "sku", F.col("price_usd").cast("double").alias("price_usd"), "is_active")


def s15_column_ranges(wh: Warehouse) -> DataFrame:
    """The exact part of the summary: least, greatest, count and share of nulls of each column."""
    c = wh.dim_customer.select("customer_id", "full_name", "segment", "country", "signup_at", "cohort_month", "referred_by_customer_id", "account_manager")
    return files.summarize(c).select("column_name", "min", "max", "count", "null_pct")


def _sales_written(wh: Warehouse) -> Warehouse:
    """A warehouse of the same store whose sales are written once, for queries that read every table made of them."""
    wh = over_written_store(wh)
    once = Warehouse(wh.store, wh.max_order_id)
    with settings(wh.spark, LOAD_CONF):
        once.__dict__["fact_sales"] = written(once.fact_sales, "fact-sales")
    return once


def s16_star_tables(wh: Warehouse) -> DataFrame:
    """Rows of all star tables, from the catalog of temporary views."""
    once = _sales_written(wh)
    return files.catalog_listing(wh.spark, {f"dw_{n}": once.table(n) for n in STAR_TABLES}).select("table_name", "estimated_rows")


def c01_warehouses_agree(wh: Warehouse) -> DataFrame:
    """All star tables of a full plus an incremental load against those of one full load, keys apart: counts, and samples of what differs."""
    _, pub = _loaded_in_two(wh)
    once = _sales_written(wh)
    tables = {n: (pub.table(n).drop("year", "month"), once.table(n)) for n in STAR_TABLES}
    out = compare_by_digest(tables)
    return out.select("table", "rows_a", "rows_b", "only_a", "only_b", *[F.array_join(c, "\n").alias(c) for c in ("samples_a", "samples_b")])


def c03_copied_rows(wh: Warehouse) -> DataFrame:
    """All store tables copied to another store, with their row counts on both sides."""
    tables = {n: wh.raw(n) for n in STORE_TABLES}
    target = shared_scratch(wh.spark, "copy")
    files.copy_tables(tables, target)
    return files.verify_counts(wh.spark, tables, target).select("table_name", "source_rows", "target_rows", "ok")


#: Questions compared, with what orders the rows of their results.
_ORDER = {"monthly_revenue": ["month"], "cohort_retention": ["cohort", "months_later"], "rfm_segments": ["segment"], "clv_buckets": ["bucket"],
          "top_products_per_department": ["department", "rank"]}


def c04_models_agree(wh: Warehouse) -> DataFrame:
    """Results of store and star for the same question, cell by cell."""
    parts = []
    for name, order in _ORDER.items():
        store, star = Q.QUESTIONS[name]
        parts.append(same_result(store(wh), star(wh), order).withColumn("question", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def c05_normalized_products(wh: Warehouse) -> DataFrame:
    """Cells as they are compared: numbers as whole numbers or rounded, times as text, flags as 0 and 1, lists joined."""
    return normalize(wh.dim_product.select("product_id", "product_name", "list_price_usd", "is_active", "is_current", "valid_from"))


def p16_named_parameters(wh: Warehouse) -> DataFrame:
    """SQL with named parameters over a named table."""
    return wh.spark.sql("SELECT id, customer_id, total FROM {o} WHERE status = :status AND total >= :least", args={"status": "delivered", "least": 200000},
                        o=wh.raw("orders"))


def a21_order_ids_by_day(wh: Warehouse) -> DataFrame:
    """Ids of each day's cancelled orders as one text."""
    o = wh.raw("orders").where("status = 'cancelled'").select(F.col("placed_at").cast("date").alias("day"), "id")
    return o.groupBy("day").agg(F.expr("listagg(CAST(id AS STRING), ',') WITHIN GROUP (ORDER BY id)").alias("order_ids"))


COVERAGE = {k: v for k, v in globals().items() if k[:1] in "acesp" and k[1:3].isdigit() and callable(v)}

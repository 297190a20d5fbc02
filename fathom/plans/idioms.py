"""Projection idioms and exports as DataFrame code (P1-P10, F7, K9) and file sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from .warehouse import Warehouse


def p01_lateral_alias(wh: Warehouse) -> DataFrame:
    """An alias defined in the projection reused by the next expression and by the filter."""
    fo = wh.fact_orders
    x = fo.select("order_id", (F.col("total_usd") - F.col("tax_usd")).alias("net_usd"))
    x = x.withColumn("commission_usd", (F.col("net_usd") * F.lit(0.1).cast("decimal(2,1)")).cast("decimal(16,3)"))
    return x.where(F.col("net_usd") > 5000)


def p02_exclude_replace(wh: Warehouse) -> DataFrame:
    """SELECT * EXCLUDE (fx_rate, currency_code) REPLACE (round(total_usd) AS total_usd)."""
    fo = wh.fact_orders.drop("fx_rate", "currency_code")
    return fo.withColumns({"total_usd": F.round("total_usd", 0).cast("decimal(14,0)")}).select(
        "order_id", "status", "total_usd", "tax_usd", "customer_order_number")


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """COLUMNS('regex'): the column names matching a regular expression."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.fullmatch(c)]


def p04_columns_regex(wh: Warehouse) -> DataFrame:
    fo = wh.fact_orders
    return fo.agg(*[F.max(c).alias(f"max_{c}") for c in columns_like(fo, ".*_usd")])


def p05_string_ops(wh: Warehouse) -> DataFrame:
    dp = wh.dim_product.where("is_current")
    return dp.select("product_id", F.get(F.split(F.upper("product_name"), " "), 0).alias("brand_upper"),
                     F.lower(F.trim("brand")).alias("brand_lower"), F.length("product_name").alias("name_length"),
                     F.instr("product_name", " ").alias("first_space"))


def p10_json_containment(wh: Warehouse) -> DataFrame:
    """attributes @> {"color": "red", "warranty_months": 24}: every key of the probe equal."""
    p = wh.raw("products")
    a = F.from_json("attributes", "color STRING, warranty_months INT, sizes ARRAY<STRING>")
    x = p.select("id", "name", a.alias("a"))
    hit = x.where((F.col("a.color") == "red") & (F.col("a.warranty_months") == 24))
    return hit.select("id", "name", F.col("a.color").alias("color"), F.to_json("a.sizes").alias("sizes"))


def k09_json_export(wh: Warehouse) -> DataFrame:
    """Nested columns as JSON text for a store without list types."""
    dc = wh.dim_category.select("category_id", F.to_json("path").alias("path_json"))
    return dc


def k09_json_export_employees(wh: Warehouse) -> DataFrame:
    return wh.dim_employee.select("employee_id", F.to_json("management_chain_ids").alias("chain_json"))


def s07_file_rows(wh: Warehouse) -> DataFrame:
    spark = wh.spark
    return files.file_rows(spark.read.parquet(f"{wh.store.sf_dir}/orders.parquet"))


def s08_parquet_footers(wh: Warehouse) -> DataFrame:
    """Column ranges of each file of the lines."""
    return files.file_ranges(wh.spark.read.parquet(f"{wh.store.sf_dir}/lineitem.parquet"))


def s14_describe(wh: Warehouse) -> DataFrame:
    return files.describe(wh.fact_sales)


def s15_summarize(wh: Warehouse) -> DataFrame:
    return files.summarize(wh.dim_customer)


def s16_catalog_listing(wh: Warehouse) -> DataFrame:
    names = ["dim_category", "dim_product", "dim_employee", "dim_customer", "fact_orders", "fact_sales"]
    return files.catalog_listing(wh.spark, {f"dw_{n}": wh.table(n) for n in names})


def s17_size_report(wh: Warehouse) -> DataFrame:
    return files.size_report(wh.spark, wh.store.sf_dir)


def s21_max_text_lengths(wh: Warehouse) -> DataFrame:
    return files.max_text_lengths(wh.raw("products").select("sku", "name", "attributes"))


IDIOMS = {k: v for k, v in globals().items() if k[:1] in ("p", "k", "s") and k[1:3].isdigit() and callable(v)}

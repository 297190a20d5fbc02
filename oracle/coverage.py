"""Oracle statements for star tables, file sources and reconciliations (DuckDB dialect)."""

from .questions import QUESTION, STAR_SOURCE, over

SQL = {}

SQL["e01_dim_date"] = """
WITH q_days AS (
    SELECT CAST(unnest(generate_series(min(CAST(placed_at AS DATE)), max(CAST(placed_at AS DATE)) + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM st_orders
)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month, CAST(week(d) AS INTEGER) AS iso_week,
       CAST(isodow(d) AS INTEGER) AS iso_day_of_week, dayname(d) AS day_name, isodow(d) > 5 AS is_weekend
FROM q_days"""

SQL["e06_dim_promotion"] = "SELECT * FROM dw_dim_promotion"
SQL["e06_dim_warehouse"] = "SELECT * FROM dw_dim_warehouse"
_INVENTORY = """
SELECT i.warehouse_id, i.product_id, i.quantity_on_hand, i.reorder_point, i.quantity_on_hand <= i.reorder_point AS needs_reorder,
       CAST(i.quantity_on_hand * p.cost_usd AS DECIMAL(14,2)) AS stock_value_usd
FROM st_inventory i, st_products p WHERE p.id = i.product_id"""
SQL["e08_fact_inventory"] = _INVENTORY

SQL["s09_file_as_table"] = "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus"
SQL["s10_csv_inferred"] = "SELECT id, sku, CAST(price_usd AS DOUBLE) AS price_usd, is_active FROM st_products"

SQL["s15_column_ranges"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, count({c}) AS count, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct FROM dw_dim_customer"
    for c in ("customer_id", "full_name", "segment", "country", "signup_at", "cohort_month", "referred_by_customer_id", "account_manager"))

_NAMES = ("dim_category dim_product dim_employee dim_customer dim_warehouse dim_promotion fact_orders fact_sales fact_returns fact_reviews "
          "product_stats").split()
#: Rows of every star table.
_STAR_ROWS = " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM dw_{n}" for n in _NAMES) + """
UNION ALL SELECT 'dim_date', CAST(max(placed_at) AS DATE) - CAST(min(placed_at) AS DATE) + 366 FROM st_orders
UNION ALL SELECT 'fact_inventory', count(*) FROM st_inventory
UNION ALL SELECT 'product_pairs', sum(least(others, 8)) FROM (
    SELECT a.product_id, count(DISTINCT b.product_id) AS others FROM dw_fact_sales a, dw_fact_sales b
    WHERE b.order_id = a.order_id AND b.product_id <> a.product_id GROUP BY a.product_id)"""
SQL["s16_star_tables"] = f"SELECT 'dw_' || name AS table_name, CAST(n AS BIGINT) AS estimated_rows FROM ({_STAR_ROWS})"
SQL["c01_warehouses_agree"] = f"""
SELECT name AS "table", CAST(n AS BIGINT) AS rows_a, CAST(n AS BIGINT) AS rows_b, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b, '' AS samples_a, '' AS samples_b
FROM ({_STAR_ROWS})"""
_STORE = ("currencies countries fx_rates employees customers addresses categories brands products product_prices suppliers product_suppliers "
          "warehouses inventory promotions promotion_products orders order_items shipments payments returns reviews").split()
#: A tenth of the customers has a cart, with one or two different products.
_CARTS = """
UNION ALL SELECT 'carts', count(*), count(*), true FROM st_customers WHERE id % 10 = 0
UNION ALL SELECT 'cart_items', n, n, true FROM (
    SELECT sum(CASE WHEN (7 * id) % p = (13 * id + 1) % p THEN 1 ELSE 2 END)::BIGINT AS n FROM st_customers, (SELECT count(*) AS p FROM part) WHERE id % 10 = 0)"""
SQL["c03_copied_rows"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS ok FROM st_{n}" for n in _STORE) + _CARTS
SQL["c04_models_agree"] = " UNION ALL ".join(
    f"SELECT '{q}' AS question, count(*) AS rows_a, count(*) AS rows_b, 0 AS missing_columns, 0 AS differing_cells FROM ({over(STAR_SOURCE, QUESTION[q])})"
    for q in ("monthly_revenue", "cohort_retention", "rfm_segments", "clv_buckets", "top_products_per_department"))
SQL["c05_normalized_products"] = """
SELECT product_id, trim(product_name) AS product_name, round(CAST(list_price_usd AS DOUBLE), 2) AS list_price_usd, CAST(is_active AS BIGINT) AS is_active,
       CAST(is_current AS BIGINT) AS is_current, replace(strftime(valid_from, '%Y-%m-%d %H:%M:%S'), ' 00:00:00', '') AS valid_from
FROM dw_dim_product"""
SQL["p16_named_parameters"] = "SELECT id, customer_id, total FROM st_orders WHERE status = 'delivered' AND total >= 200000"
SQL["a21_order_ids_by_day"] = """
SELECT CAST(placed_at AS DATE) AS day, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS order_ids
FROM st_orders WHERE status = 'cancelled' GROUP BY 1"""

"""Oracle statements for projection idioms, exports and file sources (DuckDB dialect)."""

SQL = {}

SQL["p01_lateral_alias"] = """
SELECT order_id, total_usd - tax_usd AS net_usd, CAST(net_usd * 0.1 AS DECIMAL(16,3)) AS commission_usd
FROM dw_fact_orders WHERE net_usd > 5000"""

SQL["p02_exclude_replace"] = """
SELECT order_id, status, total_usd, tax_usd, customer_order_number
FROM (SELECT * EXCLUDE (fx_rate, currency_code) REPLACE (CAST(round(total_usd) AS DECIMAL(14,0)) AS total_usd)
      FROM dw_fact_orders)"""

SQL["p04_columns_regex"] = """
SELECT max(subtotal_usd) AS max_subtotal_usd, max(discount_usd) AS max_discount_usd, max(shipping_usd) AS max_shipping_usd,
       max(tax_usd) AS max_tax_usd, max(total_usd) AS max_total_usd, max(refund_usd) AS max_refund_usd
FROM dw_fact_orders"""

SQL["p05_string_ops"] = """
SELECT product_id, product_name.upper().split(' ')[1] AS brand_upper, lower(trim(brand)) AS brand_lower,
       CAST(length(product_name) AS INTEGER) AS name_length, CAST(strpos(product_name, ' ') AS INTEGER) AS first_space
FROM dw_dim_product WHERE is_current"""

SQL["p10_json_containment"] = """
SELECT id, name, attributes ->> '$.color' AS color,
       CASE WHEN json_exists(attributes, '$.sizes') THEN CAST(attributes -> '$.sizes' AS VARCHAR) END AS sizes
FROM st_products
WHERE attributes ->> '$.color' = 'red' AND CAST(attributes ->> '$.warranty_months' AS INTEGER) = 24"""

SQL["k09_json_export"] = """
SELECT category_id, CAST(to_json(path) AS VARCHAR) AS path_json FROM dw_dim_category"""

SQL["k09_json_export_employees"] = """
SELECT employee_id, CAST(to_json(management_chain_ids) AS VARCHAR) AS chain_json FROM dw_dim_employee"""

SQL["s07_file_rows"] = """
SELECT 'orders.parquet' AS file_name, count(*) AS rows FROM orders"""

SQL["s21_max_text_lengths"] = """
SELECT 'sku' AS column_name, CAST(max(length(sku)) AS BIGINT) AS max_len FROM st_products
UNION ALL SELECT 'name', CAST(max(length(name)) AS BIGINT) FROM st_products
UNION ALL SELECT 'attributes', CAST(max(length(attributes)) AS BIGINT) FROM st_products"""

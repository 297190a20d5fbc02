"""Oracle statements for the loads (DuckDB dialect): what one full load of the same source gives."""

SQL = {}

SQL["e09_incremental_sales"] = """
SELECT s.order_id, s.line_no, s.order_date, s.customer_id, s.product_id, v.valid_from, s.quantity, s.net_usd, s.margin_usd
FROM dw_fact_sales s JOIN dw_dim_product v USING (product_key)"""

SQL["e11_incremental_order_numbers"] = "SELECT order_id, customer_id, status, total_usd, customer_order_number FROM dw_fact_orders"

SQL["e14_etl_runs"] = """
SELECT 'v=000001' AS version, 'full' AS mode, max(id) * 9 // 10 AS max_order_id FROM st_orders
UNION ALL SELECT 'v=000002', 'incremental', max(id) FROM st_orders"""

_ITEMS = """items AS (
    SELECT DISTINCT id AS cart_id, unnest([1 + (7 * id) % (SELECT count(*) FROM part), 1 + (13 * id + 1) % (SELECT count(*) FROM part)]) AS product_id,
           CAST(1 + id % 3 AS INTEGER) AS quantity
    FROM st_customers WHERE id % 10 = 0
)"""

SQL["e16_cart_upsert"] = f"""
WITH {_ITEMS}
SELECT cart_id, product_id, CAST(sum(quantity) AS INTEGER) AS quantity FROM (
    SELECT cart_id, product_id, 2 * quantity AS quantity FROM items
    UNION ALL SELECT cart_id, max(product_id) + 1, 1 FROM items GROUP BY cart_id
) GROUP BY cart_id, product_id"""

SQL["e17_stock_after_orders"] = """
SELECT i.warehouse_id, i.product_id, CAST(i.quantity_on_hand + ifnull(sum(CASE o.status WHEN 'pending' THEN -l.quantity WHEN 'cancelled' THEN l.quantity END), 0)
       AS INTEGER) AS quantity_on_hand
FROM st_inventory i
LEFT JOIN (st_order_items l JOIN st_orders o ON o.id = l.order_id AND o.status IN ('pending', 'cancelled'))
  ON l.warehouse_id = i.warehouse_id AND l.product_id = i.product_id
GROUP BY i.warehouse_id, i.product_id, i.quantity_on_hand"""

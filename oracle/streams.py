"""Oracle statements for the streaming jobs (DuckDB dialect): what the stream must have emitted."""

_PLACED = "o_orderdate + INTERVAL 1 SECOND * ((o_orderkey * 7919) % 86400)"

SQL = {}

SQL["t01_upserted_orders"] = """
SELECT id, customer_id, status, placed_at, placed_at + INTERVAL 2 DAY AS updated_at FROM st_orders"""

SQL["t02_dedup_orders"] = """
SELECT id, customer_id, status, placed_at FROM st_orders"""

SQL["t03_weekly_counts"] = """
WITH q_o AS (
    SELECT customer_id, placed_at,
           make_timestamp(CAST(floor(epoch_us(placed_at) / 604800000000) * 604800000000 AS BIGINT)) AS window_start
    FROM st_orders
)
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, count(*) AS orders,
       count(DISTINCT customer_id) AS customers, max(placed_at) AS last_order_at
FROM q_o
GROUP BY window_start"""

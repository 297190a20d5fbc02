"""Oracle statements for a day of changes (DuckDB dialect)."""

SQL = {}

_AT = "q_at AS (SELECT date_trunc('day', max(placed_at)) + INTERVAL 1 DAY AS t FROM st_orders)"
_KIND = """CASE WHEN o.status IN ('paid', 'pending') AND o.id % 29 = 3 THEN 'cancelled' WHEN o.status = 'paid' AND o.id % 13 = 1 THEN 'shipped'
            WHEN o.status = 'shipped' AND o.id % 17 = 2 THEN 'delivered' END"""

SQL["e12_changed_orders"] = f"""
WITH {_AT}, moved AS (
    SELECT o.id, {_KIND} AS now_is, t, o.status, o.placed_at + INTERVAL 2 DAY AS updated_at FROM st_orders o, q_at
), parcels AS (
    SELECT s.order_id, count(*) FILTER (s.shipped_at IS NOT NULL OR now_is IN ('shipped', 'delivered')) AS sent,
           count(*) FILTER (s.delivered_at IS NOT NULL OR now_is = 'delivered') AS arrived
    FROM st_shipments s JOIN moved m ON m.id = s.order_id GROUP BY s.order_id
), back AS (
    SELECT order_id, count(*) AS returned FROM (
        SELECT order_id, line_no FROM st_returns
        UNION SELECT i.order_id, i.line_no FROM st_order_items i JOIN st_orders o ON o.id = i.order_id WHERE i.line_no = 1 AND o.status = 'delivered' AND o.id % 31 = 4
    ) GROUP BY order_id
)
SELECT m.id AS order_id, coalesce(now_is, status) AS status,
       CASE now_is WHEN 'shipped' THEN t WHEN 'delivered' THEN t + INTERVAL 1 HOUR WHEN 'cancelled' THEN t + INTERVAL 2 HOUR ELSE updated_at END AS updated_at,
       coalesce(sent, 0) AS sent, coalesce(arrived, 0) AS arrived, coalesce(returned, 0) AS returned
FROM moved m LEFT JOIN parcels p ON p.order_id = m.id LEFT JOIN back b ON b.order_id = m.id"""

_PRICES = f"""
WITH {_AT}, events AS (
    SELECT p.id AS product_id, t + e.after AS at_time, CASE WHEN e.factor IS NULL THEN NULL ELSE CAST(round(p.price_usd * e.factor, 2) AS DECIMAL(12,2)) END AS price, e.no
    FROM st_products p, q_at, (VALUES (5, 1, INTERVAL 0 HOUR, CAST(1.100 AS DECIMAL(5,3))), (6, 1, INTERVAL 1 HOUR, 1.100), (7, 2, INTERVAL 2 HOUR, 1.210),
                                    (8, 3, INTERVAL (-400) DAY, 0.950), (9, 5, INTERVAL 3 HOUR, NULL)) AS e(no, of_each, after, factor)
    WHERE p.id % 7 = 0 AND p.id % e.of_each = 0
), told AS (
    SELECT product_id, valid_from AS at_time, price_usd AS price, 0 AS no, true AS known FROM st_product_prices
    UNION ALL SELECT product_id, at_time, price, no, false FROM events
), one AS (
    SELECT product_id, at_time, arg_max({{'p': price}}, no).p AS price, bool_or(known) AS known FROM told GROUP BY product_id, at_time
), marked AS (
    SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY at_time) IS NOT DISTINCT FROM price AS same FROM one
), kept AS (
    SELECT product_id, at_time, price, lead(at_time) OVER (PARTITION BY product_id ORDER BY at_time) AS ends FROM marked WHERE known OR NOT same
), versions AS (
    SELECT product_id, at_time AS valid_from, ends AS valid_to, price AS price_usd FROM kept WHERE price IS NOT NULL
)"""

SQL["e13_price_versions"] = _PRICES + " SELECT * FROM versions"

SQL["e13_renamed_products"] = _PRICES + """
SELECT p.id, CASE WHEN p.id % 97 = 0 THEN p.name || ' (renamed)' ELSE p.name END AS name, CASE WHEN p.id % 7 = 0 THEN coalesce(v.price_usd, p.price_usd) ELSE p.price_usd END AS price_usd
FROM st_products p LEFT JOIN versions v ON v.product_id = p.id AND v.valid_to IS NULL"""

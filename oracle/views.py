"""Oracle statements for the store-page batch views (DuckDB dialect)."""

NOW = "(SELECT max(placed_at) FROM st_orders)"
#: When the newest promotion that covers a product begins.
AS_OF = "(SELECT max(starts_at) FROM st_promotions WHERE id IN (SELECT promotion_id FROM st_promotion_products))"
TRI = ("list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({s}), '[^a-z0-9]+'), "
       "lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), "
       "lambda i: substring('  ' || w || ' ', i, 3)))))")


def tri(s: str) -> str:
    return TRI.format(s=s)


SQL = {}

SQL["v01_best_sellers"] = f"""
SELECT p.id AS product_id, p.name, b.name AS brand, CAST(p.price_usd AS DOUBLE) AS price_usd,
       CAST(sum(oi.quantity) AS BIGINT) AS units
FROM st_orders o JOIN st_order_items oi ON oi.order_id = o.id
JOIN st_products p ON p.id = oi.product_id JOIN st_brands b ON b.id = p.brand_id
WHERE o.placed_at >= {NOW} - INTERVAL 7 DAY AND o.status <> 'cancelled'
GROUP BY p.id, p.name, b.name, p.price_usd
ORDER BY units DESC, product_id LIMIT 8"""

SQL["v02_trending"] = """
SELECT product_id, CAST(units_90d AS BIGINT) AS units_90d, avg_rating, review_count
FROM dw_product_stats ORDER BY units_90d DESC, product_id LIMIT 8"""

_PROMO = f"""
q_best AS (
    SELECT pp.product_id, pr.code, pr.name, pr.discount_pct, pr.ends_at,
           row_number() OVER (PARTITION BY pp.product_id ORDER BY pr.discount_pct DESC, pr.id) AS rn
    FROM st_promotion_products pp JOIN st_promotions pr ON pr.id = pp.promotion_id
    WHERE {AS_OF} >= pr.starts_at AND {AS_OF} < pr.ends_at
)"""
SQL["v03_active_promotion"] = f"""
WITH {_PROMO}
SELECT b.product_id, b.code, b.name, CAST(b.discount_pct AS DOUBLE) AS discount_pct, b.ends_at, p.price_usd,
       CAST(round(CAST(p.price_usd * (100 - b.discount_pct) AS DECIMAL(18,4)) * 0.01, 2) AS DECIMAL(12,2)) AS promo_price_usd
FROM q_best b JOIN st_products p ON p.id = b.product_id WHERE b.rn = 1"""

SQL["v04_stock"] = """
SELECT i.product_id, w.code, w.city, co.name AS country, i.quantity_on_hand,
       CAST(sum(i.quantity_on_hand) OVER (PARTITION BY i.product_id) AS BIGINT) AS total_on_hand
FROM st_inventory i JOIN st_warehouses w ON w.id = i.warehouse_id JOIN st_countries co ON co.code = w.country_code"""

SQL["v05_rating_summary"] = """
SELECT product_id, count(*) AS reviews, round(avg(rating), 4) AS avg_rating,
       count(*) FILTER (WHERE rating = 5) AS r5, count(*) FILTER (WHERE rating = 4) AS r4,
       count(*) FILTER (WHERE rating = 3) AS r3, count(*) FILTER (WHERE rating = 2) AS r2,
       count(*) FILTER (WHERE rating = 1) AS r1
FROM st_reviews GROUP BY product_id"""

SQL["v06_latest_reviews"] = """
SELECT r.product_id, r.id, r.rating, 'Review ' || r.id AS title, 'Fine.' AS body, r.created_at, c.first_name, c.country_code
FROM st_reviews r JOIN st_customers c ON c.id = r.customer_id
QUALIFY row_number() OVER (PARTITION BY r.product_id ORDER BY r.created_at DESC, r.id DESC) <= 5"""

SQL["v07_price_history"] = """
SELECT product_id, valid_from, valid_to, CAST(price_usd AS DOUBLE) AS price_usd FROM st_product_prices"""

SQL["v08_bought_together"] = """
WITH q_per AS (SELECT order_id, product_id, count(*) AS n FROM dw_fact_sales GROUP BY ALL),
q_pairs AS (
    SELECT a.product_id, b.product_id AS other_product_id, CAST(sum(a.n * b.n) AS BIGINT) AS orders_together
    FROM q_per a JOIN q_per b ON b.order_id = a.order_id AND b.product_id <> a.product_id
    GROUP BY a.product_id, b.product_id
)
SELECT * FROM q_pairs
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY orders_together DESC, other_product_id) <= 8"""

SQL["v09_category_pages"] = """
WITH q_below AS (
    SELECT list_extract(ids, k) AS category_id, node AS leaf
    FROM (SELECT node, list(spot) AS ids FROM dw_climb WHERE kind = 'category' GROUP BY node), range(1, 20) r(k) WHERE k <= len(ids)
), q_shelf AS (
    SELECT b.category_id, p.id AS product_id, p.name, p.price_usd, p.brand_id
    FROM q_below b, st_products p WHERE p.category_id = b.leaf AND p.is_active
), q_sorted AS (
    SELECT *, 'name' AS sort, row_number() OVER (PARTITION BY category_id ORDER BY name, product_id) AS position FROM q_shelf
    UNION ALL SELECT *, 'price', row_number() OVER (PARTITION BY category_id ORDER BY price_usd, product_id) FROM q_shelf
    UNION ALL SELECT *, 'price_desc', row_number() OVER (PARTITION BY category_id ORDER BY price_usd DESC, product_id) FROM q_shelf
    UNION ALL SELECT *, 'newest', row_number() OVER (PARTITION BY category_id ORDER BY product_id) FROM q_shelf  -- all made at one time
)
SELECT s.category_id, s.sort, s.position, (s.position - 1) // 24 AS page_index,
       (SELECT count(*) FROM q_shelf t WHERE t.category_id = s.category_id) AS total, s.product_id, s.name, b.name AS brand,
       CAST(s.price_usd AS DOUBLE) AS price_usd,
       round(ifnull((SELECT avg(rating) FROM st_reviews r WHERE r.product_id = s.product_id), 0), 4) AS rating,
       (SELECT count(*) FROM st_reviews r WHERE r.product_id = s.product_id) AS reviews
FROM q_sorted s, st_brands b WHERE b.id = s.brand_id"""

SQL["v10_search"] = f"""
WITH q_p AS (SELECT id AS product_id, name FROM st_products WHERE is_active),
q_terms AS (
    SELECT DISTINCT unnest(list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda w: w <> '')) AS term
    FROM q_p
), q_hit AS (
    SELECT t.term, p.product_id, p.name,
           round(len(list_intersect({tri('p.name')}, {tri('t.term')}))
                 / len(list_distinct(list_concat({tri('p.name')}, {tri('t.term')}))), 6) AS similarity
    FROM q_terms t JOIN q_p p ON p.name ILIKE '%' || t.term || '%'
)
SELECT term, product_id, name, similarity FROM q_hit
QUALIFY row_number() OVER (PARTITION BY term ORDER BY similarity DESC, product_id) <= 48"""

SQL["v11_account_summary"] = """
SELECT c.id AS customer_id, 'cust' || c.id || '@example.com' AS email, c.created_at AS signup_at, m.name AS account_manager,
       count(o.id) AS orders, min(o.placed_at) AS first_order_at
FROM st_customers c LEFT JOIN dw_dim_employee m ON m.employee_id = c.account_manager_id
LEFT JOIN st_orders o ON o.customer_id = c.id AND NOT o.status = 'cancelled'
GROUP BY c.id, c.created_at, m.name"""

SQL["v12_customer_profile"] = """
WITH q_fx AS (
    SELECT currency_code, arg_max(units_per_usd, rate_date) AS fx, max(rate_date) AS rate_date
    FROM st_fx_rates GROUP BY currency_code
), q_carts AS (
    SELECT id, id AS customer_id FROM st_customers WHERE id % 10 = 0
), q_cart_items AS (
    SELECT DISTINCT c.id AS cart_id, unnest([1 + (7 * c.id) % (SELECT count(*) FROM part),
                                             1 + (13 * c.id + 1) % (SELECT count(*) FROM part)]) AS product_id,
           CAST(1 + c.id % 3 AS INTEGER) AS quantity
    FROM q_carts c
), q_cart AS (
    SELECT c.customer_id, CAST(sum(ci.quantity) AS BIGINT) AS cart_units
    FROM q_cart_items ci JOIN q_carts c ON c.id = ci.cart_id GROUP BY c.customer_id
)
SELECT cu.id AS customer_id, cu.segment, cu.country_code, co.currency_code, fx.fx, fx.rate_date,
       coalesce(ca.cart_units, 0) AS cart_units
FROM st_customers cu JOIN st_countries co ON co.code = cu.country_code
LEFT JOIN q_fx fx ON fx.currency_code = co.currency_code LEFT JOIN q_cart ca ON ca.customer_id = cu.id"""

SQL["v13_default_address"] = """
SELECT id // 2 AS customer_id, id AS address_id, 'Street ' || (id // 2) AS line1, 'City ' || ((id // 2) % 97) AS city,
       lpad(CAST((id // 2) % 100000 AS VARCHAR), 5, '0') AS postal_code, country_code
FROM (SELECT id * 2 AS id, country_code FROM st_customers)"""

SQL["v14_cart_lines"] = """
WITH q_carts AS (SELECT id FROM st_customers WHERE id % 10 = 0),
q_items AS (
    SELECT DISTINCT c.id AS cart_id, unnest([1 + (7 * c.id) % (SELECT count(*) FROM part),
                                             1 + (13 * c.id + 1) % (SELECT count(*) FROM part)]) AS product_id,
           CAST(1 + c.id % 3 AS INTEGER) AS quantity
    FROM q_carts c
), q_stock AS (SELECT product_id, CAST(sum(quantity_on_hand) AS BIGINT) AS in_stock FROM st_inventory GROUP BY ALL)
SELECT i.cart_id, i.product_id, p.name, b.name AS brand, i.quantity, p.price_usd, coalesce(s.in_stock, 0) AS in_stock
FROM q_items i JOIN st_products p ON p.id = i.product_id JOIN st_brands b ON b.id = p.brand_id LEFT JOIN q_stock s ON s.product_id = i.product_id"""

SQL["v15_order_detail"] = """
WITH q_r AS (SELECT order_id, line_no, sum(quantity) AS returned FROM st_returns GROUP BY ALL),
q_p AS (SELECT order_id, count(*) AS payments,
               CAST(sum(amount) FILTER (WHERE status = 'captured') AS DECIMAL(18,2)) AS captured
        FROM st_payments GROUP BY ALL),
q_s AS (SELECT order_id, count(*) AS shipments FROM st_shipments GROUP BY ALL)
SELECT oi.order_id, oi.line_no, oi.product_id, oi.quantity, oi.unit_price,
       CAST(coalesce(r.returned, 0) AS BIGINT) AS returned_units, coalesce(p.payments, 0) AS payments, p.captured,
       coalesce(s.shipments, 0) AS shipments
FROM st_order_items oi LEFT JOIN q_r r USING (order_id, line_no) LEFT JOIN q_p p USING (order_id)
LEFT JOIN q_s s USING (order_id)"""

SQL["v16_returnable"] = """
WITH q_r AS (SELECT order_id, line_no, sum(quantity) AS returned FROM st_returns GROUP BY ALL)
SELECT oi.order_id, oi.line_no, oi.product_id, CAST(oi.quantity - coalesce(r.returned, 0) AS BIGINT) AS returnable_units,
       CAST(oi.unit_price * 100 AS BIGINT) - CAST(oi.discount * 100 AS BIGINT) // oi.quantity AS unit_refund_cents
FROM st_order_items oi JOIN st_orders o ON o.id = oi.order_id AND o.status = 'delivered'
LEFT JOIN q_r r USING (order_id, line_no)"""

SQL["v17_warehouse_choice"] = """
WITH q_lines AS (
    SELECT oi.order_id, oi.line_no, oi.product_id, oi.quantity, cu.country_code AS c_country, cc.region AS c_region
    FROM st_order_items oi JOIN st_orders o ON o.id = oi.order_id JOIN st_customers cu ON cu.id = o.customer_id
    JOIN st_countries cc ON cc.code = cu.country_code
), q_choice AS (
    SELECT l.order_id, l.line_no, w.id AS warehouse_id,
           row_number() OVER (PARTITION BY l.order_id, l.line_no
                              ORDER BY (w.country_code = l.c_country) DESC, (wc.region = l.c_region) DESC, w.id) AS rn
    FROM q_lines l JOIN st_inventory i ON i.product_id = l.product_id AND i.quantity_on_hand >= l.quantity
    JOIN st_warehouses w ON w.id = i.warehouse_id JOIN st_countries wc ON wc.code = w.country_code
)
SELECT l.order_id, l.line_no, l.product_id, l.quantity, c.warehouse_id
FROM q_lines l LEFT JOIN q_choice c ON c.order_id = l.order_id AND c.line_no = l.line_no AND c.rn = 1"""

SQL["v19_product_admin"] = """
SELECT p.id, 'SKU-' || lpad(CAST(p.id AS VARCHAR), 8, '0') AS sku, p.name, b.name AS brand, p.price_usd, p.is_active,
       row_number() OVER (ORDER BY p.name, p.id) AS position,
       (row_number() OVER (ORDER BY p.name, p.id) - 1) // 24 + 1 AS page
FROM st_products p JOIN st_brands b ON b.id = p.brand_id"""

SQL["v15_order_headers"] = """
SELECT o.id AS order_id, o.customer_id, c.first_name || ' ' || c.last_name AS customer, o.status, o.placed_at, o.placed_at + INTERVAL 2 DAY AS updated_at,
       o.currency_code, CASE o.currency_code WHEN 'USD' THEN '$' WHEN 'CAD' THEN 'C$' WHEN 'EUR' THEN '€' WHEN 'GBP' THEN '£' ELSE '¥' END AS symbol,
       o.subtotal, o.discount, o.shipping_fee, o.tax, o.total, a.line1, a.city, a.postal_code, a.country_code,
       CASE WHEN o.promotion_id IS NOT NULL THEN 'PROMO' || o.promotion_id END AS promo_code
FROM st_orders o JOIN st_customers c ON c.id = o.customer_id JOIN st_addresses a ON a.id = o.shipping_address_id"""

SQL["v15_order_lines"] = """
SELECT i.order_id, i.line_no, i.product_id, p.name, i.quantity, i.unit_price, i.discount,
       CAST(coalesce((SELECT sum(r.quantity) FROM st_returns r WHERE r.order_id = i.order_id AND r.line_no = i.line_no), 0) AS BIGINT) AS returned
FROM st_order_items i JOIN st_products p ON p.id = i.product_id"""

SQL["v15_order_payments"] = """
SELECT order_id, CAST(row_number() OVER (PARTITION BY order_id ORDER BY paid_at, id) AS INTEGER) AS place, method, status, amount, paid_at FROM st_payments"""

SQL["v15_order_shipments"] = """
SELECT s.order_id, s.id, CASE WHEN delivered_at IS NOT NULL THEN 'delivered' WHEN shipped_at IS NOT NULL THEN 'in_transit' ELSE 'pending' END AS status,
       s.carrier, 'TRK' || s.id AS tracking_number, s.shipped_at, s.delivered_at, w.name AS warehouse
FROM st_shipments s JOIN st_warehouses w ON w.id = s.warehouse_id"""

SQL["v15_order_returns"] = """
SELECT order_id, CAST(row_number() OVER (PARTITION BY order_id ORDER BY requested_at, id) AS INTEGER) AS place, line_no, quantity, reason, 'refunded' AS status,
       refund_amount, requested_at FROM st_returns"""

SQL["v19_product_admin_sorts"] = """
WITH q_word AS (SELECT min(split_part(name, ' ', 1)) AS term FROM st_products),
q_found AS (
    SELECT p.id, p.sku, p.name, b.name AS brand, c.name AS category, p.price_usd, p.is_active,
           TIMESTAMP '1994-01-01 00:00:00' AS created_at
    FROM st_products p JOIN st_brands b ON b.id = p.brand_id JOIN st_categories c ON c.id = p.category_id, q_word
    WHERE p.is_active AND (p.name ILIKE '%' || term || '%' OR p.sku ILIKE '%' || term || '%')
), q_placed AS (
    SELECT *, 'id' AS sort, row_number() OVER (ORDER BY id) AS position FROM q_found
    UNION ALL SELECT *, 'id_desc', row_number() OVER (ORDER BY id DESC) FROM q_found
    UNION ALL SELECT *, 'price', row_number() OVER (ORDER BY price_usd, id) FROM q_found
    UNION ALL SELECT *, 'price_desc', row_number() OVER (ORDER BY price_usd DESC, id) FROM q_found
    UNION ALL SELECT *, 'name', row_number() OVER (ORDER BY name, id) FROM q_found
    UNION ALL SELECT *, 'name_desc', row_number() OVER (ORDER BY name DESC, id) FROM q_found
    UNION ALL SELECT *, 'created', row_number() OVER (ORDER BY created_at, id) FROM q_found
)
SELECT *, (position - 1) // 10 + 1 AS page FROM q_placed"""

SQL["v18_price_carts"] = f"""
WITH q_promo AS (
    SELECT id AS promotion_id, code, CAST(discount_pct AS DOUBLE) AS pct, starts_at = {AS_OF} AS newest, {AS_OF} >= starts_at AND {AS_OF} < ends_at AS active FROM st_promotions
), q_cart AS (
    SELECT id AS cart_id, segment, country_code,
           CASE WHEN (id // 10) % 2 = 0 THEN (SELECT min(code) FROM q_promo WHERE newest)
                WHEN (id // 10) % 3 = 0 THEN (SELECT min(p.code) FROM q_promo p WHERE NOT p.newest AND p.promotion_id % 5 = (id // 10) % 5) END AS code
    FROM st_customers WHERE id % 10 = 0
), q_items AS (
    SELECT DISTINCT cart_id, unnest([1 + (7 * cart_id) % (SELECT count(*) FROM part), 1 + (13 * cart_id + 1) % (SELECT count(*) FROM part)]) AS product_id,
           1 + cart_id % 3 AS quantity
    FROM q_cart
), q_lines AS (
    SELECT c.cart_id, c.code, a.promotion_id, c.segment, CAST(fx.units_per_usd AS DOUBLE) AS fx, CAST(co.tax_rate AS DOUBLE) AS tax_rate, a.pct,
           floor(CAST(p.price_usd * 100 AS DOUBLE) * CAST(fx.units_per_usd AS DOUBLE) + 0.5) * i.quantity AS gross, pp.product_id IS NOT NULL AS covered
    FROM q_cart c JOIN q_items i USING (cart_id) JOIN st_products p ON p.id = i.product_id JOIN st_countries co ON co.code = c.country_code
    JOIN st_fx_rates_daily fx ON fx.currency_code = co.currency_code AND fx.day = CAST({AS_OF} AS DATE)
    LEFT JOIN q_promo a ON a.code = c.code AND a.active
    LEFT JOIN st_promotion_products pp ON pp.promotion_id = a.promotion_id AND pp.product_id = i.product_id
), q_sums AS (
    SELECT cart_id, code, promotion_id, segment, fx, tax_rate, sum(gross) AS subtotal, bool_or(covered) AS covered,
           sum(CASE WHEN covered THEN floor(gross * pct / 100 + 0.5) ELSE 0 END) AS discount
    FROM q_lines GROUP BY ALL
), q_told AS (
    SELECT *, CASE WHEN code IS NOT NULL AND promotion_id IS NULL THEN 'code is not active'
                   WHEN code IS NOT NULL AND NOT covered THEN 'code covers no product of the cart' END AS problem FROM q_sums
), q_priced AS (
    SELECT cart_id, code, problem, CASE WHEN problem IS NULL THEN CAST(subtotal AS BIGINT) END AS subtotal_cents,
           CASE WHEN problem IS NULL THEN CAST(discount AS BIGINT) END AS discount_cents,
           CASE WHEN problem IS NULL THEN CAST(CASE WHEN segment <> 'vip' AND (subtotal - discount) / fx < 5000 THEN floor(599 * fx + 0.5) ELSE 0 END AS BIGINT) END AS shipping_cents,
           CASE WHEN problem IS NULL THEN CAST(floor((subtotal - discount) * tax_rate + 0.5) AS BIGINT) END AS tax_cents
    FROM q_told
)
SELECT *, subtotal_cents - discount_cents + shipping_cents + tax_cents AS total_cents FROM q_priced"""


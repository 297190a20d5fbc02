-- Oracle fixture block: the store tables rebuilt in DuckDB SQL from the driver views.
-- Written independently of the Spark code; shared by every oracle statement.
st_currencies AS (
    SELECT r_regionkey AS region_key,
           ['USD', 'CAD', 'EUR', 'GBP', 'JPY'][r_regionkey + 1] AS code,
           ['US Dollar', 'Canadian Dollar', 'Euro', 'Pound Sterling', 'Yen'][r_regionkey + 1] AS name,
           CAST([1000, 1360, 920, 790, 148000][r_regionkey + 1] AS BIGINT) AS base_milli
    FROM region
),
st_countries AS (
    SELECT 'N' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS code, n.n_name AS name, r.r_name AS region,
           c.code AS currency_code,
           CAST(CAST(n.n_nationkey % 5 AS DECIMAL(5,4)) * 0.05 AS DECIMAL(5,4)) AS tax_rate,
           n.n_nationkey AS nation_key
    FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
    JOIN st_currencies c ON c.region_key = n.n_regionkey
),
st_fx_rates AS (
    SELECT code AS currency_code, rate_date,
           CAST(CAST(base_milli * CASE WHEN code = 'USD' THEN 1000
                                       ELSE 980 + (7 * date_diff('day', DATE '1994-12-26', rate_date) + 13 * region_key) % 41 END
                     AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(18,8)) AS units_per_usd
    FROM st_currencies,
         (SELECT CAST(unnest(generate_series(DATE '1994-12-26', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS rate_date) g
    WHERE isodow(rate_date) <= 5
),
st_fx_rates_daily AS (
    -- each rate holds until the day before its successor, the newest for another year
    SELECT currency_code, CAST(unnest(range(rate_date, held_until, INTERVAL 1 DAY)) AS DATE) AS day, units_per_usd
    FROM (SELECT *, coalesce(lead(rate_date) OVER by_currency, rate_date + INTERVAL 366 DAY) AS held_until
          FROM st_fx_rates WINDOW by_currency AS (PARTITION BY currency_code ORDER BY rate_date))
),
st_employees AS (
    SELECT s.s_suppkey + 1 AS id,
           CASE WHEN s.s_suppkey = 0 THEN NULL ELSE (s.s_suppkey - 1) // 3 + 1 END AS manager_id,
           'Emp' AS first_name, CAST(s.s_suppkey + 1 AS VARCHAR) AS last_name,
           CASE WHEN s.s_suppkey = 0 THEN 'CEO' WHEN s.s_suppkey < 4 THEN 'Director'
                WHEN s.s_suppkey < 13 THEN 'Manager' ELSE 'Account Executive' END AS title,
           CASE WHEN s.s_suppkey = 0 THEN 'Executive' WHEN s.s_suppkey % 4 = 3 THEN 'Operations' ELSE 'Sales' END AS department,
           CASE WHEN s.s_suppkey = 0 THEN NULL ELSE c.region END AS region
    FROM supplier s LEFT JOIN st_countries c ON c.nation_key = s.s_nationkey
),
st_customers AS (
    SELECT c_custkey + 1 AS id, 'Cust' AS first_name, CAST(c_custkey + 1 AS VARCHAR) AS last_name,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'vip'
                WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'business' ELSE 'consumer' END AS segment,
           'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
           CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey // 2 + 1 END AS referred_by_customer_id,
           CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE', 'HOUSEHOLD')
                THEN 1 + c_custkey % (SELECT count(*) FROM supplier) END AS account_manager_id,
           TIMESTAMP '1994-01-01 00:00:00' + INTERVAL 1 DAY * (c_custkey % 365) AS created_at
    FROM customer
),
st_types AS (
    SELECT p_type, dense_rank() OVER (ORDER BY p_type) AS t FROM (SELECT DISTINCT p_type FROM part)
),
st_categories AS (
    SELECT CAST(t AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, p_type AS name FROM st_types
    UNION ALL
    SELECT CAST(100 + 10 * t + b AS BIGINT), CAST(t AS BIGINT), p_type || ' band ' || b
    FROM st_types, range(0, 5) r(b)
    UNION ALL
    SELECT CAST(10000 + 10 * (100 + 10 * t + b) + l AS BIGINT), CAST(100 + 10 * t + b AS BIGINT),
           p_type || ' band ' || b || ' line ' || l
    FROM st_types, range(0, 5) r(b), range(0, 2) q(l)
    WHERE b % 2 = 0
),
st_brands AS (
    SELECT CAST(dense_rank() OVER (ORDER BY p_brand) AS BIGINT) AS id, p_brand AS name
    FROM (SELECT DISTINCT p_brand FROM part)
),
st_products AS (
    SELECT p.p_partkey + 1 AS id, 'SKU-' || lpad(CAST(p.p_partkey + 1 AS VARCHAR), 8, '0') AS sku, p.p_name AS name,
           CAST(CASE WHEN ((p.p_size - 1) // 10) % 2 = 0
                     THEN 10000 + 10 * (100 + 10 * t.t + (p.p_size - 1) // 10) + p.p_partkey % 2
                     ELSE 100 + 10 * t.t + (p.p_size - 1) // 10 END AS BIGINT) AS category_id,
           b.id AS brand_id,
           CAST(p.p_retailprice AS DECIMAL(12,2)) AS price_usd,
           CAST(round(CAST(p.p_retailprice AS DECIMAL(12,2)) * 0.6, 2) AS DECIMAL(12,2)) AS cost_usd,
           '{"color":"' || ['black', 'white', 'red', 'blue'][p.p_partkey % 4 + 1] || '","warranty_months":'
               || CAST((p.p_partkey % 3) * 12 AS VARCHAR)
               || CASE WHEN p.p_partkey % 5 = 0 THEN ',"sizes":["S","M","L"]' ELSE '' END || '}' AS attributes,
           p.p_partkey % 50 <> 7 AS is_active
    FROM part p JOIN st_types t USING (p_type) JOIN st_brands b ON b.name = p.p_brand
),
st_product_prices AS (
    SELECT product_id, valid_from,
           lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS valid_to, price_usd
    FROM (
        SELECT p.id AS product_id, v.valid_from, CAST(round(p.price_usd * v.factor, 2) AS DECIMAL(12,2)) AS price_usd
        FROM st_products p,
             (VALUES (TIMESTAMP '1994-01-01 00:00:00', 0.90, 1),
                     (TIMESTAMP '1997-06-01 09:00:00', 0.95, 2),
                     (TIMESTAMP '1999-11-15 12:30:00', 1.00, 3)) v(valid_from, factor, m)
        WHERE p.id % v.m = 0
    )
),
st_warehouses AS (
    SELECT CAST(n_nationkey // 5 + 1 AS BIGINT) AS id, 'WH-' || (n_nationkey // 5 + 1) AS code,
           'Warehouse ' || (n_nationkey // 5 + 1) AS name,
           'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code,
           'City ' || (n_nationkey // 5 + 1) AS city,
           CAST(n_nationkey // 5 + 3 AS BIGINT) AS manager_employee_id
    FROM nation WHERE n_nationkey % 5 = 0 AND n_nationkey < 25
),
st_inventory AS (
    SELECT CAST(w AS BIGINT) AS warehouse_id, p.id AS product_id,
           CAST((31 * p.id + 17 * w) % 200 AS INTEGER) AS quantity_on_hand, 40 AS reorder_point
    FROM st_products p, range(1, 6) r(w)
),
st_promotions AS (
    SELECT CAST(i AS BIGINT) AS id, 'PROMO' || i AS code, 'Promotion ' || i AS name,
           CAST(5 + i AS DECIMAL(5,2)) AS discount_pct,
           TIMESTAMP '1995-01-01 00:00:00' + INTERVAL 1 DAY * (182 * i) AS starts_at,
           TIMESTAMP '1995-01-01 00:00:00' + INTERVAL 1 DAY * (182 * i + 60) AS ends_at
    FROM range(1, 13) r(i)
),
st_promotion_products AS (
    SELECT CAST(pr.id AS BIGINT) AS promotion_id, p.id AS product_id
    FROM st_products p JOIN st_promotions pr
      ON pr.id <= 11 AND (p.id % 12 = pr.id - 1 OR p.id % 12 = pr.id % 12)
),
st_orders AS (
    SELECT o.o_orderkey + 1 AS id, o.o_custkey + 1 AS customer_id, (o.o_custkey + 1) * 2 AS shipping_address_id,
           CASE WHEN (o.o_orderkey + 1) % 4 = 0 THEN CAST(1 + (o.o_orderkey + 1) % 12 AS BIGINT) END AS promotion_id,
           CASE WHEN o.o_orderkey % 33 = 0 THEN 'cancelled' WHEN o.o_orderstatus = 'F' THEN 'delivered'
                WHEN o.o_orderstatus = 'O' THEN 'shipped' WHEN o.o_orderkey % 10 = 1 THEN 'pending'
                ELSE 'paid' END AS status,
           cur.code AS currency_code,
           CAST(CAST(o.o_totalprice AS DECIMAL(14,2))
                - CASE WHEN o.o_orderkey % 3 = 0 THEN 6.00 ELSE 0.00 END
                - CAST(CAST(o.o_orderkey % 900 AS DECIMAL(14,0)) * 0.01 AS DECIMAL(14,2))
                + CASE WHEN o.o_orderkey % 4 = 3 THEN CAST(o.o_orderkey % 70 AS DECIMAL(14,2)) ELSE 0.00 END
                AS DECIMAL(14,2)) AS subtotal,
           CAST(CASE WHEN o.o_orderkey % 4 = 3 THEN o.o_orderkey % 70 ELSE 0 END AS DECIMAL(14,2)) AS discount,
           CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN 6.00 ELSE 0.00 END AS DECIMAL(14,2)) AS shipping_fee,
           CAST(CAST(o.o_orderkey % 900 AS DECIMAL(14,0)) * 0.01 AS DECIMAL(14,2)) AS tax,
           CAST(o.o_totalprice AS DECIMAL(14,2)) AS total,
           o.o_orderdate + INTERVAL 1 SECOND * ((o.o_orderkey * 7919) % 86400) AS placed_at
    FROM orders o
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    JOIN st_currencies cur ON cur.region_key = n.n_regionkey
),
st_lines AS (
    SELECT l_orderkey + 1 AS order_id,
           CAST(row_number() OVER (PARTITION BY l_orderkey
                                   ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS SMALLINT) AS line_no,
           l_partkey + 1 AS product_id,
           CAST(1 + l_suppkey % 5 AS BIGINT) AS warehouse_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
           CAST(CASE WHEN l_discount > 0.05 THEN 10 * CAST(l_quantity AS INTEGER) ELSE 0 END AS DECIMAL(12,2)) AS discount,
           l_returnflag AS return_flag
    FROM lineitem
),
st_order_items AS (
    SELECT order_id, line_no, product_id, warehouse_id, quantity, unit_price, discount FROM st_lines
),
st_shipments AS (
    SELECT id * 10 + n AS id, id AS order_id, CAST(1 + (id + n) % 5 AS BIGINT) AS warehouse_id,
           ['DHL', 'FedEx', 'UPS', 'USPS'][id % 4 + 1] AS carrier,
           shipped_at,
           CASE WHEN status = 'delivered' AND NOT (n = 2 AND id % 21 = 0)
                THEN shipped_at + INTERVAL 1 DAY * (1 + (id + 3 * n) % 11) + INTERVAL 1 SECOND * ((37 * id) % 36000)
           END AS delivered_at
    FROM (
        SELECT o.id, o.status, n,
               CASE WHEN o.status IN ('shipped', 'delivered')
                    THEN o.placed_at + INTERVAL 1 SECOND * (14400 + (613 * o.id) % 240000 + (n - 1) * 3600) END AS shipped_at
        FROM st_orders o, range(1, 3) r(n)
        WHERE o.status IN ('paid', 'shipped', 'delivered') AND (n = 1 OR o.id % 7 = 0)
    )
),
st_payments AS (
    SELECT o.id * 10 + n AS id, o.id AS order_id,
           ['card', 'paypal', 'bank_transfer', 'gift_card'][(o.id + n) % 4 + 1] AS method,
           CASE WHEN n = 0 THEN 'failed' ELSE 'captured' END AS status,
           o.total AS amount,
           o.placed_at + INTERVAL 1 SECOND * (CASE WHEN n = 0 THEN 60 ELSE 1800 END) AS paid_at
    FROM st_orders o, range(0, 2) r(n)
    WHERE n = 1 OR o.id % 50 = 1
),
st_returns AS (
    SELECT l.order_id * 100 + l.line_no AS id, l.order_id, l.line_no, 1 AS quantity,
           ['damaged', 'wrong_item', 'not_as_described', 'changed_mind', 'late_delivery'][(l.product_id + l.order_id) % 5 + 1] AS reason,
           l.unit_price AS refund_amount,
           o.placed_at + INTERVAL 1 DAY * (20 + l.order_id % 10) AS requested_at
    FROM st_lines l JOIN st_orders o ON o.id = l.order_id
    WHERE o.status = 'delivered' AND l.return_flag = 'R' AND (l.product_id % 5 = 0 OR l.order_id % 9 = 0)
),
st_reviews AS (
    SELECT product_id * 100000000 + customer_id AS id, product_id, customer_id,
           CAST(1 + (3 * product_id + customer_id) % 5 AS SMALLINT) AS rating,
           min(placed_at) + INTERVAL 30 DAY AS created_at
    FROM st_order_items l JOIN st_orders o ON o.id = l.order_id
    WHERE o.status = 'delivered' AND (l.product_id + l.order_id) % 4 = 0
    GROUP BY product_id, customer_id
),
st_addresses AS (
    SELECT c.id * 2 + n AS id, c.id AS customer_id, CASE WHEN n = 0 THEN 'shipping' ELSE 'billing' END AS kind,
           'Street ' || c.id AS line1, 'City ' || (c.id % 97) AS city,
           lpad(CAST(c.id % 100000 AS VARCHAR), 5, '0') AS postal_code, c.country_code, n = 0 AS is_default
    FROM st_customers c, range(0, 2) r(n)
    WHERE n = 0 OR c.id % 3 = 0
),
st_suppliers AS (
    SELECT s_suppkey + 1 AS id, s_name AS name, 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS country_code,
           CAST(1 + s_suppkey % 5 AS SMALLINT) AS rating
    FROM supplier
),
st_product_suppliers AS (
    SELECT p.id AS product_id, CAST(1 + (p.id + 7 * n) % (SELECT count(*) FROM supplier) AS BIGINT) AS supplier_id,
           CAST(round(p.cost_usd * CASE WHEN n = 0 THEN 1.00 ELSE 1.05 END, 2) AS DECIMAL(12,2)) AS unit_cost_usd,
           CAST(3 + p.id % 20 AS INTEGER) AS lead_time_days, n = 0 AS is_primary
    FROM st_products p, range(0, 2) r(n)
)

"""Oracle statements for the fifteen questions (DuckDB dialect).

Both models feed the same small relations: ``ord`` (an order), ``line`` (a sold
line with its product), ``back`` (returned units of a line), ``parcel`` (the last
parcel of a delivered order), ``lead_of`` (an employee and one above it) and
``head`` (employees). Each question is one statement over those relations, so
store and star must agree. Money comes from the exact-cents macro and is summed
as DECIMAL(18,2); ratios are DOUBLE.
"""

from __future__ import annotations

_UP = """up(node, spot, steps) AS (
    SELECT id, id, 0 FROM st_categories
    UNION ALL SELECT up.node, st_categories.parent_id, up.steps + 1 FROM up, st_categories
              WHERE st_categories.id = up.spot AND st_categories.parent_id IS NOT NULL
), tree AS (
    SELECT node AS category_id, list(name ORDER BY steps DESC) AS path FROM up JOIN st_categories ON id = spot GROUP BY node
), chief(employee_id, leader_id) AS (
    SELECT id, id FROM st_employees
    UNION ALL SELECT chief.employee_id, st_employees.manager_id FROM chief, st_employees
              WHERE st_employees.id = chief.leader_id AND st_employees.manager_id IS NOT NULL
)"""

STORE_SOURCE = f"""{_UP}, ord AS (
    SELECT o.id AS order_id, o.placed_at, CAST(o.placed_at AS DATE) AS day, o.customer_id, o.status, o.currency_code,
           c.units_per_usd AS rate, @USD[o.total | c.units_per_usd]@ AS usd
    FROM st_orders o, st_fx_rates_daily c
    WHERE c.currency_code = o.currency_code AND c.day = CAST(o.placed_at AS DATE)
), line AS (
    SELECT ord.*, i.line_no, i.product_id, p.name AS product_name, maker.name AS brand, tree.path[1] AS level1, tree.path[2] AS level2,
           i.quantity, i.unit_price, @USD[i.unit_price * i.quantity - i.discount | ord.rate]@ AS net
    FROM ord, st_order_items i, st_products p, st_brands maker, tree
    WHERE i.order_id = ord.order_id AND p.id = i.product_id AND maker.id = p.brand_id AND tree.category_id = p.category_id
      AND ord.status <> 'cancelled'
), back AS (
    SELECT order_id, line_no, quantity AS returned FROM st_returns
), parcel AS (
    SELECT s.p.carrier AS carrier, s.p.shipped_at AS shipped_at, s.p.delivered_at AS delivered_at
    FROM (SELECT list({{'carrier': carrier, 'shipped_at': shipped_at, 'delivered_at': delivered_at}}
                      ORDER BY delivered_at DESC NULLS FIRST, shipped_at DESC NULLS FIRST, id DESC)[1] AS p
          FROM st_shipments GROUP BY order_id) s
), head AS (
    SELECT e.id AS employee_id, concat(e.first_name, ' ', e.last_name) AS name, e.title, e.department,
           (SELECT count(*) - 1 FROM chief WHERE chief.employee_id = e.id) AS level
    FROM st_employees e
), lead_of AS (
    SELECT employee_id, leader_id FROM chief
), manager_of AS (
    SELECT id AS customer_id, account_manager_id FROM st_customers
), sized AS (
    SELECT order_id, count(*) AS line_count FROM st_order_items GROUP BY order_id
)"""

STAR_SOURCE = """ord AS (
    SELECT order_id, placed_at, order_date AS day, customer_id, status, currency_code, fx_rate AS rate, total_usd AS usd FROM dw_fact_orders
), line AS (
    SELECT s.order_id, s.placed_at, s.order_date AS day, s.customer_id, s.order_status AS status, s.currency_code, s.line_no, s.product_id,
           p.product_name, p.brand, p.category_l1 AS level1, p.category_l2 AS level2, s.quantity, s.unit_price_local AS unit_price,
           s.net_usd AS net
    FROM dw_fact_sales s, dw_dim_product p WHERE p.product_key = s.product_key
), back AS (
    SELECT order_id, line_no, quantity AS returned FROM dw_fact_returns
), parcel AS (
    SELECT carrier, shipped_at, delivered_at FROM dw_fact_orders
), head AS (
    SELECT employee_id, name, title, department, level FROM dw_dim_employee
), lead_of AS (
    SELECT employee_id, unnest(management_chain_ids) AS leader_id FROM dw_dim_employee
), manager_of AS (
    SELECT customer_id, account_manager_id FROM dw_dim_customer
), sized AS (
    SELECT order_id, ifnull(line_count, 0) AS line_count FROM dw_fact_orders
)"""

_LAST = "(SELECT max(day) FROM ord)"
_MONTH = "make_date(year(day), month(day), 1)"
_USD = "CAST(sum(net) AS DECIMAL(18,2))"

QUESTION = {}

QUESTION["monthly_revenue"] = f"SELECT {_MONTH} AS month, count(DISTINCT order_id) AS orders, {_USD} AS revenue_usd FROM line GROUP BY ALL"

QUESTION["category_rollup"] = f"""
SELECT level1, level2, count(DISTINCT order_id) AS orders, {_USD} AS revenue_usd
FROM line GROUP BY GROUPING SETS ((level1, level2), (level1), ())"""

QUESTION["active_customers"] = f"""
SELECT {_MONTH} AS month, count(DISTINCT customer_id) AS active_customers, count(order_id) AS orders
FROM ord WHERE status <> 'cancelled' GROUP BY ALL"""

#: Months are numbered from year 0, so a distance is a difference of numbers.
COHORTS = """seen AS (
    SELECT customer_id, 12 * year(day) + month(day) - 1 AS m,
           min(12 * year(day) + month(day) - 1) OVER (PARTITION BY customer_id) AS born
    FROM ord WHERE status <> 'cancelled'
), kept_on AS (
    SELECT born, m - born AS later, count(DISTINCT customer_id) AS customers FROM seen GROUP BY born, later
)"""
QUESTION["cohort_retention"] = f"""
WITH {COHORTS}
SELECT make_date(born // 12, born % 12 + 1, 1) AS cohort, CAST(later AS INTEGER) AS months_later, customers FROM kept_on WHERE later < 13"""

QUESTION["rfm_segments"] = f"""
WITH bought AS (
    SELECT customer_id, {_LAST} - max(day) AS quiet_days, count(*) AS times, sum(usd) AS spent
    FROM ord WHERE status <> 'cancelled' GROUP BY customer_id
), fifths AS (
    SELECT times, spent, ntile(5) OVER late AS r, ntile(5) OVER often AS f FROM bought
    WINDOW late AS (ORDER BY quiet_days DESC, customer_id), often AS (ORDER BY times, customer_id)
)
SELECT CASE WHEN f > 3 THEN if(r > 3, 'Champions', 'Loyal')
            WHEN r < 3 THEN if(f = 3, 'At risk', 'Hibernating')
            ELSE if(r > 3, 'Recent, occasional', 'Needs attention') END AS segment,
       count(*) AS customers, round(avg(times), 2) AS avg_orders, round(CAST(avg(spent) AS DOUBLE), 2) AS avg_spend_usd
FROM fifths GROUP BY segment"""

QUESTION["top_products_per_department"] = f"""
WITH year_sales AS (
    SELECT level1 AS department, product_id, min(product_name) AS product_name, {_USD} AS revenue_usd
    FROM line WHERE day + 365 > {_LAST} GROUP BY level1, product_id
), podium AS (
    SELECT department, unnest(list({{'p': product_id, 'n': product_name, 'usd': revenue_usd}} ORDER BY revenue_usd DESC, product_id)[1:3]) AS w,
           unnest(range(1, 1 + least(3, count(*)))) AS rank
    FROM year_sales GROUP BY department
)
SELECT department, CAST(rank AS INTEGER) AS rank, w.p AS product_id, w.n AS product_name, w.usd AS revenue_usd FROM podium"""

QUESTION["basket_pairs"] = f"""
WITH baskets AS (
    SELECT list_sort(list(DISTINCT product_id)) AS b FROM line WHERE day + 90 > {_LAST} GROUP BY order_id
), firsts AS (
    SELECT b, unnest(range(1, len(b))) AS i FROM baskets
), together AS (
    SELECT product_a, product_b, count(*) AS orders_together
    FROM (SELECT b[i] AS product_a, unnest(b[i + 1:]) AS product_b FROM firsts) GROUP BY ALL
    ORDER BY 3 DESC, 1, 2 LIMIT 20
), names AS (
    SELECT id AS product_id, name FROM st_products
)
SELECT product_a, a.name AS name_a, product_b, b.name AS name_b, orders_together
FROM together, names a, names b WHERE a.product_id = product_a AND b.product_id = product_b"""

QUESTION["brand_returns"] = """
WITH delivered AS (
    SELECT brand, quantity, ifnull(returned, 0) AS returned FROM line LEFT JOIN back USING (order_id, line_no) WHERE status = 'delivered'
), brands AS (
    SELECT brand, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(returned) AS BIGINT) AS units_returned FROM delivered GROUP BY brand
)
SELECT *, round(100.0 * units_returned / units_sold, 2) AS return_rate_pct FROM brands WHERE units_sold > 1000
ORDER BY return_rate_pct DESC, brand LIMIT 15"""

QUESTION["delivery_percentiles"] = """
WITH trips AS (
    SELECT carrier, (epoch(delivered_at) - epoch(shipped_at)) / 86400.0 AS d FROM parcel WHERE delivered_at IS NOT NULL
), marks AS (
    SELECT carrier, count(*) AS deliveries, quantile_cont(d, [0.5, 0.9]) AS q, count_if(d > 7) AS slow FROM trips GROUP BY carrier
)
SELECT carrier, deliveries, round(q[1], 2) AS p50_days, round(q[2], 2) AS p90_days, round(100.0 * slow / deliveries, 2) AS over_7_days_pct FROM marks"""

#: Revenue of the last year by leader, over everyone below that leader (or the leader).
LED = f"""
WITH earned AS (
    SELECT account_manager_id AS employee_id, sum(net) AS usd
    FROM line JOIN manager_of USING (customer_id) WHERE account_manager_id IS NOT NULL AND day + 365 > {_LAST} GROUP BY 1
), led AS (
    SELECT leader_id, count(*) AS account_executives, CAST(sum(usd) AS DECIMAL(18,2)) AS revenue_usd
    FROM earned JOIN lead_of USING (employee_id) GROUP BY leader_id
)"""
QUESTION["sales_hierarchy"] = f"""{LED}
SELECT CAST(level AS INTEGER) AS level, employee_id, name, title, account_executives, revenue_usd
FROM led JOIN head ON employee_id = leader_id WHERE department = 'Sales' AND level < 4"""

#: Days whose orders fall out of 0.6 to 1.8 times the mean of the seven days before.
ODD_DAYS = """
WITH counted AS (
    SELECT day, count(*) AS orders FROM ord GROUP BY day
), based AS (
    SELECT *, sum(orders) OVER week / count(*) OVER week AS base, min(day) OVER () AS opening FROM counted
    WINDOW week AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
), odd AS (
    SELECT day AS order_date, orders, base, round(100.0 * orders / base - 100, 1) AS change_pct
    FROM based WHERE day - opening > 30 AND orders NOT BETWEEN 0.6 * base AND 1.8 * base
)"""
QUESTION["unusual_days"] = f"{ODD_DAYS}\nSELECT order_date, orders, round(base, 1) AS avg_prev_7d, change_pct FROM odd"

QUESTION["yoy_growth"] = f"""
WITH by_month AS (
    SELECT level1 AS department, 12 * year(day) + month(day) - 1 AS m, sum(net) AS usd FROM line GROUP BY ALL
), with_past AS (
    SELECT *, max(usd) OVER (PARTITION BY department ORDER BY m RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS past FROM by_month
), present AS (
    SELECT 12 * year({_LAST}) + month({_LAST}) - 1 AS now
)
SELECT department, make_date(m // 12, m % 12 + 1, 1) AS month, CAST(usd AS DECIMAL(18,2)) AS revenue_usd,
       CAST(past AS DECIMAL(18,2)) AS revenue_prev_year_usd, round(100.0 * (usd / past - 1), 1) AS growth_pct
FROM with_past, present WHERE m BETWEEN now - 12 AND now - 1"""

QUESTION["clv_buckets"] = """
WITH edges(low, bucket) AS (
    VALUES (CAST(-1e9 AS DECIMAL(18,2)), '1. under $100'), (100, '2. $100 to $250'), (250, '3. $250 to $500'), (500, '4. $500 to $1,000'),
           (1000, '5. $1,000 to $2,500'), (2500, '6. $2,500 to $5,000'), (5000, '7. $5,000 or more')
), worth AS (
    SELECT customer_id, CAST(sum(usd) AS DECIMAL(18,2)) AS usd FROM ord WHERE status <> 'cancelled' GROUP BY customer_id
), counted AS (
    SELECT bucket, count(*) AS customers, CAST(sum(usd) AS DECIMAL(18,2)) AS revenue_usd
    FROM worth ASOF JOIN edges ON worth.usd >= edges.low GROUP BY bucket
)
SELECT bucket, customers, round(100.0 * customers / (SELECT sum(customers) FROM counted), 2) AS share_pct, revenue_usd FROM counted"""

QUESTION["detail_extract"] = f"""
SELECT order_id, line_no, placed_at, customer_id, product_id, product_name, quantity, currency_code, unit_price AS unit_price_local, net AS net_usd
FROM line WHERE day = {_LAST}"""

QUESTION["customer_orders"] = """
SELECT order_id, placed_at, status, ifnull(line_count, 0) AS line_count, CAST(usd AS DECIMAL(18,2)) AS total_usd
FROM ord LEFT JOIN sized USING (order_id)
WHERE customer_id = (SELECT max_by(customer_id, id) FROM st_orders)
ORDER BY placed_at DESC, order_id DESC LIMIT 20"""


def over(source: str, statement: str) -> str:
    """A statement with the relations of one model before it."""
    statement = statement.strip()
    tail = f",\n{statement[5:]}" if statement.startswith("WITH ") else f"\n{statement}"
    return f"WITH {source}{tail}"


STORE = {name: over(STORE_SOURCE, sql) for name, sql in QUESTION.items()}
STAR = {name: over(STAR_SOURCE, sql) for name, sql in QUESTION.items()}

"""Oracle statements for the tree queries, over the steps that ``dw_climb`` takes (DuckDB dialect)."""

SQL = {}

SQL["h05_breadcrumbs"] = """
SELECT w.node AS category_id, CAST(row_number() OVER (PARTITION BY w.node ORDER BY w.steps DESC) - 1 AS INTEGER) AS position,
       c.id, c.name, replace(lower(c.name), ' ', '-') AS slug
FROM dw_climb w, st_categories c WHERE w.kind = 'category' AND c.id = w.spot"""

SQL["h06_products_per_root"] = """
SELECT c.name, replace(lower(c.name), ' ', '-') AS slug,
       (SELECT count(*) FROM dw_climb w, st_products p
        WHERE w.kind = 'category' AND w.spot = c.id AND p.category_id = w.node AND p.is_active) AS products
FROM st_categories c WHERE c.parent_id IS NULL"""

SQL["h07_leaf_paths"] = "SELECT category_id AS id, path_text AS path FROM dw_dim_category WHERE is_leaf"

SQL["h10_manager_chain"] = """
SELECT c.id AS customer_id, w.steps AS depth, b.name, b.title
FROM st_customers c, dw_climb w, dw_dim_employee b
WHERE w.kind = 'employee' AND w.node = c.account_manager_id AND b.employee_id = w.spot"""

SQL["h12_referred_by"] = """
SELECT w.node AS customer_id, w.steps AS depth, c.first_name || ' ' || c.last_name AS name
FROM dw_climb w, st_customers c WHERE w.kind = 'customer' AND w.steps >= 1 AND c.id = w.spot"""

SQL["h12_referrals_by_depth"] = """
SELECT spot AS customer_id, steps AS depth, count(*) AS count
FROM dw_climb WHERE kind = 'customer' AND steps >= 1 GROUP BY spot, steps"""

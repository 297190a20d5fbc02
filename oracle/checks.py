"""Oracle statements for the data-quality reports (DuckDB dialect)."""

# store keys, written out for the oracle: (table, key columns)
_KEYS = [
    ("currencies", "code"), ("countries", "code"), ("fx_rates", "currency_code,rate_date"), ("employees", "id"),
    ("warehouses", "id"), ("customers", "id"), ("addresses", "id"), ("categories", "id"), ("brands", "id"),
    ("suppliers", "id"), ("products", "id"), ("product_prices", "product_id,valid_from"),
    ("product_suppliers", "product_id,supplier_id"), ("inventory", "warehouse_id,product_id"),
    ("promotions", "id"), ("promotion_products", "promotion_id,product_id"), ("orders", "id"),
    ("order_items", "order_id,line_no"), ("payments", "id"), ("shipments", "id"), ("returns", "id"),
    ("reviews", "id"), ("warehouses", "code"), ("products", "sku"), ("promotions", "code"), ("reviews", "product_id,customer_id"),
]
_FKS = [
    ("countries", "currency_code", "currencies", "code"), ("fx_rates", "currency_code", "currencies", "code"),
    ("employees", "manager_id", "employees", "id"), ("warehouses", "country_code", "countries", "code"),
    ("warehouses", "manager_employee_id", "employees", "id"), ("customers", "country_code", "countries", "code"),
    ("customers", "referred_by_customer_id", "customers", "id"),
    ("customers", "account_manager_id", "employees", "id"), ("addresses", "customer_id", "customers", "id"),
    ("categories", "parent_id", "categories", "id"), ("products", "category_id", "categories", "id"),
    ("products", "brand_id", "brands", "id"), ("product_prices", "product_id", "products", "id"),
    ("product_suppliers", "product_id", "products", "id"), ("product_suppliers", "supplier_id", "suppliers", "id"),
    ("inventory", "warehouse_id", "warehouses", "id"), ("inventory", "product_id", "products", "id"),
    ("promotion_products", "promotion_id", "promotions", "id"),
    ("promotion_products", "product_id", "products", "id"), ("orders", "customer_id", "customers", "id"),
    ("orders", "shipping_address_id", "addresses", "id"), ("orders", "promotion_id", "promotions", "id"),
    ("orders", "currency_code", "currencies", "code"), ("order_items", "order_id", "orders", "id"),
    ("order_items", "product_id", "products", "id"), ("order_items", "warehouse_id", "warehouses", "id"),
    ("payments", "order_id", "orders", "id"), ("shipments", "order_id", "orders", "id"),
    ("shipments", "warehouse_id", "warehouses", "id"),
    ("returns", "order_id,line_no", "order_items", "order_id,line_no"),
    ("reviews", "product_id", "products", "id"), ("reviews", "customer_id", "customers", "id"),
]

SQL = {}

SQL["c06_key_checks"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_columns, "
    f"(SELECT count(*) FROM (SELECT {k} FROM st_{t} GROUP BY {k} HAVING count(*) > 1)) AS duplicate_keys"
    for t, k in _KEYS) + """
UNION ALL SELECT 'product_prices', 'product_id', (SELECT count(*) FROM (SELECT product_id FROM st_product_prices WHERE valid_to IS NULL
                                                                        GROUP BY product_id HAVING count(*) > 1))
UNION ALL SELECT 'customers', 'email', (SELECT count(*) - count(DISTINCT 'cust' || id || '@example.com') FROM st_customers)
UNION ALL SELECT 'categories', 'slug', (SELECT count(*) FROM (SELECT 1 FROM st_categories GROUP BY lower(replace(name, ' ', '-')) HAVING count(*) > 1))
UNION ALL SELECT 'carts', 'id', 0 UNION ALL SELECT 'carts', 'customer_id', 0  -- a cart has its customer's id
UNION ALL SELECT 'cart_items', 'cart_id,product_id', 0  -- made distinct"""


def _fk(child, ck, parent, pk):
    cks, pks = ck.split(","), pk.split(",")
    keys = ", ".join(f"{b} AS k{i}" for i, b in enumerate(pks))
    cond = " AND ".join(f"q.k{i} = c.{a}" for i, a in enumerate(cks))
    notnull = " AND ".join(f"c.{a} IS NOT NULL" for a in cks)
    return (f"SELECT '{child}' AS table_name, '{ck}' AS fk_columns, '{parent}' AS parent, count(*) AS orphans "
            f"FROM st_{child} c LEFT JOIN (SELECT DISTINCT {keys} FROM st_{parent}) q ON {cond} "
            f"WHERE {notnull} AND q.k0 IS NULL")


SQL["c07_foreign_key_checks"] = "\nUNION ALL\n".join(_fk(*f) for f in _FKS) + """
UNION ALL SELECT 'employees', 'warehouse_id', 'warehouses', 0  -- no employee has one
UNION ALL SELECT 'addresses', 'country_code', 'countries', (SELECT count(*) FROM st_addresses WHERE country_code NOT IN (SELECT code FROM st_countries))
UNION ALL SELECT 'suppliers', 'country_code', 'countries', (SELECT count(*) FROM st_suppliers WHERE country_code NOT IN (SELECT code FROM st_countries))
UNION ALL SELECT 'carts', 'customer_id', 'customers', 0 UNION ALL SELECT 'cart_items', 'cart_id', 'carts', 0
UNION ALL SELECT 'cart_items', 'product_id', 'products',
                 (SELECT count(*) FROM (SELECT unnest([1 + (7 * id) % (SELECT count(*) FROM part), 1 + (13 * id + 1) % (SELECT count(*) FROM part)]) AS p
                                        FROM st_customers WHERE id % 10 = 0) WHERE p NOT IN (SELECT id FROM st_products))"""

SQL["c08_row_rules"] = """
SELECT 'orders.total_identity' AS rule_name, count(*) FILTER (WHERE total <> subtotal - discount + shipping_fee + tax) AS violations FROM st_orders
UNION ALL SELECT 'orders.non_negative', count(*) FILTER (WHERE NOT (total >= 0 AND tax >= 0 AND discount >= 0)) FROM st_orders
UNION ALL SELECT 'orders.status_known', count(*) FILTER (WHERE status NOT IN ('pending', 'paid', 'shipped', 'delivered', 'cancelled')) FROM st_orders
UNION ALL SELECT 'order_items.quantity_positive', count(*) FILTER (WHERE quantity <= 0) FROM st_order_items
UNION ALL SELECT 'order_items.price_non_negative', count(*) FILTER (WHERE unit_price < 0) FROM st_order_items
UNION ALL SELECT 'order_items.discount_within_line', count(*) FILTER (WHERE discount > unit_price * quantity) FROM st_order_items
UNION ALL SELECT 'shipments.delivered_after_shipped', count(*) FILTER (WHERE delivered_at < shipped_at) FROM st_shipments
UNION ALL SELECT 'shipments.delivered_needs_shipped', count(*) FILTER (WHERE delivered_at IS NOT NULL AND shipped_at IS NULL) FROM st_shipments
UNION ALL SELECT 'reviews.rating_range', count(*) FILTER (WHERE rating NOT BETWEEN 1 AND 5) FROM st_reviews
UNION ALL SELECT 'product_prices.range_ordered', count(*) FILTER (WHERE valid_to <= valid_from) FROM st_product_prices
UNION ALL SELECT 'product_prices.price_positive', count(*) FILTER (WHERE price_usd <= 0) FROM st_product_prices
UNION ALL SELECT 'countries.tax_rate_range', count_if(tax_rate < 0 OR tax_rate >= 1) FROM st_countries
UNION ALL SELECT 'fx_rates.positive', count_if(units_per_usd <= 0) FROM st_fx_rates
UNION ALL SELECT 'employees.department_known', count_if(department NOT IN ('Executive', 'Sales', 'Operations', 'Purchasing', 'Support', 'Finance')) FROM st_employees
UNION ALL SELECT 'customers.segment_known', count_if(segment NOT IN ('consumer', 'business', 'vip')) FROM st_customers
UNION ALL SELECT 'addresses.kind_known', count_if(kind NOT IN ('shipping', 'billing')) FROM st_addresses
UNION ALL SELECT 'suppliers.rating_range', count_if(rating < 1 OR rating > 5) FROM st_suppliers
UNION ALL SELECT 'products.price_positive', count_if(price_usd <= 0) FROM st_products
UNION ALL SELECT 'products.cost_positive', count_if(cost_usd <= 0) FROM st_products
UNION ALL SELECT 'inventory.not_negative', count_if(quantity_on_hand < 0) FROM st_inventory
UNION ALL SELECT 'promotions.discount_range', count_if(discount_pct <= 0 OR discount_pct >= 100) FROM st_promotions
UNION ALL SELECT 'promotions.range_ordered', count_if(ends_at <= starts_at) FROM st_promotions
UNION ALL SELECT 'cart_items.quantity_positive', count_if(1 + id % 3 <= 0) FROM st_customers
UNION ALL SELECT 'payments.method_known', count_if(method NOT IN ('card', 'paypal', 'bank_transfer', 'gift_card', 'pix')) FROM st_payments
UNION ALL SELECT 'payments.status_known', count_if(status NOT IN ('authorized', 'captured', 'refunded', 'failed')) FROM st_payments
UNION ALL SELECT 'returns.quantity_positive', count_if(quantity <= 0) FROM st_returns
UNION ALL SELECT 'returns.reason_known', count_if(reason NOT IN ('damaged', 'wrong_item', 'wrong_size', 'not_as_described', 'changed_mind', 'late_delivery')) FROM st_returns"""

SQL["c09_fact_completeness"] = """
WITH q_e AS (SELECT count(*) AS expected FROM st_order_items oi JOIN st_orders o ON o.id = oi.order_id
             WHERE o.status <> 'cancelled'),
q_a AS (SELECT count(*) AS actual FROM dw_fact_sales)
SELECT expected, actual, expected = actual AS complete FROM q_e, q_a"""

SQL["c10_fixture_sanity"] = """
SELECT 'customers.referrer_earlier' AS rule_name, count(*) FILTER (WHERE referred_by_customer_id >= id) AS violations FROM st_customers
UNION ALL SELECT 'employees.manager_id_smaller', count(*) FILTER (WHERE manager_id >= id) FROM st_employees
UNION ALL SELECT 'product_prices.versions_ordered', count(*) FILTER (WHERE valid_from >= valid_to) FROM st_product_prices"""

SQL["c11_product_rules"] = """
SELECT 'sku_length' AS rule_name, count(*) FILTER (WHERE NOT length(sku) BETWEEN 3 AND 32) AS violations FROM st_products
UNION ALL SELECT 'price_range', count(*) FILTER (WHERE NOT price_usd BETWEEN 0.01 AND 100000) FROM st_products
UNION ALL SELECT 'cost_not_above_price', count(*) FILTER (WHERE cost_usd > price_usd) FROM st_products
UNION ALL SELECT 'attributes_is_object', count(*) FILTER (WHERE json_type(attributes) <> 'OBJECT') FROM st_products
UNION ALL SELECT 'name_present', count(*) FILTER (WHERE length(trim(name)) = 0) FROM st_products"""

SQL["c02_sale_versions"] = """
WITH q_got AS (
    SELECT fs.order_id, fs.line_no, fs.product_id, dp.valid_from
    FROM dw_fact_sales fs JOIN dw_dim_product dp USING (product_key)
), q_want AS (
    SELECT fs.order_id, fs.line_no, fs.product_id, pp.valid_from
    FROM dw_fact_sales fs JOIN st_product_prices pp ON pp.product_id = fs.product_id AND fs.placed_at >= pp.valid_from
     AND (fs.placed_at < pp.valid_to OR pp.valid_to IS NULL)
)
SELECT count(*) AS mismatched_sales FROM ((SELECT * FROM q_got EXCEPT ALL SELECT * FROM q_want)
                                         UNION ALL (SELECT * FROM q_want EXCEPT ALL SELECT * FROM q_got))"""

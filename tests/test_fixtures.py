"""Every derived store table equals the independent DuckDB fixture block, row by row."""

import pytest

import oracle
from oracle_util import compare

TABLES = ("currencies countries fx_rates employees customers categories brands products product_prices "
          "warehouses inventory promotions promotion_products orders order_items shipments payments returns "
          "reviews").split()


@pytest.mark.parametrize("table", TABLES)
def test_store_table_matches_oracle(wh, con, table):
    sql = "WITH RECURSIVE " + oracle.block("store") + f"\nSELECT * FROM st_{table}"
    names = [d[0] for d in con.execute(sql + " LIMIT 0").description]
    df = wh.store.table(table)
    cols = sorted(c for c in names if c in df.columns)
    assert len(cols) == len(names), set(names) - set(df.columns)
    assert compare(df, con, sql, cols) is None


STAR = [("fx_rates_daily", "st_fx_rates_daily"), ("dim_category", "dw_dim_category"), ("dim_product", "dw_dim_product"),
        ("dim_employee", "dw_dim_employee"), ("dim_customer", "dw_dim_customer"), ("fact_orders", "dw_fact_orders"),
        ("fact_sales", "dw_fact_sales"), ("fact_returns", "dw_fact_returns"), ("fact_reviews", "dw_fact_reviews")]


@pytest.mark.parametrize("table,cte", STAR)
def test_star_table_matches_oracle(wh, con, table, cte):
    sql = oracle.with_fixtures(f"SELECT * FROM {cte}")
    names = [d[0] for d in con.execute(sql + " LIMIT 0").description]
    df = getattr(wh, table)
    cols = sorted(c for c in names if c in df.columns)
    assert compare(df, con, sql, cols) is None


def test_sanity_counts(wh):
    o = wh.raw("orders")
    # every order finds a rate, every line exactly one price version
    assert wh.fact_orders.where("fx_rate IS NULL").count() == 0
    live_lines = wh.raw("order_items").join(o.where("status <> 'cancelled'").selectExpr("id AS order_id"), "order_id")
    assert wh.fact_sales.count() == live_lines.count()

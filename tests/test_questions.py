"""The questions: oracle equality (the driver gate) and store == star for all fifteen."""

import pytest

import __spark_entry__ as E
from fathom.plans import questions as Q
from oracle_util import compare, rows_of_spark

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    assert compare(df, con, E.oracle_sql()[name]) is None


def test_every_query_has_stable_schema(spark):
    for name, fn in E.queries().items():
        df = fn(spark, SF)
        assert len(df.columns) == len(set(df.columns)), name


@pytest.mark.parametrize("name", list(Q.QUESTIONS))
def test_store_equals_star(wh, name):
    store_fn, star_fn = Q.QUESTIONS[name]
    a, _ = rows_of_spark(store_fn(wh))
    b, _ = rows_of_spark(star_fn(wh))
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "orders", "revenue_usd"]
    assert df.count() > 0

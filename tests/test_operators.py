"""Unit tests of the custom operators against brute force on small fixtures."""

from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.functions.money import to_usd
from fathom.functions.numeric import dround
from fathom.functions.text import charm_cents, slug, trigram_similarity
from fathom.operators.asof import asof_join
from fathom.operators.hierarchy import closure, flatten_tree
from fathom.operators.keys import dense_key, ntile_global
from fathom.operators.stats import exact_percentiles, group_rank


def test_asof_matches_merge_asof(spark, wh):
    o = wh.raw("orders").select("id", "currency_code", F.col("placed_at").cast("date").alias("d"))
    fx = wh.raw("fx_rates")
    for bucket in (None, lambda t: F.trunc(t, "month")):
        got = asof_join(o, fx, ["currency_code"], "d", "rate_date", bucket=bucket).toPandas()
        lp = o.toPandas().sort_values("d")
        rp = fx.toPandas().sort_values("rate_date")
        lp["d"], rp["rate_date"] = pd.to_datetime(lp["d"]), pd.to_datetime(rp["rate_date"])
        want = pd.merge_asof(lp, rp, left_on="d", right_on="rate_date", by="currency_code", direction="backward")
        g = got.sort_values("id").reset_index(drop=True)
        w = want.sort_values("id").reset_index(drop=True)
        assert list(g["units_per_usd"].astype(str)) == list(w["units_per_usd"].astype(str))


def test_asof_strict_and_forward(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 10), (3, "b", 1)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 5, "x"), ("a", 9, "y"), ("a", 12, "z")], "k string, rt int, v string")
    back_strict = {r.id: r.v for r in asof_join(left, right, ["k"], "t", "rt", allow_exact=False).collect()}
    assert back_strict == {1: None, 2: "y", 3: None}
    fwd = {r.id: r.v for r in asof_join(left, right, ["k"], "t", "rt", direction="forward").collect()}
    assert fwd == {1: "x", 2: "z", 3: None}
    inner = asof_join(left, right, ["k"], "t", "rt", how="inner").collect()
    assert sorted(r.id for r in inner) == [1, 2]


def test_dense_key_equals_row_number(spark, wh):
    pp = wh.raw("product_prices")
    got = dense_key(pp, ["product_id", "valid_from"], "k", num_partitions=5)
    want = pp.withColumn("k", F.row_number().over(Window.orderBy("product_id", "valid_from")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_ntile_equals_window(spark):
    df = spark.range(0, 103).withColumn("v", (F.col("id") * 7919) % 101)
    got = ntile_global(df, [F.col("v").desc(), F.col("id")], 5, "t")
    want = df.withColumn("t", F.ntile(5).over(Window.orderBy(F.col("v").desc(), F.col("id"))))
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_group_rank_with_hot_group(spark):
    # one group holds most rows: it is spread over many range partitions and still ranked exactly
    df = spark.range(0, 5000).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string")).alias("g"), ((F.col("id") * 31) % 977).alias("v"), "id")
    got = group_rank(df, ["g"], ["v", "id"], "r", "n", num_partitions=16)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("v", "id"))) \
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_exact_percentiles_vs_duckdb(spark):
    df = spark.range(0, 2001).select((F.col("id") % 3).cast("string").alias("g"),
                                     ((F.col("id") * 7919) % 1000 / 7.0).alias("v"))
    got = {r.g: (r.p50, r.p90) for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}).collect()}
    pdf = df.toPandas()
    con = duckdb.connect()
    con.register("t", pdf)
    want = {g: (a, b) for g, a, b in con.execute(
        "SELECT g, quantile_cont(v, 0.5), quantile_cont(v, 0.9) FROM t GROUP BY g").fetchall()}
    for g in want:
        assert got[g][0] == pytest.approx(want[g][0], abs=1e-9)
        assert got[g][1] == pytest.approx(want[g][1], abs=1e-9)


def test_closure_matches_recursive_cte(spark, wh):
    c = wh.raw("customers")
    got = {(r.id, r.depth, r.root_id) for r in closure(c, "id", "referred_by_customer_id").collect()}
    pdf = c.select("id", "referred_by_customer_id").toPandas()
    con = duckdb.connect()
    con.register("c", pdf)
    want = set(con.execute("""
        WITH RECURSIVE r AS (
            SELECT id, 0 AS depth, id AS root FROM c WHERE referred_by_customer_id IS NULL
            UNION ALL SELECT c.id, r.depth + 1, r.root FROM c JOIN r ON c.referred_by_customer_id = r.id)
        SELECT id, depth, root FROM r""").fetchall())
    assert got == want


def test_closure_drops_cycles_and_dangling(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 5), (5, 4), (6, 99)], "id int, parent int")
    got = {(r.id, r.depth, r.root_id) for r in closure(df, "id", "parent").collect()}
    assert got == {(1, 0, 1), (2, 1, 1), (3, 2, 1)}


def test_flatten_tree_deep_chain(spark):
    # 40 levels: more than the first guess, so the walk runs several rounds
    rows = [(1, None, "n1")] + [(i, i - 1, f"n{i}") for i in range(2, 41)] + [(100, 999, "orphan")]
    df = spark.createDataFrame(rows, "id int, parent int, name string")
    t = {r.id: r for r in flatten_tree(df, "id", "parent", "name", levels=2).collect()}
    assert 100 not in t and len(t) == 40
    assert t[40].depth == 40 and t[40].path_ids == list(range(1, 41)) and t[40].level2 == "n2"
    assert t[40].is_leaf and not t[1].is_leaf


def test_to_usd_exact_half_up(spark):
    vals = [("1.00", "3.00000000"), ("100.05", "0.92000000"), ("0.05", "10.00000000"), ("12345678.91", "148.12345678"),
            ("2.50", "2.00000000"), ("-2.50", "2.00000000")]
    df = spark.createDataFrame([(Decimal(a), Decimal(r)) for a, r in vals], "a decimal(14,2), r decimal(18,8)")
    got = [row.u for row in df.select(to_usd("a", "r").alias("u")).collect()]
    want = []
    for a, r in vals:
        q = (abs(Decimal(a)) / Decimal(r)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        want.append(q if Decimal(a) >= 0 else -q)
    assert got == want


def test_dround_matches_duckdb(spark):
    xs = [1.025, 2.675, 0.285, 1.005, -1.025, 12.345, 0.125]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.y for r in df.select(dround("x", 2).alias("y")).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT round({x}::DOUBLE, 2)").fetchone()[0] for x in xs]
    assert got == want


def test_text_helpers(spark):
    df = spark.createDataFrame([("Home & Kitchen", 23.4), ("Müller", 3.456), ("  a--b  ", 4.999)], "s string, p double")
    r = df.select(slug("s").alias("slug"), charm_cents("p").alias("c"),
                  trigram_similarity(F.lit("word"), F.lit("two words")).alias("sim")).collect()
    assert [x.slug for x in r] == ["home-and-kitchen", "muller", "a-b"]
    assert [x.c for x in r] == [2299, 346, 500]
    assert r[0].sim == pytest.approx(4 / 11)

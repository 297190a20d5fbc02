"""Plans that grow with the input: broadcasts by measured size, one pass where several did the same work; results against plain Python."""

from __future__ import annotations

import collections
import datetime as dt
import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from fathom.operators.pairs import frequent, pairs, top_partners
from fathom.plans import checks, coverage, incremental, views
from fathom.plans.publish import _range_of, day_cuts, id_cuts, laid_out, with_load_conf
from fathom.plans.questions import rollup_orders
from fathom.plans.versions import Load, next_version
from fathom.plans.warehouse import Warehouse
from fathom.session import LOAD_CONF, SHUFFLES_GO, apply_conf, settings
from fathom.sources.fixtures import STORE_TABLES, Store, StoreWrittenOnce

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Tables:
    """A warehouse of given tables."""

    def __init__(self, **tables):
        self.__dict__.update(tables)

    def raw(self, name):
        return getattr(self, name)


@pytest.fixture
def named(spark):
    random.seed(3)
    left, right = ["red", "redder", "hot", "a", "blue"], ["ring", "bolt", "red", "hotel"]
    rows = [(i, f"{random.choice(left)} {random.choice(right)}", i % 7 != 0) for i in range(3000)] + [(3001, None, True)]
    return rows, spark.createDataFrame(rows, "id long, name string, is_active boolean")


def test_search_ranks_the_first_products_of_each_name(spark, named):
    rows, products = named
    got = collections.defaultdict(list)
    for r in views.v10_search(Tables(products=products), top=5).collect():
        got[r.term].append((-r.similarity, r.product_id, r.name))
    live = [(i, n) for i, n, on in rows if on and n]
    grams = lambda s: {f"  {w} "[k:k + 3] for w in s.split() for k in range(len(w) + 1)}
    for term in {w for _, n in live for w in n.split()}:
        like = sorted((-round(len(grams(n) & grams(term)) / len(grams(n) | grams(term)), 6), i, n) for i, n in live if term in n)
        assert sorted(got[term]) == like[:5]


def test_search_broadcasts_neither_postings_nor_products(spark, named):
    apply_conf(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10g")  # what Spark estimates of an exploded table is always below
    try:
        plan = physical(views.v10_search(Tables(products=named[1])))
    finally:
        apply_conf(spark)
    assert "BroadcastExchange" not in plan


def test_a_table_is_not_broadcast_by_the_size_of_its_files(spark, tmp_path):
    apply_conf(spark)
    path = str(tmp_path / "same")
    spark.range(200000).select(F.col("id").alias("k"), F.lit("x" * 200).alias("text")).write.parquet(path)
    big = spark.read.parquet(path)
    joined = spark.range(100).withColumnRenamed("id", "k").join(big, "k", "left")
    assert "BroadcastHashJoin" not in physical(joined)
    assert joined.agg(F.count("text")).first()[0] == 100
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 200


def test_sales_need_no_payments_parcels_or_returns(spark):
    wh = Warehouse(Store(apply_conf(spark), SF))
    plan = optimized(wh.fact_sales)
    assert "max_by" not in plan and "count_if" not in plan and "carrier" not in plan
    facts = wh.fact_orders.select("order_id", "date_key", "order_date", "placed_at", "customer_id", "promotion_id", "status", "currency_code", "fx_rate")
    heads = wh.order_heads.select(*facts.columns)
    assert facts.exceptAll(heads).isEmpty() and heads.exceptAll(facts).isEmpty()


def test_rollup_counts_orders_without_expanding_rows(spark):
    random.seed(5)
    rows = [(random.choice(["a", "b", None]), random.choice(["x", "y", None]), random.randrange(40), random.randrange(100)) for _ in range(600)]
    rows.append(("a", "x", None, 7))
    x = spark.createDataFrame(rows, "level1 string, level2 string, order_id long, v long").where("order_id IS NOT NULL")
    got = rollup_orders(x, "v")
    want = x.rollup("level1", "level2").agg(F.count_distinct("order_id").alias("orders"), F.sum("v").alias("value"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "distinct" not in optimized(got)
    assert rollup_orders(x.limit(0), "v").count() == 0


@pytest.mark.parametrize("ordered", [True, False])
def test_pairs_of_ordinary_and_bulk_baskets(spark, ordered):
    random.seed(9)
    per = {(b, random.randrange(60)): random.randrange(1, 4) for b in list(range(30)) * 6 + [99] * 80}
    rows = [(b, i, n) for (b, i), n in per.items()]
    df = spark.createDataFrame(rows + [(None, 1, 1), (None, 2, 1), (3, None, 1)], "basket long, item long, n int")
    got = sorted(tuple(r) for r in pairs(df, "basket", "item", "n", ordered=ordered, bulk=10).collect())
    want = sorted((b, i, j, n, m) for b, i, n in rows for c, j, m in rows if b == c and (i < j if ordered else i != j))
    assert got == want


def test_ordinary_baskets_are_not_joined(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 1)], "basket long, item long, n int")
    out = pairs(df, "basket", "item", "n", ordered=True)
    assert out.count() == 1 and optimized(out).count("Join ") == 1  # that of bulk baskets


def test_sale_versions_counts_both_directions(spark):
    prices = spark.sql("SELECT 1L AS product_id, timestamp_ntz'2000-01-01' AS valid_from, timestamp_ntz'2001-01-01' AS valid_to "
                       "UNION ALL SELECT 1L, timestamp_ntz'2001-01-01', NULL")
    dim = spark.sql("SELECT 7L AS product_key, 1L AS product_id, timestamp_ntz'2000-01-01' AS valid_from UNION ALL SELECT 8L, 1L, timestamp_ntz'2001-01-01'")
    sale = "SELECT {o}L AS order_id, {n} AS line_no, {k}L AS product_key, 1L AS product_id, timestamp_ntz'{at}' AS placed_at"
    sales = [sale.format(o=1, n=1, k=7, at="2000-05-05"), sale.format(o=2, n=1, k=7, at="2001-05-05"), sale.format(o=3, n=1, k=8, at="2001-05-05")]
    wh = Tables(dim_product=dim, fact_sales=spark.sql(" UNION ALL ".join(sales)), product_prices=prices)
    out = checks.c02_sale_versions(wh)
    assert out.first()[0] == 2 and "Except" not in optimized(out)


def test_first_load_runs_no_second_one(spark, monkeypatch):
    wh, ran = Warehouse(Store(spark, SF), max_order_id=100), []
    monkeypatch.setattr(incremental, "build_full", lambda *a, **k: ran.append("full"))
    monkeypatch.setattr(incremental, "build_incremental", lambda *a, **k: ran.append("incremental"))
    incremental.first_load(wh)
    incremental.first_load(wh)
    assert ran == ["full"]


def test_bloom_filters_are_sized_by_the_ids_of_a_part(spark, tmp_path):
    root = str(tmp_path)
    load = Load(spark, root, next_version(root))
    rows = spark.range(100).select(F.col("id").alias("order_id"), F.lit(0).alias("block")).coalesce(1)
    load.write(rows, "raw", "payments", ("block",), bloom=["order_id"], ids=1000)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{root}/raw/payments/*/*/*.parquet")]
    assert sizes and max(sizes) < 100_000


def test_sales_are_written_once_for_all_star_tables(spark):
    once = coverage._sales_written(Warehouse(Store(apply_conf(spark), SF)))
    assert "product_prices" not in physical(once.product_pairs) and "fact-sales" in str(once.fact_sales.inputFiles())


@pytest.mark.parametrize("bulk, bulky", [(20, True), (200, True), (200, False)])
@pytest.mark.parametrize("dealt", [False, True])
def test_partners_count_every_two_lines(spark, bulk, bulky, dealt):
    random.seed(1)
    lines = [(o, random.choice([1, 2, 3]) if random.random() < .5 else random.randrange(60)) for o in range(400) for _ in range(random.randrange(1, 7))]
    lines += [(999, random.randrange(60)) for _ in range(120)]
    want, baskets = collections.defaultdict(collections.Counter), collections.defaultdict(list)
    for o, p in lines:
        baskets[o].append(p)
    for here in baskets.values():
        for a in here:
            want[a].update(b for b in here if b != a)
    rows = spark.createDataFrame(lines + [(None, 3), (5, None)], "o long, p long")
    hot = frequent(rows, "p", 10)
    assert set(hot) == {1, 2, 3} and all(n > 1 for n in hot.values())
    got = top_partners(rows, "o", "p", 4, hot if dealt else None, bulky, bulk)
    assert sorted(tuple(r) for r in got.collect()) == sorted((a, b, n) for a, c in want.items() for b, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:4])


def test_no_item_is_frequent_among_none(spark):
    rows = spark.createDataFrame([(1, None), (2, None)], "o long, p long")
    assert frequent(rows, "p") == {} and frequent(rows.limit(0), "p") == {}


def test_partners_shuffle_no_single_pair(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("o"), (F.col("id") % 37).alias("p"))
    plan = physical(top_partners(rows, "o", "p", 8, bulky=False))
    assert plan.count("Exchange hashpartitioning") == 2, plan


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        found.add(files.next().getName())
    return {f for f in found if f.startswith("shuffle_")}


def test_a_load_lets_its_shuffle_files_go(spark, tmp_path):
    ran = []

    @with_load_conf
    def load(spark, name):
        ran.append({k: spark.conf.get(k) for k in LOAD_CONF})
        before = shuffle_files(spark)
        spark.range(10000).groupBy((F.col("id") % 100).alias("k")).count().write.parquet(str(tmp_path / name))
        until = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        return left

    before = {k: spark.conf.get(k, None) for k in LOAD_CONF}
    assert load(spark, "out") == set() and ran == [LOAD_CONF]
    assert {k: spark.conf.get(k, None) for k in LOAD_CONF} == before
    with pytest.raises(ValueError), settings(spark, SHUFFLES_GO):
        raise ValueError
    assert {k: spark.conf.get(k, None) for k in LOAD_CONF} == before
    assert hasattr(incremental.build_incremental, "__wrapped__") and hasattr(incremental.build_full, "__wrapped__")


def test_a_store_written_once_has_the_same_rows(spark):
    apply_conf(spark)
    plain, once = Store(spark, SF), StoreWrittenOnce(spark, SF)
    for name in STORE_TABLES:
        a, b = plain.table(name), once.table(name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    assert set(once._kept) == {"orders", "_lines", "returns", "reviews"}
    for name in ("orders", "order_items", "payments", "shipments", "returns", "reviews"):
        assert all("/store-" in f for f in once.table(name).inputFiles()), name
        assert "Join" not in optimized(once.table(name)) and "Window" not in optimized(once.table(name)), name


def test_ranges_are_known_beforehand(spark):
    days = [(dt.date(2000, 1, 1) + dt.timedelta(days=i), 5 if i % 7 else 50) for i in range(100)]
    cuts = day_cuts(days, 8)
    assert cuts == sorted(set(cuts)) and len(cuts) == 7 and day_cuts([], 8) == [] and day_cuts(days, 1) == []
    per = collections.Counter()
    for day, n in days:
        per[sum(c <= day for c in cuts)] += n
    assert max(per.values()) <= sum(n for _, n in days) / 8 + 50
    assert day_cuts([(dt.date(2000, 1, 1), 9)], 8) == []
    rows = spark.createDataFrame([(d, i) for i, (d, _) in enumerate(days)] + [(None, -1)], "order_date date, order_id long")
    got = {r.order_id: r.at for r in rows.select("order_id", _range_of(F.col("order_date"), cuts).alias("at")).collect()}
    assert all(got[i] == sum(c <= d for c in cuts) for i, (d, _) in enumerate(days)) and -1 in got
    ids = id_cuts(spark.range(1, 1001), 8)
    assert len(ids) == 7 and all(abs(a - 125 * (i + 1)) <= 5 for i, a in enumerate(ids)) and id_cuts(spark.range(0), 8) == []


def test_facts_are_dealt_without_making_their_rows_twice(spark):
    wh = Warehouse(Store(apply_conf(spark), SF))
    facts, cuts = wh.fact_orders, {"order_date": [dt.date(1996, 5, 5), dt.date(1998, 1, 1)]}
    out = laid_out(facts, "fact_orders", 4, {}, cuts)
    assert "rangepartitioning" not in physical(out) and "rangepartitioning" in physical(laid_out(facts, "fact_orders", 4, {}))
    back = out.drop("year", "month")
    assert back.exceptAll(facts).isEmpty() and facts.exceptAll(back).isEmpty()
    spans = out.groupBy(F.spark_partition_id().alias("p")).agg(F.min("order_date").alias("a"), F.max("order_date").alias("b")).collect()
    assert len(spans) == 3 and all(x.b < y.a for x, y in zip(sorted(spans, key=lambda r: r.a), sorted(spans, key=lambda r: r.a)[1:]))


def test_orders_are_numbered_before_they_are_wide(spark):
    wh = Warehouse(Store(apply_conf(spark), SF))
    plan = optimized(wh.fact_orders)
    assert plan.index("Join LeftOuter") < plan.index("row_number")  # the joins of lines, payments, parcels and returns stand above
    got = collections.defaultdict(list)
    for r in wh.fact_orders.select("customer_id", "placed_at", "order_id", "customer_order_number").collect():
        got[r.customer_id].append((r.placed_at, r.order_id, r.customer_order_number))
    assert all([n for _, _, n in sorted(rows)] == list(range(1, len(rows) + 1)) for rows in got.values())


def test_loads_and_checks_read_the_store_written_once(spark, monkeypatch):
    wh, read = Warehouse(Store(spark, SF), max_order_id=100), []
    monkeypatch.setattr(incremental, "build_full", lambda spark, store, *a, **k: read.append(store))
    monkeypatch.setattr(incremental, "build_incremental", lambda spark, store, *a, **k: read.append(store))
    monkeypatch.setattr(incremental.PublishedWarehouse, "open", lambda *a: None)
    incremental._loaded_in_two(wh)
    once = incremental.over_written_store(wh)
    assert [type(x) for x in read] == [StoreWrittenOnce] * 2 and read == [once.store] * 2 and once.max_order_id == 100
    other = Warehouse(type("Other", (Store,), {})(spark, SF))
    assert incremental.over_written_store(other) is other

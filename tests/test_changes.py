"""Events folded into versions, pairs of bulk baskets, comparing by digests, ranks by counting: against plain Python."""

import collections
import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from fathom.operators import digests, pairs as P, scd2, stats
from fathom.plans.changes import ChangedSource, day_of_changes, next_day
from fathom.plans.warehouse import Warehouse
from fathom.session import written
from fathom.sources.fixtures import Store

VERSIONS = "product_id long, valid_from timestamp_ntz, valid_to timestamp_ntz, price decimal(12,2)"
EVENTS = "event_id long, product_id long, at timestamp_ntz, price decimal(12,2)"
DAY = dt.datetime(2000, 1, 1)


def plain_fold(versions, events):
    out = []
    for p in {r[0] for r in versions} | {e[1] for e in events}:
        told = {}
        for _, start, end, price in (r for r in versions if r[0] == p):
            if end is not None:
                told.setdefault(end, (-1, None, False))
        for _, start, end, price in (r for r in versions if r[0] == p):
            told[start] = (0, price, True)
        for event_id, _, at, price in sorted(e for e in events if e[1] == p):
            told[at] = (event_id + 1, price, told.get(at, (0, None, False))[2])
        kept, before = [], None
        for at in sorted(told):
            _, price, known = told[at]
            if known or price != before:
                kept.append((at, price))
            before = price
        out += [(p, at, nxt, price) for (at, price), nxt in zip(kept, [a for a, _ in kept[1:]] + [None]) if price is not None]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_events(spark, seed):
    rng = random.Random(seed)
    versions, events = [], []
    for p in range(40):
        starts = sorted({DAY + dt.timedelta(days=rng.randrange(200)) for _ in range(rng.randint(0, 4))})
        ends = [*starts[1:], None]
        if starts and rng.random() < 0.3:
            ends[-1] = starts[-1] + dt.timedelta(days=30)
        versions += [(p, a, b, float(rng.randint(1, 4))) for a, b in zip(starts, ends)]
    for k in range(300):
        p = 7 if rng.random() < 0.5 else rng.randrange(45)  # one product has half of all events
        events.append((k, p, DAY + dt.timedelta(days=rng.randrange(260)), None if rng.random() < 0.1 else float(rng.randint(1, 4))))
    from decimal import Decimal
    cast = lambda rows, at: [(*r[:at], None if r[at] is None else Decimal(r[at]), *r[at + 1:]) for r in rows]
    versions, events = cast(versions, 3), cast(events, 3)
    v, e = spark.createDataFrame(versions, VERSIONS), spark.createDataFrame(events, EVENTS)
    folded = scd2.fold_events(v, e, "product_id", "price")
    got = sorted((tuple(r) for r in folded.collect()), key=str)
    assert got == plain_fold(versions, events)
    assert {(p, a) for p, a, _, _ in versions} <= {(p, a) for p, a, _, _ in got} | {(e[1], e[2]) for e in events if e[3] is None}
    # the same events again, in another order and in two batches, change nothing
    again = scd2.fold_events(spark.createDataFrame(got, VERSIONS), e.orderBy(F.desc("event_id")), "product_id", "price")
    assert sorted((tuple(r) for r in again.collect()), key=str) == got
    assert scd2.fold_events(v, e.limit(0), "product_id", "price").count() == len(plain_fold(versions, []))


def test_changes_replayed_change_nothing(spark, wh):
    at = next_day(wh)
    once = ChangedSource(wh.store, day_of_changes(wh.store, wh.max_order_id, at))
    events = once.events
    assert events.count() == events.select("event_id").distinct().count()
    names = ("orders", "returns", "product_prices", "products")
    kept = {n: written(once.table(n), n) for n in names}

    class Kept(Store):
        def table(self, name):
            return kept[name] if name in kept else wh.raw(name)

    twice = ChangedSource(Kept(spark, wh.store.sf_dir), once.events)
    assert {n: digests.differing_ranges({n: (kept[n], twice.table(n))}, ())[n]["differ"] for n in names} == {n: [] for n in names}
    assert once.returns.count() > wh.raw("returns").count()
    kinds = {r.kind for r in events.select("kind").distinct().collect()}
    assert kinds == {"ship", "deliver", "cancel", "return", "reprice", "rename"}


def test_changed_attributes_through_a_warehouse(spark, wh):
    """Renamed and repriced products show in the dimension of the changed source."""
    src = Warehouse(ChangedSource(wh.store, day_of_changes(wh.store, wh.max_order_id, next_day(wh))))
    now = {r.product_id: r for r in src.dim_product.where("is_current").collect()}
    before = {r.product_id: r for r in wh.dim_product.where("is_current").collect()}
    assert now[97].product_name == before[97].product_name + " (renamed)"
    assert now[14].list_price_usd > before[14].list_price_usd
    assert 35 not in now  # taken off the list


def test_pairs_of_a_bulk_basket_are_spread(spark):
    baskets = {k: random.Random(k).sample(range(400), 1 + k % 12) for k in range(60)}
    baskets[999] = list(range(3000))
    rows = [(b, i, 1 + (b + i) % 2) for b, items in baskets.items() for i in items]
    per = spark.createDataFrame(rows, "basket long, item long, n long")
    got = P.pairs(per, "basket", "item", "n", ordered=True, bulk=100).groupBy("item", "other").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("other_weight")).alias("w")).where("item < 400 AND other < 400")
    want = collections.Counter()
    weight = collections.Counter()
    n = {(b, i): w for b, i, w in rows}
    for b, items in baskets.items():
        for x, y in itertools.combinations(sorted(i for i in items if i < 400), 2):
            want[x, y] += 1
            weight[x, y] += n[b, x] * n[b, y]
    assert {(r.item, r.other): (r.k, r.w) for r in got.collect()} == {p: (want[p], weight[p]) for p in want}
    both = P.pairs(per.where("basket = 999"), "basket", "item", "n", bulk=100)
    assert both.count() == 3000 * 2999
    dealt = P._dealt(per, "basket", "item", 100).where("basket = 999").groupBy("_block").count().collect()
    assert len(dealt) == 30 and max(r["count"] for r in dealt) < 200


def test_digests_tell_what_differs(spark):
    a = spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.array("id").alias("l"))
    twice = a.union(a.where("id < 3"))
    b = twice.where("id <> 17").union(spark.createDataFrame([(17, 99, [17]), (1, 1, [1])], a.schema)).repartition(5)
    got = digests.compare_by_digest({"same": (a, a.repartition(3)), "other": (twice, b), "empty": (a.limit(0), a.limit(0))}, ignore=()).collect()
    by = {r["table"]: r for r in got}
    assert (by["same"].rows_a, by["same"].only_a, by["same"].only_b, by["same"].samples_a) == (5000, 0, 0, [])
    assert (by["empty"].rows_a, by["empty"].only_b) == (0, 0)
    assert (by["other"].rows_a, by["other"].rows_b, by["other"].only_a, by["other"].only_b) == (5003, 5004, 1, 2)
    assert by["other"].samples_a == ['{"id":17,"v":3,"l":[17]}'] and len(by["other"].samples_b) == 2
    found = digests.differing_ranges({"other": (twice, b), "same": (a, a)})
    assert 1 <= len(found["other"]["differ"]) <= 3 and found["same"]["differ"] == []


def test_equal_tables_shuffle_no_rows(spark):
    """The only exchange of a comparison of equal tables carries a row per range and task."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = digests.range_digests(lines, lines.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_range") == plan.count("Exchange") == 1
    assert "partial_count" in plan.split("Exchange")[1]


def _hot(spark, n=4000):
    rng = random.Random(4)
    rows = [("hot" if k % 10 else f"g{k % 3}", rng.choice([-3.5, 0.0, 2.25, rng.uniform(-1e6, 1e6), rng.uniform(0, 1e-6), float(rng.randint(0, 20))]), k) for k in range(n)]
    rows += [("none", None, -1), (None, 5.0, -2), (None, 7.0, -3), ("one", 1.0, -4)]
    return rows, spark.createDataFrame(rows, "g string, v double, id long")


def test_order_values_by_counting(spark):
    rows, df = _hot(spark)
    n = F.col("_n")
    got = {r.g: r for r in stats.order_values(df, ["g"], "v", {"low": F.lit(1), "mid": F.floor((n - 1) / 2) + 1, "high": n}).collect()}
    groups = collections.defaultdict(list)
    for g, v, _ in rows:
        if v is not None:
            groups[g].append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        vs.sort()
        assert (got[g]._n, got[g].low, got[g].mid, got[g].high) == (len(vs), vs[0], vs[(len(vs) - 1) // 2], vs[-1])
    plan = stats.exact_percentiles(df, ["g"], "v", {"p50": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_rows_at_ranks_with_ties(spark):
    rows, df = _hot(spark)
    n = F.col("_n")
    ranks = F.array(F.lit(1).cast("bigint"), F.floor(n / 3).cast("bigint") + 1, n)
    got = collections.defaultdict(dict)
    for r in stats.rows_at_ranks(df, ["g"], "v", "id", ranks).collect():
        got[r.g][r._rank] = (r.v, r.id)
    groups = collections.defaultdict(list)
    for g, v, i in rows:
        if v is not None:
            groups[g].append((v, i))
    for g, vs in groups.items():
        vs.sort()
        assert got[g] == {k: vs[k - 1] for k in {1, len(vs) // 3 + 1, len(vs)}}

"""Versions: a load writes what changed and nothing else, a crash leaves the old version, lookups read few files."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from fathom.operators.digests import compare_by_digest
from fathom.plans import questions as Q
from fathom.plans.changes import ChangedSource, day_of_changes, next_day
from fathom.plans.incremental import build_incremental
from fathom.plans.publish import PublishedWarehouse, build_full, etl_runs
from fathom.plans.versions import Load, Version, current_version, names_in, vacuum
from fathom.plans.warehouse import ORDER_TABLES, STAR_TABLES, Warehouse
from fathom.sources.fixtures import Store

SF = "/root/testdata/sf0.001"
SIZES = {"block": 500, "slot": 20}


def quiet(base):
    """A time by which no order of the source has been touched for days."""
    return next_day(Warehouse(base)) + dt.timedelta(days=5)


def fresh():
    return tempfile.mkdtemp(prefix="fathom-ver-", dir="/tmp")


@pytest.fixture(scope="module")
def built(spark):
    """A full load in small blocks and slots; tests load on top of copies of its pointer, never over its files."""
    root = fresh()
    base = Store(spark, SF)
    info = build_full(spark, base, root, extracted_at=quiet(base), sizes=SIZES)
    return root, base, info


class TouchedSource(Store):
    """Orders of two months of one half year get a new status; nothing else changes."""

    def __init__(self, base, at):
        super().__init__(base.spark, base.sf_dir)
        self.base, self.at = base, at

    def hit(self):
        day = F.col("placed_at").cast("date")
        return ((F.trunc(day, "month") == F.lit(dt.date(1996, 3, 1))) | (F.trunc(day, "month") == F.lit(dt.date(1996, 5, 1)))) & (F.col("status") != "cancelled")

    def table(self, name):
        df = self.base.table(name)
        if name != "orders":
            return df
        return df.withColumns({"status": F.when(self.hit(), "cancelled").otherwise(F.col("status")),
                               "updated_at": F.when(self.hit(), F.lit(self.at)).otherwise(F.col("updated_at"))})


def same_tables(spark, version, full):
    tables = {n: (version.table(n).drop("year", "month"), full.table(n).drop("year", "month")) for n in STAR_TABLES}
    tables.update({f"raw.{n}": (version.raw(n), full.raw(n)) for n in ORDER_TABLES})
    bad = [r.asDict() for r in compare_by_digest(tables).collect() if r.only_a or r.only_b or r.rows_a != r.rows_b]
    assert not bad, bad


def test_a_load_writes_only_touched_months(spark, built):
    root, base, _ = built
    at = quiet(base)
    src = TouchedSource(base, at)
    before = Version.open(spark, root)
    info = build_incremental(spark, src, root, extracted_at=at + dt.timedelta(days=1))
    after = PublishedWarehouse.open(spark, root)
    new = {(r.layer, r.table, r.part) for r in after.version.entries.where(F.col("folder").contains("load=000002")).select("layer", "table", "part").distinct().collect()}
    ids = [r.id for r in base.orders.where(src.hit()).select("id").collect()]
    months = {"year=1996/month=3", "year=1996/month=5"}
    assert 0 < len(ids) < base.orders.count() / 10
    # every order of the two months is cancelled: their sales are gone, all other months lie where they lay
    assert {p for la, t, p in new if t == "fact_orders"} == months
    assert {p for la, t, p in new if t == "fact_sales"} == set()
    assert not months & set(after.version.parts("dw", "fact_sales"))
    assert {p for la, t, p in new if t == "orders"} == {f"block={i // SIZES['block']}" for i in ids}
    untouched = {t for la, t in after.version.tables()} - {t for la, t, p in new} - {"fact_sales", "fact_returns"}
    assert {"customers", "products", "dim_product", "dim_customer", "fact_reviews", "fact_inventory", "dim_category", "fx_rates_daily"} <= untouched
    assert after.version.parts("dw", "dim_product") == before.parts("dw", "dim_product")
    written = after.version.entries.where(F.col("folder").contains("load=000002")).count()
    assert written < after.version.entries.count() / 2, (written, after.version.entries.count())
    assert info["version"] == "v=000002"

    full_root = fresh()
    build_full(spark, src, full_root)
    same_tables(spark, after, PublishedWarehouse.open(spark, full_root))
    # the version before still reads as it was
    assert Version(spark, root, "v=000001").read("dw", "fact_orders").where("status = 'cancelled'").count() < after.fact_orders.where("status = 'cancelled'").count()


def test_a_day_of_changes_equals_a_full_build(spark):
    base = Store(spark, SF)
    w = base.orders.agg(F.max("id")).first()[0] * 9 // 10
    at = next_day(Warehouse(base))
    src = ChangedSource(base, day_of_changes(base, w, at))
    root, full_root = fresh(), fresh()
    build_full(spark, base, root, max_order_id=w, extracted_at=at, sizes=SIZES)
    keys = {(r.product_id, r.valid_from): r.product_key for r in PublishedWarehouse.open(spark, root).dim_product.collect()}
    build_incremental(spark, src, root, extracted_at=at)
    build_full(spark, src, full_root)
    inc, full = PublishedWarehouse.open(spark, root), PublishedWarehouse.open(spark, full_root)
    known = {(r.product_id, r.valid_from): r.product_key for r in inc.dim_product.collect()}
    assert all(known[k] == v for k, v in keys.items())
    same_tables(spark, inc, full)
    again = build_incremental(spark, src, root, extracted_at=at + dt.timedelta(days=1))
    assert again["version"] == "v=000003"
    same_tables(spark, PublishedWarehouse.open(spark, root), full)
    assert [r.version for r in etl_runs(spark, root).collect()] == ["v=000003", "v=000002", "v=000001"]


def test_nothing_changed_writes_nothing(spark, built):
    root, base, _ = built
    now = Version.open(spark, root)
    src = TouchedSource(base, quiet(base))
    info = build_incremental(spark, src, root, extracted_at=quiet(base) + dt.timedelta(days=2))
    after = Version.open(spark, root)
    assert info["steps"] == [] and after.version != now.version
    assert after.entries.exceptAll(now.entries).count() == 0 and now.entries.exceptAll(after.entries).count() == 0


def test_a_crash_before_publishing_leaves_the_old_version(spark, built, monkeypatch):
    root, base, _ = built
    before, runs = current_version(root), etl_runs(spark, root).count()
    src = ChangedSource(base, day_of_changes(base, 10 ** 9, next_day(Warehouse(base)) + dt.timedelta(days=3)))

    def crash(self):
        raise RuntimeError("lost between data and manifest")

    with monkeypatch.context() as m:
        m.setattr(Load, "finish", crash)
        with pytest.raises(RuntimeError):
            build_incremental(spark, src, root)
    assert current_version(root) == before and etl_runs(spark, root).count() == runs
    pub = PublishedWarehouse.open(spark, root)
    assert pub.fact_orders.count() == base.orders.count()


def test_lookup_reads_few_files(spark, built):
    """One customer's orders, and one order with its lines: candidate files from the manifest, not the table."""
    root, base, _ = built
    pub = PublishedWarehouse.open(spark, root)
    everything = len(pub.version.read("idx", "orders_by_customer").inputFiles())
    customer = base.orders.groupBy("customer_id").count().orderBy(F.desc("count")).first().customer_id
    found = pub.orders_of(customer)
    assert len(found.inputFiles()) <= 2 < everything
    want = {r.id for r in base.orders.where(F.col("customer_id") == customer).select("id").collect()}
    assert {r.order_id for r in found.collect()} == want
    order = max(want)
    items = pub.order_rows("order_items", [order])
    assert len(items.inputFiles()) <= 2 < len(pub.raw("order_items").inputFiles())
    page = pub.order_with_lines(order)
    assert sorted(map(str, page.collect())) == sorted(map(str, Warehouse(base).order_with_lines(order).select(*page.columns).collect()))
    assert pub.orders_of(10 ** 9).count() == 0 and pub.order_rows("orders", []).count() == 0
    for store, star in (Q.QUESTIONS["customer_orders"],):
        a, b = ([(r.order_id, r.line_count, r.total_usd) for r in q(pub, customer).collect()] for q in (store, star))
        assert a == b and len(a) == min(20, len(want))


def test_raw_orders_and_rates_are_sorted(spark, built):
    """S3: inside each file (and block) orders lie in the order of their time, rates by day."""
    root, _, _ = built
    v = Version.open(spark, root)
    for table, by in (("orders", ["block", "placed_at"]), ("fx_rates", ["rate_date"]), ("fx_rates_daily", ["day"])):
        rows = v.read("raw", table).select("*", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i")).collect()
        last = {}
        for r in sorted(rows, key=lambda r: (r.f, r.i)):
            now = tuple(r[c] for c in by)
            assert last.get(r.f, now) <= now
            last[r.f] = now


def test_vacuum_keeps_what_versions_name(spark):
    root = fresh()
    rows = lambda a, b: spark.range(a, b).withColumn("p", F.col("id") % 3)
    from fathom.plans.versions import next_version, publish
    for k in range(4):
        old = Version.open(spark, root) if current_version(root) else None
        load = Load(spark, root, next_version(root), old)
        load.write(rows(100 * k, 100 * k + 90).where("p = 1" if k else "true"), "raw", "t", ("p",), None if old is None else ["p=1"])
        load.write(spark.range(k + 1), "raw", "whole")
        load.finish()
        publish(root, load.version)
    gone = vacuum(spark, root, keep=1)
    assert gone and "raw/t/load=000002" in gone and "raw/whole/load=000001" in gone and "raw/t/load=000001/p=1" in gone
    v = Version.open(spark, root)
    assert v.version == "v=000004" and v.read("raw", "whole").count() == 4
    assert sorted({r.id for r in v.read("raw", "t").collect()}) == sorted(list(i for i in range(90) if i % 3 != 1) + [i for i in range(300, 390) if i % 3 == 1])
    assert names_in(f"{root}/v=000001") == []

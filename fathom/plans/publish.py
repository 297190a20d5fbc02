"""Full warehouse build, published as a version, and readers of a published version.

The tables are laid out and versioned as ``versions`` describes, in three layers::

    raw   store tables cut at the watermark; order tables in blocks of order ids
    dw    dimensions, facts (by month of the order) and marts
    idx   orders_by_customer: the orders of each customer, in slots of customer ids

A version also has ``meta/etl_steps`` (label, rows, seconds of each step) and
``meta/etl_info`` (the run); ``root/etl_runs`` has a row per published run.
On a cluster ``root`` is a shared filesystem / object store path.
"""

from __future__ import annotations

import datetime as dt
import time
from bisect import bisect_left
from collections.abc import Callable
from functools import cached_property, wraps
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import LOAD_CONF, settings
from ..sources.fixtures import STORE_TABLES, Store
from .versions import Load, Version, digest_of, exists, next_version, publish, run_parallel
from .warehouse import ORDER_TABLES, STAR_TABLES, Warehouse

# star tables in dependency waves: every table of a wave only reads earlier waves
STAR_WAVES = [
    ["dim_date", "dim_category", "dim_employee", "dim_warehouse", "dim_promotion", "fact_reviews", "fact_inventory"],
    ["dim_product", "dim_customer", "fact_orders"],
    ["fact_sales"],
    ["fact_returns", "product_pairs", "product_stats"],
]

#: What each star table is made of; an incremental load takes over a table none of whose inputs changed.
MADE_OF = {
    "dim_date": ["orders"], "dim_category": ["categories"], "dim_employee": ["employees"],
    "dim_product": ["product_prices", "products", "brands", "categories"],
    "dim_customer": ["customers", "countries", "employees"], "dim_warehouse": ["warehouses", "countries", "employees"],
    "dim_promotion": ["promotions", "promotion_products"], "fact_reviews": ["reviews"], "fact_inventory": ["inventory", "products"],
    "product_pairs": ["orders"], "product_stats": ["orders", "reviews", "product_prices", "products", "brands", "categories"],
}

#: How tables are laid out, in every build alike: (range-partition columns, sort columns). Rates and orders are read by date.
LAYOUT = {
    "orders": (["block", "placed_at"], ["block", "placed_at", "id"]),
    "order_items": (["order_id"], ["block", "order_id", "line_no"]),
    "payments": (["order_id"], ["block", "order_id", "id"]),
    "shipments": (["order_id"], ["block", "order_id", "id"]),
    "returns": (["order_id"], ["block", "order_id", "id"]),
    "fx_rates": (["rate_date"], ["rate_date", "currency_code"]),
    "fx_rates_daily": (["day"], ["day", "currency_code"]),
    "fact_sales": (["order_date"], ["year", "month", "placed_at", "order_id", "line_no"]),
    "fact_orders": (["order_date"], ["year", "month", "placed_at", "order_id"]),
    "fact_returns": (["order_date"], ["year", "month", "return_date", "return_id"]),
    "orders_by_customer": (["customer_id"], ["slot", "customer_id", "placed_at", "order_id"]),
}
MONTHS = ("year", "month")
PARTITIONS = {"fact_sales": MONTHS, "fact_orders": MONTHS, "fact_returns": MONTHS, "orders_by_customer": ("slot",),
              **{t: ("block",) for t in ORDER_TABLES}}
#: Columns that get Parquet Bloom filters: what rows are looked up by.
BLOOM = {"orders": ["id"], "order_items": ["order_id"], "payments": ["order_id"], "shipments": ["order_id"], "returns": ["order_id"],
         "orders_by_customer": ["customer_id"]}

#: Ids in a block of order tables and customers in a slot: at least so many, and at most ``MOST_PARTS`` parts to begin with.
LEAST_BLOCK, LEAST_SLOT, MOST_PARTS = 100_000, 10_000, 512

BY_CUSTOMER = ["customer_id", "order_id", "placed_at", "status", "currency_code", "total", "order_date", "line_count", "total_usd",
               "customer_order_number"]


def width(highest: int, least: int) -> int:
    return max(least, -(-(highest + 1) // MOST_PARTS))


def part_of(id_column: Column, size: int) -> Column:
    return F.floor(id_column / size).cast("long")


def month_of(day: dt.date) -> str:
    return f"year={day.year}/month={day.month}"


def orders_by_day(orders: DataFrame) -> list[tuple[dt.date, int]]:
    """Days and their orders, by day (bounded by the calendar)."""
    days = orders.where(F.col("placed_at").isNotNull()).groupBy(F.col("placed_at").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return sorted((r.day, r.n) for r in days.collect())


def day_cuts(days: list[tuple[dt.date, int]], n: int) -> list[dt.date]:
    """First days of the second and later of at most ``n`` ranges of days with about as many orders each."""
    upto = list(accumulate(c for _, c in days))
    at = sorted({bisect_left(upto, upto[-1] * i / n) + 1 for i in range(1, n)}) if upto else []
    return [days[i][0] for i in at if i < len(days)]


def id_cuts(orders: DataFrame, n: int) -> list[int]:
    """Ids that cut the orders into ``n`` ranges of about as many each."""
    found = orders.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    return sorted(set(found or []))


def _range_of(key: Column, cuts: list, first: int = 0) -> Column:
    """Number of the ``cuts`` that are not above ``key``, by halving."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(key < F.lit(cuts[mid]), _range_of(key, cuts[:mid], first)).otherwise(_range_of(key, cuts[mid + 1:], first + mid + 1))


def laid_out(df: DataFrame, name: str, n: int, sizes: dict[str, int], cuts: dict[str, list] | None = None,
             shape: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` in the layout of table ``name``, with its part columns; ``sizes``: ids in a block and in a slot.

    ``cuts``: by column, where it is cut into ranges. Where that is known, the rows need not be made twice, once for Spark's own
    sample of the ranges. ``shape`` makes the table's columns of the rows, after they are dealt where the ranges are known."""
    by, sort = LAYOUT.get(name, ([], []))
    known = bool(cuts) and len(by) == 1 and by[0] in cuts
    if known:
        df = df.repartitionById(n, _range_of(F.col(by[0]), cuts[by[0]]))
    if shape is not None:
        df = shape(df)
    parts = PARTITIONS.get(name, ())
    df = df.drop(*parts)
    if "year" in parts:
        df = df.withColumn("year", F.year("order_date")).withColumn("month", F.month("order_date"))
    if "block" in parts:
        df = df.withColumn("block", part_of(F.col(ORDER_TABLES[name]), sizes["block"]))
    if "slot" in parts:
        df = df.withColumn("slot", part_of(F.col("customer_id"), sizes["slot"]))
    if not by:
        return df
    dealt = df if known else df.repartitionByRange(n, *by)
    return dealt.sortWithinPartitions(*sort)  # each file covers a range (row groups can be skipped)


def by_customer(fact_orders: DataFrame) -> DataFrame:
    """The index of orders by customer, from order facts."""
    return fact_orders.withColumnRenamed("total_local", "total").select(*BY_CUSTOMER)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def counted_write(load: Load, df: DataFrame, layer: str, name: str, n: int, sizes: dict[str, int], steps: list, replaces=None, digest: str | None = None,
                  cuts: dict[str, list] | None = None, shape: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write a table in its layout and note (label, rows, seconds); rows and digest are taken by the write itself."""
    t0 = time.time()
    obs = Observation(f"{layer}.{name}")
    more = [digest_of(df).alias("digest")] if layer == "raw" and name not in PARTITIONS and digest is None else []
    out = laid_out(df, name, n, sizes, cuts, shape).observe(obs, F.count(F.lit(1)).alias("rows"), *more)
    ids = next((sizes[p] for p in PARTITIONS.get(name, ()) if p in sizes), None)  # a file lies in one block or slot
    load.write(out, layer, name, PARTITIONS.get(name, ()), replaces, digest, BLOOM.get(name, ()), ids)
    if more:
        load.note_digest(layer, name, obs.get["digest"])
    steps.append((f"{layer}.{name}", int(obs.get["rows"]), round(time.time() - t0, 3)))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


_RUN = ("version string, mode string, max_order_id long, data_until timestamp_ntz, finished_at timestamp_ntz, seconds double, "
        "block long, slot long")


def finish_run(load: Load, mode: str, w: int, data_until: dt.datetime, started: float, sizes: dict[str, int], steps: list,
               publish_version: bool) -> None:
    """Manifest, steps and run of this version; then the pointer; then one more row in the history of published runs."""
    load.finish()
    spark = load.spark
    _write(spark.createDataFrame(steps, "label string, rows long, seconds double").coalesce(1), f"{load.path}/meta/etl_steps")
    row = (load.version, mode, w, data_until, utc_now(), round(time.time() - started, 3), sizes["block"], sizes["slot"])
    run = spark.createDataFrame([row], _RUN).coalesce(1)
    _write(run, f"{load.path}/meta/etl_info")
    if publish_version:
        publish(load.root, load.version)
        run.write.mode("append").parquet(f"{load.root}/etl_runs")


def etl_runs(spark: SparkSession, root: str, latest: int = 50) -> DataFrame:
    """The latest runs, newest first."""
    runs = spark.read.schema(_RUN).parquet(f"{root.rstrip('/')}/etl_runs")
    return runs.orderBy(F.col("finished_at").desc(), F.col("version").desc()).limit(latest)


def with_load_conf(load: Callable) -> Callable:
    """``load``, whose first argument is the session, under the settings of loads."""
    @wraps(load)
    def run(spark: SparkSession, *args, **kwargs):
        with settings(spark, LOAD_CONF):
            return load(spark, *args, **kwargs)
    return run


@with_load_conf
def build_full(spark: SparkSession, sf_dir: str | Store, root: str, max_order_id: int | None = None,
               publish_version: bool = True, extracted_at: dt.datetime | None = None, sizes: dict[str, int] | None = None) -> dict:
    """Extract -> dimensions -> facts -> marts -> manifest -> publish. Returns run info.

    ``sf_dir`` is the driver data folder, or a ``Store`` (e.g. a source after changes).
    ``extracted_at`` is the source's clock when the extract began (default: now, UTC); the
    next incremental load looks for changes from a little before it. ``sizes`` gives the ids in a
    block and a slot (default: by the highest id)."""
    t_start = time.time()
    data_until = extracted_at or utc_now()
    store = sf_dir if isinstance(sf_dir, Store) else Store(spark, sf_dir)
    wh = Warehouse(store, max_order_id)
    w = wh.max_order_id
    if sizes is None:
        customers = wh.raw("customers").agg(F.max("id")).first()[0] or 0
        sizes = {"block": width(w, LEAST_BLOCK), "slot": width(customers, LEAST_SLOT)}
    load = Load(spark, root, next_version(root))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps: list = []

    def step(layer, name, make, cuts=None):
        narrow = layer == "dw" and name == "fact_sales"  # dealt by day before their columns are made
        counted_write(load, pub.sales_rows if narrow else make(), layer, name, n, sizes, steps, cuts=cuts, shape=pub.as_sales if narrow else None)

    # independent tables are written concurrently: small ones cost job overhead, not work
    cuts = {"order_id": id_cuts(wh.raw("orders"), n)}
    run_parallel([("raw", t, lambda t=t: wh.raw(t), cuts) for t in STORE_TABLES]
                 + [("raw", "fx_rates_daily", lambda: wh.fx_rates_daily)], step)

    # the rest of the build reads the written raw layer, not the derivation again
    pub = PublishedWarehouse(load, raw_only=True)
    cuts["order_date"] = day_cuts(orders_by_day(pub.raw("orders")), n)
    for wave in STAR_WAVES:
        run_parallel([("dw", t, lambda t=t: pub.table(t), cuts) for t in wave], step)
        for t in wave:
            pub.mark_written(t)
    step("idx", "orders_by_customer", lambda: by_customer(pub.fact_orders))

    finish_run(load, "full", w, data_until, t_start, sizes, steps, publish_version)
    return {"version": load.version, "path": load.path, "max_order_id": w, "steps": steps,
            "seconds": round(time.time() - t_start, 3)}


class PublishedWarehouse(Warehouse):
    """A Warehouse whose layers are read from a version."""

    def __init__(self, version: Version, raw_only: bool = False):
        self.spark = version.spark
        self.version = version
        self._raw_only = raw_only
        self._written: set[str] = set()
        self.store = _PublishedStore(version)
        self._w = None

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "PublishedWarehouse":
        return cls(Version.open(spark, root))

    @property
    def order_heads(self) -> DataFrame:
        return self.fact_orders

    @property
    def most_lines(self) -> int:
        return self.fact_orders.agg(F.max("line_count")).first()[0] or 0

    def mark_written(self, name: str) -> None:
        self._written.add(name)
        self.__dict__.pop(name, None)

    def raw(self, name: str) -> DataFrame:
        return self.version.read("raw", name).drop("block")

    @cached_property
    def info(self) -> dict:
        """The run that wrote this version."""
        return self.spark.read.schema(_RUN).parquet(f"{self.version.path}/meta/etl_info").first().asDict()

    @cached_property
    def max_order_id(self) -> int:  # type: ignore[override]
        if exists(f"{self.version.path}/meta/etl_info"):
            return int(self.info["max_order_id"])
        return int(self.raw("orders").agg(F.max("id")).first()[0])

    # -- few rows by key: the files that may hold them, not the table ------------------------------
    def orders_of(self, customer_id: int) -> DataFrame:
        slot = f"slot={customer_id // self.info['slot']}"
        return self.version.lookup("idx", "orders_by_customer", "customer", [customer_id], [slot]).drop("slot")

    order_facts_of = orders_of

    def order_rows(self, name: str, order_ids: list[int]) -> DataFrame:
        blocks = {f"block={i // self.info['block']}" for i in order_ids}
        return self.version.lookup("raw", name, "order", order_ids, blocks).drop("block") if order_ids else self.raw(name).limit(0)

    def __getattribute__(self, name):
        if name in STAR_TABLES or name == "fx_rates_daily":
            d = object.__getattribute__(self, "__dict__")
            if name == "fx_rates_daily":
                return object.__getattribute__(self, "raw")("fx_rates_daily")
            if not d.get("_raw_only") or name in d.get("_written", ()):
                out = d["version"].read("dw", name)
                return out if name == "fact_sales" else out.drop(*MONTHS) if name in PARTITIONS else out
        return object.__getattribute__(self, name)


class _PublishedStore(Store):
    def __init__(self, version: Version):
        super().__init__(version.spark, version.path)
        self.version = version

    def table(self, name: str) -> DataFrame:
        return self.version.read("raw", name).drop("block")

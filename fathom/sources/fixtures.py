"""The online-store tables, derived from the driver tables.

The store model has 24 normalized tables. The driver supplies TPC-H-shaped
tables, so each store table is a deterministic DataFrame job over them: only
integer and exact-decimal arithmetic, so that an independent SQL oracle can
rebuild the same rows. Every derivation is row-local or an equi join on
keys; none collects data to the driver and none generates pairs.

Fixed values below (currency table, name lists) are part of the fixture
definition and must stay in sync with the oracle's fixture block.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from .driver import read_table

# --- fixed values -----------------------------------------------------------
# region key -> (currency code, name, symbol, units per USD in thousandths)
CURRENCIES = [
    ("USD", "US Dollar", "$", 1000),
    ("CAD", "Canadian Dollar", "C$", 1360),
    ("EUR", "Euro", "€", 920),
    ("GBP", "Pound Sterling", "£", 790),
    ("JPY", "Yen", "¥", 148000),
]
FX_FIRST_DAY = "1994-12-26"
FX_LAST_DAY = "2001-12-31"
COLORS = ["black", "white", "red", "blue"]
CARRIERS = ["DHL", "FedEx", "UPS", "USPS"]
PAYMENT_METHODS = ["card", "paypal", "bank_transfer", "gift_card"]
RETURN_REASONS = ["damaged", "wrong_item", "not_as_described", "changed_mind", "late_delivery"]
PRICE_VERSIONS = [  # (version, valid_from, factor, applies when product id % m == 0)
    (1, "1994-01-01 00:00:00", "0.90", 1),
    (2, "1997-06-01 09:00:00", "0.95", 2),
    (3, "1999-11-15 12:30:00", "1.00", 3),
]
PROMOTION_COUNT = 12
WAREHOUSE_COUNT = 5
# ---------------------------------------------------------------------------


def pick(values, idx: Column) -> Column:
    """values[idx] for a 0-based integer column (a JVM-side array lookup)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def secs(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def dec(v: str) -> Column:
    return F.lit(Decimal(v))


class Store:
    """Lazy accessors for every store table of one driver data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def n_suppliers(self) -> int:
        """Scalar row count (one small action, then used as a literal)."""
        return self._t("supplier").select("s_suppkey").count()

    @cached_property
    def n_parts(self) -> int:
        return self._t("part").select("p_partkey").count()

    # -- reference data --------------------------------------------------------
    @cached_property
    def currencies(self) -> DataFrame:
        r = self._t("region").select("r_regionkey")
        k = F.col("r_regionkey")
        return r.select(
            k.alias("region_key"),
            pick([c[0] for c in CURRENCIES], k).alias("code"),
            pick([c[1] for c in CURRENCIES], k).alias("name"),
            pick([c[2] for c in CURRENCIES], k).alias("symbol"),
            pick([c[3] for c in CURRENCIES], k).cast("bigint").alias("base_milli"),
        )

    @cached_property
    def countries(self) -> DataFrame:
        n = self._t("nation")
        r = self._t("region")
        cur = self.currencies.select("region_key", F.col("code").alias("currency_code"))
        return (
            n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .join(F.broadcast(cur), F.col("n_regionkey") == F.col("region_key"))
            .select(
                F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"),
                F.col("n_name").alias("name"),
                F.col("r_name").alias("region"),
                "currency_code",
                ((F.col("n_nationkey") % 5).cast("decimal(5,4)") * dec("0.05")).cast("decimal(5,4)").alias("tax_rate"),
                F.col("n_nationkey").alias("nation_key"),
            )
        )

    @cached_property
    def fx_rates(self) -> DataFrame:
        """Business-day rates (Mon-Fri) per currency, exact decimals."""
        cur = self.currencies
        day = F.explode(F.sequence(F.to_date(F.lit(FX_FIRST_DAY)), F.to_date(F.lit(FX_LAST_DAY))))
        d = cur.select("region_key", "code", "base_milli", day.alias("rate_date"))
        i = F.datediff("rate_date", F.to_date(F.lit(FX_FIRST_DAY))).cast("bigint")
        factor = F.when(F.col("code") == "USD", F.lit(1000)).otherwise(
            F.lit(980) + (F.lit(7) * i + F.lit(13) * F.col("region_key")) % 41)
        units = ((F.col("base_milli") * factor).cast("decimal(18,0)") * dec("0.000001")).cast("decimal(18,8)")
        return d.where(F.dayofweek("rate_date").between(2, 6)).select(
            F.col("code").alias("currency_code"), "rate_date", units.alias("units_per_usd"))

    # -- people ------------------------------------------------------------------
    @cached_property
    def employees(self) -> DataFrame:
        s = self._t("supplier").select("s_suppkey", "s_nationkey")
        k = F.col("s_suppkey")
        eid = k + 1
        c = self.countries.select("nation_key", "region")
        return s.join(F.broadcast(c), s.s_nationkey == c.nation_key, "left").select(
            eid.alias("id"),
            F.when(k == 0, F.lit(None).cast("bigint")).otherwise(F.floor((k - 1) / 3).cast("bigint") + 1).alias("manager_id"),
            F.lit("Emp").alias("first_name"),
            eid.cast("string").alias("last_name"),
            F.concat(F.lit("emp"), eid.cast("string"), F.lit("@example.com")).alias("email"),
            F.when(k == 0, "CEO").when(k < 4, "Director").when(k < 13, "Manager")
            .otherwise("Account Executive").alias("title"),
            F.when(k == 0, "Executive").when(k % 4 == 3, "Operations").otherwise("Sales").alias("department"),
            F.when(k == 0, F.lit(None).cast("string")).otherwise(F.col("region")).alias("region"),
            F.lit(None).cast("bigint").alias("warehouse_id"),
            F.date_add(F.to_date(F.lit("2015-01-01")), (k % 1000).cast("int")).alias("hired_at"),
            (F.lit(50000) + (k % 50) * 1000).cast("decimal(12,2)").alias("salary_usd"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self._t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        k = F.col("c_custkey")
        cid = k + 1
        seg = (F.when(F.col("c_mktsegment") == "MACHINERY", "vip")
               .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "business")
               .otherwise("consumer"))
        n_sup = F.lit(self.n_suppliers)
        return c.select(
            cid.alias("id"),
            F.concat(F.lit("cust"), cid.cast("string"), F.lit("@example.com")).alias("email"),
            F.lit("Cust").alias("first_name"),
            cid.cast("string").alias("last_name"),
            seg.alias("segment"),
            F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("country_code"),
            F.when(k % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.floor(k / 2).cast("bigint") + 1)
            .alias("referred_by_customer_id"),
            F.when(seg == "consumer", F.lit(None).cast("bigint")).otherwise(F.lit(1) + k % n_sup)
            .cast("bigint").alias("account_manager_id"),
            (F.to_timestamp_ntz(F.lit("1994-01-01 00:00:00")) + days(k % 365)).alias("created_at"),
        )

    @cached_property
    def addresses(self) -> DataFrame:
        c = self.customers.select("id", "country_code")
        kinds = F.explode(F.array(F.lit(0), F.lit(1))).alias("n")
        a = c.select("*", kinds).where((F.col("n") == 0) | (F.col("id") % 3 == 0))
        return a.select(
            (F.col("id") * 2 + F.col("n")).alias("id"),
            F.col("id").alias("customer_id"),
            F.when(F.col("n") == 0, "shipping").otherwise("billing").alias("kind"),
            F.concat(F.lit("Street "), F.col("id").cast("string")).alias("line1"),
            F.concat(F.lit("City "), (F.col("id") % 97).cast("string")).alias("city"),
            F.lpad((F.col("id") % 100000).cast("string"), 5, "0").alias("postal_code"),
            "country_code",
            (F.col("n") == 0).alias("is_default"),
        )

    # -- catalog -----------------------------------------------------------------
    @cached_property
    def _types(self) -> DataFrame:
        """Rank of every distinct part type: the category roots."""
        t = self._t("part").select("p_type").distinct()
        return t.select("p_type", F.dense_rank().over(Window.orderBy("p_type")).alias("t"))

    @cached_property
    def categories(self) -> DataFrame:
        t = self._types
        roots = t.select(F.col("t").cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("parent_id"),
                         F.col("p_type").alias("name"))
        bands = t.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("b"))
        band_id = F.lit(100) + F.col("t") * 10 + F.col("b")
        band_rows = bands.select(band_id.cast("bigint").alias("id"), F.col("t").cast("bigint").alias("parent_id"),
                                 F.concat_ws(" ", "p_type", F.lit("band"), F.col("b").cast("string")).alias("name"))
        lines = bands.where(F.col("b") % 2 == 0).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("l"))
        line_rows = lines.select(
            (F.lit(10000) + band_id * 10 + F.col("l")).cast("bigint").alias("id"),
            band_id.cast("bigint").alias("parent_id"),
            F.concat_ws(" ", "p_type", F.lit("band"), F.col("b").cast("string"), F.lit("line"),
                        F.col("l").cast("string")).alias("name"))
        out = roots.unionByName(band_rows).unionByName(line_rows)
        return out.select("id", "parent_id", "name", F.lower(F.regexp_replace("name", " ", "-")).alias("slug"))

    @cached_property
    def brands(self) -> DataFrame:
        b = self._t("part").select("p_brand").distinct()
        return b.select(F.dense_rank().over(Window.orderBy("p_brand")).cast("bigint").alias("id"),
                        F.col("p_brand").alias("name"))

    @cached_property
    def products(self) -> DataFrame:
        p = self._t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
        k = F.col("p_partkey")
        pid = k + 1
        band = F.floor((F.col("p_size") - 1) / 10)
        band_id = F.lit(100) + F.col("t") * 10 + band
        category = F.when(band % 2 == 0, F.lit(10000) + band_id * 10 + k % 2).otherwise(band_id)
        price = F.col("p_retailprice").cast("decimal(12,2)")
        attrs = F.concat(
            F.lit('{"color":"'), pick(COLORS, k % 4), F.lit('","warranty_months":'),
            ((k % 3) * 12).cast("string"),
            F.when(k % 5 == 0, F.lit(',"sizes":["S","M","L"]')).otherwise(F.lit("")), F.lit("}"))
        brands = self.brands.select(F.col("id").alias("brand_id"), F.col("name").alias("p_brand"))
        return (p.join(self._types, "p_type").join(brands, "p_brand").select(
            pid.alias("id"),
            F.concat(F.lit("SKU-"), F.lpad(pid.cast("string"), 8, "0")).alias("sku"),
            F.col("p_name").alias("name"),
            F.concat(F.lit("About "), F.col("p_name")).alias("description"),
            category.cast("bigint").alias("category_id"),
            "brand_id",
            price.alias("price_usd"),
            F.round(price * dec("0.6"), 2).cast("decimal(12,2)").alias("cost_usd"),
            (F.col("p_size").cast("decimal(8,3)") * dec("0.250")).cast("decimal(8,3)").alias("weight_kg"),
            attrs.alias("attributes"),
            (k % 50 != 7).alias("is_active"),
            F.to_timestamp_ntz(F.lit("1994-01-01 00:00:00")).alias("created_at"),
        ))

    @cached_property
    def product_prices(self) -> DataFrame:
        """Price versions (half-open, NULL valid_to = current); lead() closes each version."""
        p = self.products.select("id", "price_usd")
        versions = F.array(*[F.struct(F.lit(n).alias("n"), F.to_timestamp_ntz(F.lit(ts)).alias("valid_from"),
                                      dec(f).alias("factor"), F.lit(m).alias("m"))
                             for n, ts, f, m in PRICE_VERSIONS])
        v = p.select("*", F.inline(versions)).where(F.col("id") % F.col("m") == 0)
        w = Window.partitionBy("id").orderBy("valid_from")
        return v.select(
            F.col("id").alias("product_id"),
            "valid_from",
            F.lead("valid_from").over(w).alias("valid_to"),
            F.round(F.col("price_usd") * F.col("factor"), 2).cast("decimal(12,2)").alias("price_usd"),
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        s = self._t("supplier").select("s_suppkey", "s_name", "s_nationkey")
        return s.select(
            (F.col("s_suppkey") + 1).alias("id"), F.col("s_name").alias("name"),
            F.concat(F.lit("N"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("country_code"),
            (F.lit(1) + F.col("s_suppkey") % 5).cast("smallint").alias("rating"))

    @cached_property
    def product_suppliers(self) -> DataFrame:
        n_sup = F.lit(self.n_suppliers)
        p = self.products.select("id", "cost_usd")
        p = p.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))
        return p.select(
            F.col("id").alias("product_id"),
            (F.lit(1) + (F.col("id") + F.col("n") * 7) % n_sup).cast("bigint").alias("supplier_id"),
            F.round(F.col("cost_usd") * F.when(F.col("n") == 0, dec("1.00")).otherwise(dec("1.05")), 2)
            .cast("decimal(12,2)").alias("unit_cost_usd"),
            (F.lit(3) + F.col("id") % 20).cast("int").alias("lead_time_days"),
            (F.col("n") == 0).alias("is_primary"))

    @cached_property
    def warehouses(self) -> DataFrame:
        n = self._t("nation").select("n_nationkey").where(
            (F.col("n_nationkey") % 5 == 0) & (F.col("n_nationkey") < 5 * WAREHOUSE_COUNT))
        wid = (F.col("n_nationkey") / 5).cast("bigint") + 1
        return n.select(
            wid.alias("id"), F.concat(F.lit("WH-"), wid.cast("string")).alias("code"),
            F.concat(F.lit("Warehouse "), wid.cast("string")).alias("name"),
            F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_code"),
            F.concat(F.lit("City "), wid.cast("string")).alias("city"),
            (wid + 2).alias("manager_employee_id"))

    @cached_property
    def inventory(self) -> DataFrame:
        p = self.products.select("id")
        w = p.select("id", F.explode(F.sequence(F.lit(1), F.lit(WAREHOUSE_COUNT))).alias("warehouse_id"))
        return w.select(
            F.col("warehouse_id").cast("bigint").alias("warehouse_id"), F.col("id").alias("product_id"),
            ((F.col("id") * 31 + F.col("warehouse_id") * 17) % 200).cast("int").alias("quantity_on_hand"),
            F.lit(40).alias("reorder_point"),
            F.to_timestamp_ntz(F.lit("2001-08-01 00:00:00")).alias("updated_at"))

    @cached_property
    def promotions(self) -> DataFrame:
        # one row per promotion, hung off the region table so no driver-side data is made up
        r = self._t("region").select("r_regionkey").where(F.col("r_regionkey") == 0)
        p = r.select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(PROMOTION_COUNT).cast("bigint"))).alias("id"))
        start = F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")) + days(F.col("id") * 182)
        return p.select(
            "id", F.concat(F.lit("PROMO"), F.col("id").cast("string")).alias("code"),
            F.concat(F.lit("Promotion "), F.col("id").cast("string")).alias("name"),
            (F.lit(5) + F.col("id")).cast("decimal(5,2)").alias("discount_pct"),
            start.alias("starts_at"), (start + days(F.lit(60))).alias("ends_at"))

    @cached_property
    def promotion_products(self) -> DataFrame:
        p = self.products.select("id")
        m = F.col("id") % PROMOTION_COUNT
        cand = F.array(m + 1, m)
        x = p.select("id", F.explode(cand).alias("promotion_id"))
        return x.where((F.col("promotion_id") >= 1) & (F.col("promotion_id") <= PROMOTION_COUNT - 1)).select(
            F.col("promotion_id").cast("bigint").alias("promotion_id"), F.col("id").alias("product_id"))

    # -- orders ------------------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        o = self._t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
        c = self._t("customer").select("c_custkey", "c_nationkey")
        n = self._t("nation").select("n_nationkey", "n_regionkey")
        cur = self.currencies.select("region_key", F.col("code").alias("currency_code"))
        k = F.col("o_orderkey")
        oid = k + 1
        status = (F.when(k % 33 == 0, "cancelled").when(F.col("o_orderstatus") == "F", "delivered")
                  .when(F.col("o_orderstatus") == "O", "shipped").when(k % 10 == 1, "pending").otherwise("paid"))
        placed = F.col("o_orderdate") + secs(k * 7919 % 86400)
        total = F.col("o_totalprice").cast("decimal(14,2)")
        tax = ((k % 900).cast("decimal(14,0)") * dec("0.01")).cast("decimal(14,2)")
        ship = F.when(k % 3 == 0, dec("6.00")).otherwise(dec("0.00")).cast("decimal(14,2)")
        disc = F.when(k % 4 == 3, (k % 70).cast("decimal(14,2)")).otherwise(dec("0.00")).cast("decimal(14,2)")
        cn = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(
            F.broadcast(cur), F.col("n_regionkey") == F.col("region_key")).select("c_custkey", "currency_code")
        return o.join(cn, o.o_custkey == cn.c_custkey).select(
            oid.alias("id"),
            (F.col("o_custkey") + 1).alias("customer_id"),
            ((F.col("o_custkey") + 1) * 2).alias("shipping_address_id"),
            F.when(oid % 4 == 0, F.lit(1) + oid % PROMOTION_COUNT).cast("bigint").alias("promotion_id"),
            status.alias("status"),
            "currency_code",
            (total - ship - tax + disc).cast("decimal(14,2)").alias("subtotal"),
            disc.alias("discount"),
            ship.alias("shipping_fee"),
            tax.alias("tax"),
            total.alias("total"),
            placed.alias("placed_at"),
            (placed + days(F.lit(2))).alias("updated_at"),
        )

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items with their numbering; keeps the driver columns returns need."""
        li = self._t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                        "l_extendedprice", "l_discount", "l_returnflag")
        li = li.withColumn("order_id", F.col("l_orderkey") + 1)
        # dealt by the id that joins and groups use, so that they need no second shuffle
        w = Window.partitionBy("order_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        q = F.col("l_quantity").cast("int")
        return li.select(
            "order_id",
            F.row_number().over(w).cast("smallint").alias("line_no"),
            (F.col("l_partkey") + 1).alias("product_id"),
            (F.lit(1) + F.col("l_suppkey") % WAREHOUSE_COUNT).cast("bigint").alias("warehouse_id"),
            q.alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
            F.when(F.col("l_discount") > 0.05, (q * 10).cast("decimal(12,2)")).otherwise(dec("0.00"))
            .cast("decimal(12,2)").alias("discount"),
            F.col("l_returnflag").alias("return_flag"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._lines.drop("return_flag")

    @cached_property
    def shipments(self) -> DataFrame:
        o = self.orders.where(F.col("status").isin("paid", "shipped", "delivered")).select(
            "id", "status", "placed_at")
        o = o.select("*", F.explode(F.when(F.col("id") % 7 == 0, F.array(F.lit(1), F.lit(2)))
                                    .otherwise(F.array(F.lit(1)))).alias("n"))
        oid, n = F.col("id"), F.col("n")
        moved = F.col("status").isin("shipped", "delivered")
        shipped = F.when(moved, F.col("placed_at") + secs(F.lit(14400) + (oid * 613) % 240000 + (n - 1) * 3600))
        delivered = F.when((F.col("status") == "delivered") & ~((n == 2) & (oid % 21 == 0)),
                           shipped + days(F.lit(1) + (oid + n * 3) % 11) + secs((oid * 37) % 36000))
        return o.select(
            (oid * 10 + n).alias("id"), oid.alias("order_id"),
            (F.lit(1) + (oid + n) % WAREHOUSE_COUNT).cast("bigint").alias("warehouse_id"),
            pick(CARRIERS, oid % 4).alias("carrier"),
            F.concat(F.lit("TRK"), (oid * 10 + n).cast("string")).alias("tracking_number"),
            F.when(delivered.isNotNull(), "delivered").when(shipped.isNotNull(), "in_transit")
            .otherwise("pending").alias("status"),
            shipped.alias("shipped_at"), delivered.alias("delivered_at"))

    @cached_property
    def payments(self) -> DataFrame:
        o = self.orders.select("id", "total", "placed_at")
        o = o.select("*", F.explode(F.when(F.col("id") % 50 == 1, F.array(F.lit(0), F.lit(1)))
                                    .otherwise(F.array(F.lit(1)))).alias("n"))
        oid, n = F.col("id"), F.col("n")
        return o.select(
            (oid * 10 + n).alias("id"), oid.alias("order_id"),
            pick(PAYMENT_METHODS, (oid + n) % 4).alias("method"),
            F.when(n == 0, "failed").otherwise("captured").alias("status"),
            "total",
            (F.col("placed_at") + secs(F.when(n == 0, F.lit(60)).otherwise(F.lit(1800)))).alias("paid_at"),
        ).withColumnRenamed("total", "amount")

    @cached_property
    def returns(self) -> DataFrame:
        li = self._lines.where(F.col("return_flag") == "R").select("order_id", "line_no", "product_id", "unit_price")
        o = self.orders.where(F.col("status") == "delivered").select(F.col("id").alias("order_id"), "placed_at")
        r = li.join(o, "order_id").where((F.col("product_id") % 5 == 0) | (F.col("order_id") % 9 == 0))
        return r.select(
            (F.col("order_id") * 100 + F.col("line_no")).alias("id"), "order_id", "line_no",
            F.lit(1).alias("quantity"),
            pick(RETURN_REASONS, (F.col("product_id") + F.col("order_id")) % 5).alias("reason"),
            F.lit("refunded").alias("status"),
            F.col("unit_price").alias("refund_amount"),
            (F.col("placed_at") + days(F.lit(20) + F.col("order_id") % 10)).alias("requested_at"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        li = self.order_items.select("order_id", "product_id")
        o = self.orders.where(F.col("status") == "delivered").select(
            F.col("id").alias("order_id"), "customer_id", "placed_at")
        x = li.join(o, "order_id").where((F.col("product_id") + F.col("order_id")) % 4 == 0)
        g = x.groupBy("product_id", "customer_id").agg(F.min("placed_at").alias("first_at"))
        rid = F.col("product_id") * 100000000 + F.col("customer_id")
        return g.select(
            rid.alias("id"), "product_id", "customer_id",
            (F.lit(1) + (F.col("product_id") * 3 + F.col("customer_id")) % 5).cast("smallint").alias("rating"),
            F.concat(F.lit("Review "), rid.cast("string")).alias("title"),
            F.lit("Fine.").alias("body"),
            (F.col("first_at") + days(F.lit(30))).alias("created_at"))

    @cached_property
    def carts(self) -> DataFrame:
        c = self.customers.where(F.col("id") % 10 == 0).select("id")
        return c.select(F.col("id").alias("id"), F.col("id").alias("customer_id"),
                        F.to_timestamp_ntz(F.lit("2001-08-01 00:00:00")).alias("updated_at"))

    @cached_property
    def cart_items(self) -> DataFrame:
        n_prod = F.lit(self.n_parts)
        c = self.carts.select("id")
        cid = F.col("id")
        prods = F.array(F.lit(1) + (cid * 7) % n_prod, F.lit(1) + (cid * 13 + 1) % n_prod)
        x = c.select("id", F.array_distinct(prods).alias("ps")).select("id", F.explode("ps").alias("product_id"))
        return x.select(F.col("id").alias("cart_id"), F.col("product_id").cast("bigint"),
                        (F.lit(1) + cid % 3).cast("int").alias("quantity"),
                        F.to_timestamp_ntz(F.lit("2001-07-31 00:00:00")).alias("added_at"))

    # -- benchmark-shaped samples (A13-A18) ---------------------------------------
    @cached_property
    def latency_samples(self) -> DataFrame:
        e = self._t("events").select("event_id", "ts", "user_id", "event_type", "value")
        return e.select(
            F.col("event_type").alias("scenario"),
            pick(["product page", "order history", "checkout"], F.col("user_id") % 3).alias("operation"),
            F.col("ts").alias("ts"),
            F.col("value").alias("latency_ms"),
            (F.col("event_type") != "error").alias("ok"),
            "event_id",
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


class StoreWrittenOnce(Store):
    """A store for jobs that read most of its tables, some more than once: those that others are derived from by joins and
    groups are written when first read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._kept: dict[str, DataFrame] = {}
        self._lock = RLock()  # tables are read from several threads

    def _once(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._kept:
                self._kept[name] = written(Store.__dict__[name].func(self), f"store-{name.strip('_')}")
            return self._kept[name]

    @property
    def orders(self) -> DataFrame:
        return self._once("orders")

    @property
    def _lines(self) -> DataFrame:
        return self._once("_lines")

    @property
    def returns(self) -> DataFrame:
        return self._once("returns")

    @property
    def reviews(self) -> DataFrame:
        return self._once("reviews")


STORE_TABLES = (
    "currencies countries fx_rates employees customers addresses categories brands products product_prices "
    "suppliers product_suppliers warehouses inventory promotions promotion_products orders order_items "
    "shipments payments returns reviews carts cart_items"
).split()

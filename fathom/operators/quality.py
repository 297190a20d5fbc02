"""Data-quality checks and result reconciliation.

All checks are aggregates or anti/semi joins: nothing is collected except the
final (small) violation counts, and row-level differences stay DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_fk(child: DataFrame, parent: DataFrame, child_keys: list[str], parent_keys: list[str]) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join)."""
    c = child.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in child_keys]))
    p = parent.select(*[F.col(pk).alias(ck) for ck, pk in zip(child_keys, parent_keys)])  # an anti join does not mind repeats
    return c.join(p, child_keys, "left_anti")


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: (rule, violations) where a rule is false (NULL counts as passing)."""
    names = list(rules)
    agg = df.agg(*[F.count_if(~F.coalesce(rules[n], F.lit(True))).cast("bigint").alias(f"_r{i}")
                   for i, n in enumerate(names)])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").alias("violations"))
                                          for i, n in enumerate(names)])).alias("x")).select("x.rule", "x.violations")


def normalize(df: DataFrame, decimals: int = 2, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Comparable cells: integers as long, decimals/doubles rounded, timestamps as text with a
    zero time part trimmed, booleans as 0/1, arrays joined with ','. Drops ``ignore`` columns."""
    out = []
    for f in df.schema.fields:
        if f.name in ignore:
            continue
        c, t = F.col(f.name), f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), decimals)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            s = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
            c = F.regexp_replace(s, " 00:00:00$", "")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.BooleanType):
            c = c.cast("int").cast("bigint")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(t, T.StringType):
            c = F.trim(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def compare_tables(name: str, a: DataFrame, b: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Row-by-row comparison ignoring surrogate keys: counts and EXCEPT ALL both ways."""
    cols = [c for c in a.columns if c not in ignore]
    na, nb = a.select(*cols), b.select(*cols)
    only_a = na.exceptAll(nb)
    only_b = nb.exceptAll(na)
    stats = [na.agg(F.count(F.lit(1)).alias("v")).select(F.lit("rows_a").alias("k"), "v"),
             nb.agg(F.count(F.lit(1)).alias("v")).select(F.lit("rows_b").alias("k"), "v"),
             only_a.agg(F.count(F.lit(1)).alias("v")).select(F.lit("only_a").alias("k"), "v"),
             only_b.agg(F.count(F.lit(1)).alias("v")).select(F.lit("only_b").alias("k"), "v")]
    u = reduce(DataFrame.unionByName, stats)
    return u.groupBy().pivot("k", ["rows_a", "rows_b", "only_a", "only_b"]).agg(F.first("v")).select(
        F.lit(name).alias("table"), "rows_a", "rows_b", "only_a", "only_b")


def compare_warehouses(a: dict[str, DataFrame], b: dict[str, DataFrame],
                       ignore: tuple[str, ...] = ("product_key",)) -> DataFrame:
    """C1 over every table present in both: table, rows_a, rows_b, only_a, only_b."""
    parts = [compare_tables(n, a[n], b[n], ignore) for n in a if n in b]
    return reduce(DataFrame.unionByName, parts)


def same_result(a: DataFrame, b: DataFrame, order: list[str]) -> DataFrame:
    """C4: rows_a, rows_b, missing_columns, differing_cells of two results.

    Rows are paired by their position in ``order``. Numbers agree within max(0.011, 1e-6 * max(|a|, |b|)); all
    other cells agree when their normalized texts do (null with null only)."""
    from .keys import dense_key
    shared = [c for c in a.columns if c in b.columns]
    missing = len(set(a.columns) ^ set(b.columns))
    ka, kb = dense_key(a.select(*shared), order, "_pos").alias("a"), dense_key(b.select(*shared), order, "_pos").alias("b")
    numeric = {f.name for f in a.schema.fields if isinstance(f.dataType, T.NumericType)}
    bad = []
    for c in shared:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        if c in numeric:
            x, y = x.cast("double"), y.cast("double")
            tol = F.greatest(F.lit(0.011), F.lit(1e-6) * F.greatest(F.abs(x), F.abs(y)))
            differ = (x.isNull() != y.isNull()) | (F.abs(x - y) > tol)
        else:
            differ = ~x.cast("string").eqNullSafe(y.cast("string"))
        bad.append(F.coalesce(differ, F.lit(False)).cast("int"))
    j = ka.join(kb, "_pos", "full")
    both = F.col("a._pos").isNotNull() & F.col("b._pos").isNotNull()
    return j.agg(F.count("a._pos").alias("rows_a"), F.count("b._pos").alias("rows_b"), F.lit(missing).cast("bigint").alias("missing_columns"),
                 F.coalesce(F.sum(F.when(both, reduce(lambda u, v: u + v, bad)).otherwise(len(shared))), F.lit(0)).cast("bigint").alias("differing_cells"))

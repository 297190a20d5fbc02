"""Exact order statistics per group without putting a group in one task.

``percentile``/``median`` aggregates and ``row_number() OVER (PARTITION BY g
ORDER BY v)`` both funnel a whole group through one task; with one hot group
(a third of the rows) that task holds a third of the data.

``order_values`` takes the values at a few ranks by counting: equal values are
counted before the shuffle, counts per cell of a fixed grid say which cells hold
the wanted ranks, and only the values of those cells are put in order.
``rows_at_ranks`` does the same for rows with a tie-breaker. Nothing is sorted
as a whole; one pass over the rows serves all ranks of a question, and only
their different values with counts are written.

``group_rank`` numbers every row: it range-partitions on (group, value), so a hot
group is cut into many partitions, each partition counts its slice of every
group, and a small table of per-(partition, group) counts gives every slice its
offset. Everything is exact.

Latency helpers (A13-A18): nearest-rank percentiles, the order-statistics
confidence interval of p99, medians of runs and a log-spaced histogram.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written

_BITS = 33


def _eq(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in cols])


def group_rank(df: DataFrame, groups: list[str], order: list[str | Column], name: str = "rank",
               count_name: str | None = "_n", num_partitions: int | None = None) -> DataFrame:
    """1-based rank of every row inside its group by ``order`` (ties broken by position),
    plus the group size in ``count_name``."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in groups] + [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # written once, so that counts and rows share one numbering whatever happens to an executor
    t = written(ranged.withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    t = t.withColumn("_pid", F.shiftright("_mid", _BITS)).withColumn("_loc", F.col("_mid").bitwiseAND((1 << _BITS) - 1))
    seg = t.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_c"), F.min("_loc").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select("_pid", *groups, "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                     F.sum("_c").over(Window.partitionBy(*groups)).alias("_gn"))
    s = seg.alias("s")
    j = t.alias("t").join(s, _eq(t.alias("t"), s, ["_pid", *groups]))
    cols = [F.col(f"t.{c}") for c in df.columns]
    extra = [(F.col("s._off") + F.col("t._loc") - F.col("s._first") + 1).cast("bigint").alias(name)]
    if count_name:
        extra.append(F.col("s._gn").cast("bigint").alias(count_name))
    return j.select(*cols, *extra)


# -- values at ranks, by counting ---------------------------------------------------------------
#: Cells of the counting grid between one power of two and the next.
GRID = 4096


def grid_cell(value: Column) -> Column:
    """A whole number that never falls as ``value`` grows (NaN last): cells a 4096th of an octave wide, on either side of zero."""
    d = value.cast("double")
    step = F.floor(F.least(F.log2(F.abs(d)), F.lit(2000.0)) * GRID).cast("bigint") + F.lit(2000 * GRID)
    return F.when(F.isnan(d), F.lit(1 << 62)).when(d == 0, F.lit(0).cast("bigint")).otherwise(F.when(d < 0, -step).otherwise(step))


def _counted(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Different values of each group with their numbers of rows (_c); written, since they are read twice and the rows only once."""
    return written(df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c")), "counted")


def _rank_cells(counts: DataFrame, groups: list[str], value: str, ranks: Column) -> DataFrame:
    """Of ``counts`` (groups, value, _c) the rows that hold one of the wanted ``ranks`` (an array made from _n, the group's size).

    Counts per grid cell say which cells hold a wanted rank; only their values are put in order. A window holds the
    cells of one group, or the values of one cell: no group meets in a task. Adds _n, and
    _lo and _hi: the row has the ranks above _lo up to _hi.
    """
    cells = counts.withColumn("_cell", grid_cell(F.col(value)))
    per = cells.groupBy(*groups, "_cell").agg(F.sum("_c").alias("_cc"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*groups, "_cell", "_cc", F.coalesce(F.sum("_cc").over(before), F.lit(0)).alias("_base"), F.sum("_cc").over(whole).alias("_n"))
    hit = per.where(F.exists(ranks, lambda r: (r > F.col("_base")) & (r <= F.col("_base") + F.col("_cc"))))
    h, c = hit.select(*groups, "_cell", "_base", "_n").alias("h"), cells.alias("c")
    near = c.join(h, _eq(c, h, [*groups, "_cell"])).select("c.*", "h._base", "h._n")
    inside = Window.partitionBy(*groups, "_cell").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_hi", F.col("_base") + F.sum("_c").over(inside)).withColumn("_lo", F.col("_hi") - F.col("_c"))
    return near.where(F.exists(ranks, lambda r: (r > F.col("_lo")) & (r <= F.col("_hi")))).drop("_cell", "_base")


def order_values(df: DataFrame, groups: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """Per group its size ``_n`` and, by name, the value at each rank (an expression of ``_n``); null values are not counted.

    Equal values are counted before the shuffle, so a hot group arrives as its different values."""
    counts = _counted(df.select(*groups, value), groups, value)
    wanted = {k: r.cast("bigint") for k, r in ranks.items()}
    near = _rank_cells(counts, groups, value, F.array(*wanted.values()))
    at = [F.max(F.when((r > F.col("_lo")) & (r <= F.col("_hi")), F.col(value))).alias(k) for k, r in wanted.items()]
    return near.groupBy(*groups).agg(F.max("_n").alias("_n"), *at)


def rows_at_ranks(df: DataFrame, groups: list[str], value: str, tie: str, ranks: Column) -> DataFrame:
    """(groups, value, tie, _rank) of the rows at the wanted ranks (an array made from _n) in the order (value, tie) of each group.

    First the values that hold the ranks, then, among the rows that share such a value (they may be most of the
    group), the ties: both by ``_rank_cells``. ``tie`` is a number that tells the rows of a group apart."""
    rows = df.select(*groups, value, tie).where(F.col(value).isNotNull())
    counts = _counted(rows, groups, value)
    held = _rank_cells(counts, groups, value, ranks)
    mine = F.filter(ranks, lambda r: (r > F.col("_lo")) & (r <= F.col("_hi")))
    held = held.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col(value).alias("_held"), "_lo", mine.alias("_ranks"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)], F.col(value) == F.col("_held"))
    tied = rows.join(held, same).select(*groups, value, tie, "_ranks", F.col("_lo").alias("_skip"), F.lit(1).cast("bigint").alias("_c"))
    found = _rank_cells(tied, [*groups, value, "_ranks", "_skip"], tie, F.transform("_ranks", lambda r: r - F.col("_skip")))
    return found.select(*groups, value, tie, (F.col("_skip") + F.col("_hi")).alias("_rank"))


def exact_percentiles(df: DataFrame, groups: list[str], value: str, qs: dict[str, float],
                      method: str = "cont", count_name: str | None = None) -> DataFrame:
    """One row per group with a column per named quantile.

    ``cont``: linear interpolation between the order statistics around (n-1)q+1.
    ``disc``: nearest rank, the ceil(q n)-th value (at least the first).
    """
    n = F.col("_n")
    place = {k: (n - 1) * F.lit(q) + 1 for k, q in qs.items()}
    if method == "cont":
        ranks = {f"_{side}{i}": cut(place[k]) for i, k in enumerate(qs) for side, cut in (("lo", F.floor), ("hi", F.ceil))}
    else:
        ranks = {f"_lo{i}": _nearest(q) for i, q in enumerate(qs.values())}
    found = order_values(df, groups, value, ranks)
    out = []
    for i, k in enumerate(qs):
        low = F.col(f"_lo{i}").cast("double")
        if method == "cont":
            low = low + (place[k] - F.floor(place[k])) * (F.col(f"_hi{i}").cast("double") - low)
        out.append(low.alias(k))
    if count_name:
        out.append(n.cast("bigint").alias(count_name))
    return found.select(*groups, *out)


def _nearest(q: float) -> Column:
    return F.greatest(F.least(F.ceil(F.col("_n") * F.lit(q)), F.col("_n")), F.lit(1))


# -- latency statistics ------------------------------------------------------------------
_NEAREST = {"p50": 0.50, "p95": 0.95, "p99": 0.99, "p999": 0.999, "p9999": 0.9999}


def _interval(q: float) -> dict[str, Column]:
    """Ranks n q -/+ 1.96 sqrt(n q (1-q)), rounded half to even, clamped."""
    n = F.col("_n")
    spread = 1.96 * F.sqrt(n * q * (1 - q))
    clamp = lambda r: F.least(F.greatest(F.bround(r, 0), F.lit(1)), n)
    return {"p99_low": clamp(n * q - spread), "p99_high": clamp(n * q + spread)}


def latency_stats(df: DataFrame, keys: list[str], ms: str, ok: str, ts: str) -> DataFrame:
    """Per group: done, failed, per_second, nearest-rank p50/p95/p99/p99.9/p99.99, max,
    the 95% interval of p99 from order statistics, and samples above p99.99."""
    base = df.groupBy(*keys).agg(
        F.count_if(F.col(ok)).cast("bigint").alias("done"), F.count_if(~F.col(ok)).cast("bigint").alias("failed"),
        F.max(F.when(F.col(ok), F.col(ms))).alias("max"),
        ((F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1e6)
        .alias("seconds"))
    # all quantiles and both ends of the interval in one go
    ranks = order_values(df.where(F.col(ok)), keys, ms, {**{k: _nearest(q) for k, q in _NEAREST.items()}, **_interval(0.99)}).drop("_n")
    ranks = ranks.withColumns({k: F.col(k).cast("double") for k in _NEAREST})
    j = base.join(ranks, keys, "left")
    return j.select(*keys, "done", "failed",
                    F.when(F.col("seconds") > 0, F.col("done") / F.col("seconds")).alias("per_second"),
                    "p50", "p95", "p99", "p999", "p9999", "max", "p99_low", "p99_high",
                    F.floor(F.col("done") * 0.0001).cast("bigint").alias("above_p9999"),
                    (F.floor(F.col("done") * 0.0001) >= 10).alias("p9999_supported"))


def p99_interval(df: DataFrame, keys: list[str], ms: str, q: float = 0.99) -> DataFrame:
    """The 95% interval of p99 by order statistics."""
    return order_values(df, keys, ms, _interval(q)).drop("_n")


def run_medians(df: DataFrame, keys: list[str], ms: str) -> DataFrame:
    """Median of runs: lower median ((n-1) div 2 + 1-th, the faster middle run), upper
    median (n div 2 + 1-th), min, max, runs."""
    n = F.col("_n")
    found = order_values(df, keys, ms, {"median_ms": F.floor((n - 1) / 2) + 1, "upper_median_ms": F.floor(n / 2) + 1,
                                        "min_ms": F.lit(1), "max_ms": n})
    return found.select(*keys, n.cast("bigint").alias("runs"), "median_ms", "upper_median_ms", "min_ms", "max_ms")


def log_histogram(df: DataFrame, ms: str, keys: list[str], buckets: int = 38, low: float = 0.05) -> DataFrame:
    """Counts on log-spaced buckets between max(min positive, low) and the max value.

    The two bounds are one small aggregate, then every row gets its bucket by a
    column expression and the counts are a grouped aggregate.
    """
    pos = df.where(F.col(ms) > 0)
    b = pos.agg(F.min(ms).alias("lo"), F.max(ms).alias("hi")).first()
    if b is None or b["lo"] is None:
        return pos.select(*keys, F.lit(0).alias("bucket"), F.lit(0.0).alias("lower_ms"),
                          F.lit(0).cast("bigint").alias("samples")).limit(0)
    lo, hi = max(b["lo"], low), b["hi"]
    llo, span = math.log10(lo), (math.log10(hi) - math.log10(lo)) or 1.0
    idx = F.least(F.lit(buckets - 1), F.floor((F.log10(F.greatest(F.col(ms), F.lit(lo))) - llo) / span * buckets))
    g = pos.groupBy(*keys, idx.cast("int").alias("bucket")).agg(F.count(F.lit(1)).cast("bigint").alias("samples"))
    return g.withColumn("lower_ms", F.pow(F.lit(10.0), F.lit(llo) + F.lit(span) * F.col("bucket") / buckets))

"""Sample statistics of measured runs.

The samples are the driver's ``events`` read as load-test samples
(scenario, operation, latency, ok); every statistic is exact and computed
with distributed ranks (see ``operators.stats``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dround
from ..operators.stats import latency_stats, log_histogram, rows_at_ranks, run_medians
from ..session import shared_scratch
from .warehouse import Warehouse

KEYS = ["scenario", "operation"]


def _samples(wh: Warehouse) -> DataFrame:
    return wh.store.latency_samples


def a13_run_medians(wh: Warehouse) -> DataFrame:
    return run_medians(_samples(wh), KEYS, "latency_ms")


def a14_lower_median_run(wh: Warehouse) -> DataFrame:
    s = _samples(wh).select(*KEYS, "event_id", "latency_ms", "ok")
    middle = rows_at_ranks(s, KEYS, "latency_ms", "event_id", F.array((F.floor((F.col("_n") - 1) / 2) + 1).cast("bigint")))
    return s.join(middle.select(*KEYS, "event_id"), [*KEYS, "event_id"])


def a15_latency_stats(wh: Warehouse) -> DataFrame:
    st = latency_stats(_samples(wh), KEYS, "latency_ms", "ok", "ts")
    return st.withColumn("per_second", dround("per_second", 6))


ROUNDS = 3


def a17_pooled_rounds(wh: Warehouse) -> DataFrame:
    """All rounds of a scenario pooled: percentiles over every sample, throughput over the seconds measured in each round."""
    s = _samples(wh).withColumn("round", (F.col("event_id") % ROUNDS).cast("int") + 1)
    micros = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    spent = s.groupBy("scenario", "round").agg((micros / 1e6).alias("s")).groupBy("scenario").agg(
        F.count(F.lit(1)).cast("int").alias("rounds"), F.sum("s").alias("seconds"))
    st = latency_stats(s, ["scenario"], "latency_ms", "ok", "ts").select("scenario", "done", "failed", "p50", "p95", "p99", "max")
    j = st.join(spent, "scenario")
    return j.select("scenario", "rounds", "done", "failed", dround(F.try_divide("done", "seconds"), 6).alias("per_second"),
                    "p50", "p95", "p99", "max")


def a18_log_histogram(wh: Warehouse) -> DataFrame:
    return log_histogram(_samples(wh), "latency_ms", ["scenario"]).select("scenario", "bucket", "samples")


def k10_run_analysis(wh: Warehouse, scratch: str | None = None) -> DataFrame:
    """Write the runs as CSV (header), read them back with a declared schema, then medians per
    (scenario, operation) and the speed-up of every operation against 'checkout' (A28)."""
    spark = wh.spark
    folder = scratch or shared_scratch(spark, "runs")
    path = os.path.join(folder, "runs_csv")
    _samples(wh).select(*KEYS, "event_id", "latency_ms").write.mode("overwrite").option("header", True).csv(path)
    runs = spark.read.schema("scenario string, operation string, event_id long, latency_ms double") \
        .option("header", True).csv(path)
    med = run_medians(runs, KEYS, "latency_ms").select(*KEYS, "median_ms")
    base = med.where(F.col("operation") == "checkout").select("scenario", F.col("median_ms").alias("base_ms"))
    j = med.join(base, "scenario", "left")
    return j.select(*KEYS, "median_ms", dround(F.try_divide(F.col("base_ms"), F.col("median_ms")), 4).alias("speedup"))


ANALYSIS = {
    "a13_run_medians": a13_run_medians,
    "a14_lower_median_run": a14_lower_median_run,
    "a15_latency_stats": a15_latency_stats,
    "a17_pooled_rounds": a17_pooled_rounds,
    "a18_log_histogram": a18_log_histogram,
    "k10_run_analysis": k10_run_analysis,
}

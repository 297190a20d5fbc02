"""Plan assertions: the physical plans are the ones we want at scale."""

import tempfile

from pyspark.sql import functions as F

from fathom import catalog
from fathom.operators.topk import top_k

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_or_python_udf(spark):
    for name, fn in catalog.QUERIES.items():
        if name.startswith("t0"):  # streaming jobs run their query while building the result
            continue
        plan = _plan(fn(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, (name, bad)


def test_partition_pruning_and_pushdown(spark, wh):
    root = tempfile.mkdtemp(prefix="fathom-plan-", dir="/tmp")
    fs = wh.fact_sales.withColumn("year", F.year("order_date")).withColumn("month", F.month("order_date"))
    fs.write.partitionBy("year", "month").parquet(f"{root}/fact_sales")
    q = spark.read.parquet(f"{root}/fact_sales").where("year = 2000 AND month IN (1, 2)").select("order_id", "net_usd")
    text = _plan(q)
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<order_id:bigint,net_usd" in text
    wh.raw("orders").write.parquet(f"{root}/orders")
    o = spark.read.parquet(f"{root}/orders").where(F.col("id") <= F.lit(1000)).select("id")
    assert "LessThanOrEqual(id,1000)" in _plan(o)


def test_star_questions_prune_months(spark):
    """On a published star only the months of the answer are listed and read."""
    from fathom.plans import questions as Q
    from fathom.plans.publish import PublishedWarehouse, build_full
    root = tempfile.mkdtemp(prefix="fathom-plan-", dir="/tmp")
    build_full(spark, SF, root)
    pub = PublishedWarehouse.open(spark, root)
    months = len({f.rsplit("/", 1)[0] for f in pub.fact_sales.inputFiles()})
    for fn, most in ((Q.q14_star, 1), (Q.q07_star, 4), (Q.q06_star, 13), (Q.q10_star, 13), (Q.q12_star, 26)):
        assert "* 12) + month#" in _plan(fn(pub)), fn.__name__
        assert most < months


def test_summary_scans_once(spark, wh):
    from fathom.sources.files import summarize
    assert _plan(summarize(spark.read.parquet(f"{SF}/customer.parquet"))).count("FileScan") <= 2  # one plan, shown before and after re-planning


def test_top_k_uses_window_group_limit(spark, wh):
    t = top_k(wh.raw("order_items"), ["product_id"], [F.col("quantity").desc(), F.col("order_id")], 3)
    assert "WindowGroupLimit" in _plan(t)

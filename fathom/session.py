"""Spark session settings shared by jobs, tests and the bench.

Every job assumes UTC: zoned times become dates by cutting at midnight UTC.
AQE stays on so joins of small derived dimensions turn into broadcast joins
only after their real size is measured (adaptive.autoBroadcastJoinThreshold), and
skewed sort-merge partitions are split at run time. Sizes estimated from files are
not trusted: a well compressed or exploded table is many times its estimate, and a
broadcast is held whole by the driver and by every executor.
Shuffles begin with at least ``LEAST_PARTITIONS`` partitions, which AQE joins where they are small.
"""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Partitions that a shuffle of the queries begins with, at least: a task then sorts a small share of a large table.
LEAST_PARTITIONS = 240


def build_session(master: str | None = None, cpus: int | None = None, app: str = "fathom",
                  extra: dict | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or f"local[{cpus}]")
    conf = dict(BASE_CONF)
    conf.setdefault("spark.sql.shuffle.partitions", str(cpus))
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime (SQL) settings to a session someone else built."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass
    begin = max(LEAST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(begin))
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster it is set by the operator and we only read it. Only on a local
    master (tests) do we make our own scratch folder where it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = sc.getConf().get("spark.checkpoint.dir", None)
        if not current:
            if not re.match(r"local(\[[^\]]*\])?$", sc.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            current = tempfile.mkdtemp(prefix="fathom-ckpt-", dir="/tmp")
        sc.setCheckpointDir(current)
    return current


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate writes, inside the shared checkpoint folder.

    Executors on any machine can read it back, unlike a machine-local temporary folder.
    """
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: Spark's own setting: shuffle files go as soon as the statement that wrote them has ended, not when the driver happens to collect its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: For loads: no generated method is larger than what HotSpot compiles; the exact money of the facts would be interpreted.
LOAD_CONF = SHUFFLES_GO | {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Settings for the statements begun in here; none of these changes a result."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: one numbering for all its readers, safe from lost executors."""
    spark = df.sparkSession
    path = shared_scratch(spark, name)
    with settings(spark, SHUFFLES_GO):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

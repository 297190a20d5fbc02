"""Readers for the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; callers project columns so Catalyst prunes the read schema."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

"""File-level sources and metadata.

* ``file_rows``: row provenance (which file each row came from) via ``_metadata``.
* ``file_ranges``: least and greatest value, nulls and rows of every column by
  file, as an aggregate over the scan (any path that Spark reads).
* ``size_report``: bytes and files per table folder from the same listing.
* ``summarize``: per-column min/max/approx distinct/avg/std/quartiles/count/null %
  in one aggregate pass, then unpivoted.
* ``max_text_lengths``: longest value of every string column in one pass.
* ``describe``: schema as rows; ``catalog_listing``: tables with rows and columns.
* ``csv_round_trip``: CSV with header out, read back with inferred types.
* ``copy_tables`` / ``verify_counts``: copy chosen tables to another store and
  check the row counts (C3).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def list_files(spark: SparkSession, root: str, glob: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of the files under ``root``; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(root).drop("content"))


def file_ranges(df: DataFrame) -> DataFrame:
    """file, column, min, max, null_count, rows of every plain column of every file that ``df`` reads: one aggregate by file."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    rows = df.select(*plain, F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("_file"))
    aggs = [a for i, c in enumerate(plain) for a in (F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
                                                    F.count_if(F.col(f"`{c}`").isNull()).alias(f"no{i}"))]
    per = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), *aggs)
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"), F.col(f"no{i}").alias("null_count"))
                     for i, c in enumerate(plain)])
    return per.select(F.col("_file").alias("file"), F.explode(each).alias("x"), "rows").select("file", "x.*", "rows")


def size_report(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    f = list_files(spark, root, glob)
    name = F.regexp_extract("path", r"([^/]+?)(\.parquet)?$", 1)
    return f.groupBy(name.alias("table_name")).agg(F.count(F.lit(1)).cast("bigint").alias("files"),
                                                   F.sum("length").cast("bigint").alias("bytes"))


def file_rows(df: DataFrame) -> DataFrame:
    """Rows per source file (provenance from the hidden ``_metadata`` column)."""
    return df.select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file_name")) \
        .groupBy("file_name").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


def summarize(df: DataFrame) -> DataFrame:
    """column, type, min, max, approx_unique, avg, std, q25, q50, q75, count, null_pct."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    aggs, fields = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        simple = isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
                                         T.BooleanType) + numeric)
        if not simple:
            continue
        fields.append((i, f))
        is_num = isinstance(f.dataType, numeric)
        aggs += [F.min(c).cast("string").alias(f"mn{i}"), F.max(c).cast("string").alias(f"mx{i}"),
                 F.approx_count_distinct(c).alias(f"ad{i}"),
                 (F.avg(c) if is_num else F.lit(None)).cast("double").alias(f"av{i}"),
                 (F.stddev(c) if is_num else F.lit(None)).cast("double").alias(f"sd{i}"),
                 (F.percentile_approx(c.cast("double"), [0.25, 0.5, 0.75]) if is_num
                  else F.lit(None).cast("array<double>")).alias(f"q{i}"),
                 F.count(c).alias(f"ct{i}"), F.count(F.lit(1)).alias(f"n{i}")]
    def entry(i: int, f: T.StructField):
        missing = F.round((F.col(f"n{i}") - F.col(f"ct{i}")) * 100.0 / F.col(f"n{i}"), 2)
        return F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"),
                        F.col(f"mn{i}").alias("min"), F.col(f"mx{i}").alias("max"), F.col(f"ad{i}").alias("approx_unique"),
                        F.col(f"av{i}").alias("avg"), F.col(f"sd{i}").alias("std"), F.col(f"q{i}")[0].alias("q25"),
                        F.col(f"q{i}")[1].alias("q50"), F.col(f"q{i}")[2].alias("q75"), F.col(f"ct{i}").alias("count"), missing.alias("null_pct"))
    # one row over the whole table, exploded: one scan however many columns
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[entry(i, f) for i, f in fields])).alias("x")).select("x.*")


def max_text_lengths(df: DataFrame) -> DataFrame:
    """Longest value of every string column (to size exported columns), in one pass."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    row = df.agg(*[F.max(F.length(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                    F.col(f"_{i}").cast("bigint").alias("max_len"))
                                          for i, c in enumerate(cols)])).alias("x")).select("x.*")


def describe(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields],
                                 "column_name string, column_type string, nullable boolean")


def catalog_listing(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Register the tables as temp views and list them with row and column counts."""
    parts = []
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
        parts.append(spark.table(name).agg(F.count(F.lit(1)).cast("bigint").alias("estimated_rows")).select(
            F.lit(name).alias("table_name"), "estimated_rows", F.lit(len(df.columns)).cast("bigint").alias("columns")))
    listed = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert set(tables) <= listed
    return reduce(DataFrame.unionByName, parts)


def csv_round_trip(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.option("header", True).option("inferSchema", True).csv(path)


def copy_tables(tables: dict[str, DataFrame], target: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/{name}")


def verify_counts(spark: SparkSession, tables: dict[str, DataFrame], target: str) -> DataFrame:
    """Source rows vs copied rows per table."""
    parts = []
    for n, df in tables.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("v")).select(F.lit(n).alias("table_name"),
                                                                 F.lit("source_rows").alias("side"), "v"))
        parts.append(spark.read.parquet(f"{target}/{n}").agg(F.count(F.lit(1)).alias("v")).select(
            F.lit(n).alias("table_name"), F.lit("target_rows").alias("side"), "v"))
    u = reduce(DataFrame.unionByName, parts)
    p = u.groupBy("table_name").pivot("side", ["source_rows", "target_rows"]).agg(F.first("v"))
    return p.withColumn("ok", F.col("source_rows") == F.col("target_rows"))

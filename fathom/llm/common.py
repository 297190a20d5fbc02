"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_scratch
from ..sources.driver import read_table

#: Words are runs of anything but a blank or the ASCII controls tab to carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def whole_text(col: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


#: Whole texts are large rows: so many of them travel to Python at once.
TEXTS_PER_BATCH = 1000


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``TEXTS_PER_BATCH`` rows (at most what the session asks for)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key, "10000")) <= TEXTS_PER_BATCH:
        conf.set(key, str(TEXTS_PER_BATCH))
    return df


@contextmanager
def few_rows_a_batch(spark: SparkSession, rows: int = TEXTS_PER_BATCH) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run inside; the session's setting comes back after them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, or the name with underscores before it if ``df`` has such a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_hash(col: str = "text") -> Column:
    """64 bits that, with doc_id, tell rows apart; null reads as empty."""
    return F.xxhash64(whole_text(col))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once a row, however often ``body`` names it (inside lambdas too)."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """Array of words of a text; an empty or blank text has none."""
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != F.lit(""))


#: Spark's own setting: shuffle files go as soon as the statement that wrote them has ended.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Narrow rows (a few numbers each) of one file, where their number is known.
ROWS_PER_FILE = 500_000


def materialize(df: DataFrame, name: str, narrow_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost executors.

    The write's shuffle files are no longer needed once it has committed, so they are let go at once.
    ``narrow_rows``, a bound of the number of rows of a few numbers each, keeps small tables from many files.
    """
    spark = df.sparkSession
    if narrow_rows is not None:
        df = df.coalesce(max(8, -(-narrow_rows // ROWS_PER_FILE)))
    path = shared_scratch(spark, name)
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, name).select(*cols)

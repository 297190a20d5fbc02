"""Labelled rows for the classifiers: a fixed fold and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the doc_id's text leaves no remainder by ``FOLDS``; such labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int, each: bool = False) -> DataFrame:
    """(text, y) of at most ``limit`` labelled rows outside the held-out fold; with ``each``, at most half of them of either class.

    The rows with the least hash of doc_id are taken, so the choice depends on
    the ids alone; ``limit`` bounds what is broadcast. A doc_id with several
    labels counts with its highest one; null labels and ids are not learned from.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    first = lambda rows, n: rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = first(known.where("y = 0"), limit // 2).union(first(known.where("y = 1"), limit // 2)) if each else first(known, limit)
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "y")

"""Corpus pipeline: quality, near-duplicates, repeated passages, benchmark passages, packing.

Each stage works on all that its predecessor kept; between stages the rows are
written as Parquet to the cluster's shared folder and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm import crf, decontam, neardup, packing, substring
from fathom.llm.common import fresh, materialize, table
from fathom.llm.queries import QUALITY_THRESHOLD


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the line CRF scores below the threshold go."""
    model = crf.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    name, = fresh(docs, "quality_score")
    return crf.score(docs, model, name).where(F.col(name) >= QUALITY_THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group of near copies stays, the one with the least doc_id."""
    return neardup.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: words of repeated windows go; a text that loses none stays as it is, one that loses all goes."""
    prefix = fresh(docs, "cut_kept", "cut_n_removed")[0].removesuffix("kept")
    cut = substring.drop_repeats(docs, prefix=prefix)
    changed, kept = F.col(f"{prefix}n_removed") > 0, F.col(f"{prefix}kept")
    cut = cut.where(~changed | (kept != ""))
    return cut.withColumn("text", F.when(changed, kept).otherwise(F.col("text"))).withColumn(
        "n_chars", F.when(changed, F.length(kept).cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark passage go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: what is left, packed into windows."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: A trained model, XXH64 fingerprints and a tokenizer are beyond SQL: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: five stages, each written as Parquet and read by the next.

Toxic documents go, then documents of low quality, then lines that recur across
documents, then near copies but one of each group; what is left is packed.
Every stage but the last returns the columns it was given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicetide.llm import base, line_templates, packing, prob_minhash, quality, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, base.table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_clean(docs)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # names that no given column has, so that all of these keep their values
    counts = base.free_name(docs, "n_lines"), base.free_name(docs, "n_dropped")
    cleaned = line_templates.dedup(docs, counts)
    shorter = F.when(F.col(counts[1]) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", shorter.cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return prob_minhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]
#: Model fits, sketches and tokenising have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = base.written(stage(spark, docs, sf_dir), name)
    return docs

"""A training-data pipeline of five operators; each stage works on all that the one before kept.

Every stage but the last returns the columns of its documents.  Toxic documents go, repeated lines go except in the
last document that holds them, one document of each near-duplicate group stays (the smallest id), documents that hold a
benchmark item go, and what is left is encoded and decoded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.bpe import encode_and_decode
from tallyline.llm.common import table
from tallyline.llm.decontaminate import without_leaks
from tallyline.llm.line_dedup import dedup_lines
from tallyline.llm.simhash import one_per_group
from tallyline.llm.toxicity import without_toxic
from tallyline.session import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The length column follows the new text."""
    kept = dedup_lines(docs).select(docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs, size=3, budget=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded)."""
    both = encode_and_decode(docs)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: A trained model, fingerprints and a tokenizer are not SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

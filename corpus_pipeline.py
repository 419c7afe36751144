"""From raw documents to packed training windows: each stage reads what its predecessor wrote and kept.

A stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane.llm import decontaminate, langid, lines, packing, simhash
from hostvane.llm.shared import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a known language; those without letters, or whose language is improbable, go."""
    return langid.in_known_language(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated chunks of lines and repeated passages of 50 words or more; a document that loses all its text that way
    goes, and n_chars is counted anew."""
    own = {c: f"own_{c}" for c in ("removed_chunks", "removed_chars") if c in docs.columns}
    left = lines.line_dedup(docs.withColumnsRenamed(own), with_passages=True)
    left = left.where((F.col("removed_chunks") == 0) | (F.trim(F.col("text"), F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("removed_chunks") > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return left.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near-duplicates, the one with the smallest doc_id."""
    return simhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or nearly, go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training windows."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Fingerprints, a trained model and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Every stage's result is written as Parquet in the shared folder, and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from addrloom.llm.exact_dedup import drop_exact_copies
from addrloom.llm.packing import packed_sequences
from addrloom.llm.quality_rules import keep_by_repetition
from addrloom.llm.rows import find_library
from addrloom.llm.secret_scan import redact_secrets
from addrloom.llm.simhash import keep_class_representatives
from addrloom.operators.staging import staging_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go, those with a null or empty text among them.

    This and the next three stages keep all columns, whatever their names; repeated rows are
    judged alike and a null in another column changes nothing. An empty table stays empty.
    """
    find_library(spark)
    return keep_by_repetition(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays, of rows that repeat it one.

    A null text equals an empty one; a null doc_id is smaller than any.
    """
    find_library(spark)
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id stays.

    Texts without words, null ones too, are one class. A null doc_id stays only if its class
    has no other; of rows that repeat the smallest one stays.
    """
    find_library(spark)
    return keep_class_representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars follows. No document goes.

    A null text stays null and an empty one empty.
    """
    find_library(spark)
    return redact_secrets(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences.

    A null or empty text is the end token alone; repeated rows and null ids are packed like
    any other. An empty table gives no piece.
    """
    find_library(spark)
    return packed_sequences(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# SimHash classes and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{staging_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = f"{folder}/{name}"
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs

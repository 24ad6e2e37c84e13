"""Parquet tables as inputs of the plans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from addrloom.plans.ngd import ALTERNATE_FEATURE_TYPES, CORE_PRIORITY, ROYAL_MAIL

FEATURE_STEMS = (*CORE_PRIORITY, *ALTERNATE_FEATURE_TYPES, ROYAL_MAIL)


def read_table(spark: SparkSession, path: str, where: Column | str | None = None) -> DataFrame:
    """A Parquet table, or the part of it that a condition keeps."""
    table = spark.read.parquet(path)
    return table if where is None else table.where(where)


def read_features(
    spark: SparkSession, folder: str, stems: Iterable[str] = FEATURE_STEMS
) -> dict[str, DataFrame]:
    """The feature tables ``<stem>.parquet`` that a folder holds, by stem."""
    features = {}
    for stem in stems:
        try:
            features[stem] = read_table(spark, f"{folder}/{stem}.parquet")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return features

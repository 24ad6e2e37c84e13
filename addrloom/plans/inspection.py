"""Reports over a finished flatfile."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_COLUMNS = (
    "unique_id",
    "address_concat",
    "postcode",
    "source",
    "variant_label",
    "is_primary",
    "classification_code",
    "udprn",
)


def flatfile(spark: SparkSession, path: str) -> DataFrame:
    """All files of a written flatfile."""
    return spark.read.parquet(path)


def report_columns(df: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """The wanted columns that exist, or all of them if none does."""
    present = [name for name in wanted or REPORT_COLUMNS if name in df.columns]
    return df.select(*present) if present else df


def _matching(df: DataFrame, condition: Column | str | None) -> DataFrame:
    return df if condition is None else df.where(condition)


def variants_per_key(df: DataFrame) -> DataFrame:
    return df.groupBy("unique_id").agg(F.count("*").alias("variant_count"))


def variant_statistics(df: DataFrame) -> DataFrame:
    """One row of statistics on the number of variants per key; the median is exact.

    Keys are first counted per number of variants, so that the last step sees a
    histogram and not a row per key.
    """
    histogram = variants_per_key(df).groupBy("variant_count").agg(F.count("*").alias("keys"))
    size, keys = F.col("variant_count"), F.col("keys")
    return histogram.agg(
        F.coalesce(F.sum(keys), F.lit(0)).alias("total_uprns"),
        F.sum(size * keys).alias("total_variants"),
        (F.sum(size * keys) / F.sum(keys)).alias("mean_variants"),
        F.percentile(size, F.lit(0.5), keys).alias("median_variants"),
        F.min(size).alias("min_variants"),
        F.max(size).alias("max_variants"),
    )


def variant_summary(df: DataFrame) -> dict[str, float | int]:
    """The statistics as plain numbers: the mean to two places, the median cut to a whole number."""
    row = variant_statistics(df).first().asDict()
    mean = row.pop("mean_variants")
    summary = {name: int(value or 0) for name, value in row.items()}
    return summary | {"mean_variants": round(float(mean or 0), 2)}


def variant_uplift(df: DataFrame) -> DataFrame:
    """Keys, rows, and by how many percent the rows exceed the keys. NULL is not a key."""
    per_key = variants_per_key(df)
    uprns = F.count("unique_id")
    rows = F.coalesce(F.sum("variant_count"), F.lit(0))
    uplift = F.when(uprns > 0, (rows - uprns) / uprns * 100).otherwise(F.lit(0.0))
    return per_key.agg(
        uprns.alias("total_uprns"), rows.alias("total_rows"), uplift.alias("variant_uplift_pct")
    )


def top_keys(df: DataFrame, n: int = 100, condition: Column | str | None = None) -> DataFrame:
    """The ``n`` keys with the most variants."""
    counted = variants_per_key(_matching(df, condition))
    return counted.orderBy(F.desc("variant_count"), F.asc_nulls_last("unique_id")).limit(n)


def top_key_at_offset(df: DataFrame, offset: int = 0) -> DataFrame:
    """The key that comes after ``offset`` keys with more variants."""
    if offset < 0:
        raise ValueError("offset must be >= 0")
    counted = variants_per_key(df)
    ordered = counted.orderBy(F.desc("variant_count"), F.asc_nulls_last("unique_id"))
    return ordered.offset(offset).limit(1)


def _listing_order(df: DataFrame) -> list[Column]:
    order = {
        "is_primary": F.desc_nulls_last("is_primary"),
        "source": F.asc_nulls_last("source"),
        "variant_label": F.asc_nulls_last("variant_label"),
        "address_concat": F.asc_nulls_last("address_concat"),
    }
    return [key for name, key in order.items() if name in df.columns]


def _of_key(df: DataFrame, key: int | None) -> Column:
    """Whether a row has the key. Rows without a key are a group of their own."""
    kind = df.schema["unique_id"].dataType
    return F.col("unique_id").eqNullSafe(F.lit(key).cast(kind))


def key_variants(
    df: DataFrame,
    key: int | None,
    condition: Column | str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """All rows of one key, primary first, then by source, label and address."""
    rows = _matching(df.where(_of_key(df, key)), condition)
    return report_columns(rows.orderBy(*_listing_order(df)), columns)


def key_count(df: DataFrame, key: int | None, condition: Column | str | None = None) -> DataFrame:
    """How many variants a key has: ``unique_id`` and ``variant_count``, 0 for a key without rows.

    Only parts of a written flatfile whose Bloom filter may know the key are read.
    """
    kind = df.schema["unique_id"].dataType
    rows = _matching(df.where(_of_key(df, key)), condition)
    return rows.agg(F.lit(key).cast(kind).alias("unique_id"), F.count(F.lit(1)).alias("variant_count"))


def _picked(keys: DataFrame, seed: int | None) -> int | None:
    """The key whose place in the shuffled order is the first: a row per map task, no sort."""
    place = _shuffled(seed, "unique_id")
    row = keys.agg(F.min(F.struct(place.alias("place"), "unique_id")).alias("first")).first()
    if row["first"] is None:
        raise LookupError("no matching records in the flatfile")
    return row["first"]["unique_id"]


def _shuffled(seed: int | None, *columns: str) -> Column:
    """An order that looks random and follows from the seed and the values alone, not from
    where the rows lie."""
    seed = random.randrange(1 << 31) if seed is None else seed
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def random_key(df: DataFrame, seed: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """All rows of a key picked at random; the rows without a key count as one."""
    return key_variants(df, _picked(df, seed), columns=columns)


def random_large_key(
    df: DataFrame,
    top_n: int = 100,
    condition: Column | str | None = None,
    seed: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """The matching rows of a key picked at random among the ``top_n`` largest."""
    return key_variants(df, _picked(top_keys(df, top_n, condition), seed), condition, columns)


def sample_rows(df: DataFrame, n: int = 5, seed: int | None = None) -> DataFrame:
    """Some rows: the first ones found or, with a seed, the same ones for any layout."""
    if seed is None:
        return df.limit(n)
    given = [name for name in ("unique_id", "address_concat") if name in df.columns]
    return df.orderBy(_shuffled(seed, *given), *sorted(df.columns)).limit(n)


@dataclass(frozen=True)
class Inspection:
    selected_key: int | None
    variant_count: int
    sample_rows: DataFrame
    key_rows: DataFrame
    files: list[str]


def inspect_variants(
    df: DataFrame, key: int | None = None, offset: int = 0, sample_limit: int = 5, seed: int | None = None
) -> Inspection:
    """A sample, all rows of the given key or of the largest one after ``offset``, and the
    files read. The largest group may be that of the rows without a key."""
    if sample_limit < 1:
        raise ValueError("sample_limit must be >= 1")
    top = top_key_at_offset(df, offset)
    if key is None:
        row = top.first()
        if row is None:
            raise LookupError("no records in the flatfile")
        key, count = row["unique_id"], row["variant_count"]
    else:
        count = key_count(df, key).first()["variant_count"]
    rows = df.where(_of_key(df, key)).orderBy(*_listing_order(df))
    return Inspection(key, count, sample_rows(df, sample_limit, seed), rows, sorted(df.inputFiles()))

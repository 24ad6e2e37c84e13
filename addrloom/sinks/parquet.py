"""Parquet output of a flatfile and what was written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from addrloom.functions.ranks import chunk_of


# Set to false, a writer leaves its mark of success to ``mark_finished``.
MARKS_SUCCESS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


# Outputs are sorted by postcode, so that minima and maxima say nothing of their keys.
LOOKUP_COLUMN = "unique_id"


def parquet_writer(df: DataFrame, compression: str, compression_level: int) -> DataFrameWriter:
    """A writer of files that tell by Bloom filters which of their parts can hold a key."""
    writer = df.write.option("compression", compression).option(
        f"parquet.compression.codec.{compression}.level", compression_level
    )
    if LOOKUP_COLUMN in df.columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{LOOKUP_COLUMN}", "true")
        # Filters as large as a part's keys need, not of the greatest size.
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    return writer


def has_output(spark: SparkSession, path: str) -> bool:
    """Whether a finished output lies at the path: one whose writer left its mark of success.

    Files of a job that died before its end are no output. Trouble in looking, such as a
    missing right, is an error and not an absent output.
    """
    filesystem, mark = _mark_of(spark, path)
    return filesystem.exists(mark)


def mark_finished(spark: SparkSession, path: str) -> None:
    """Mark an output that was written without its mark as finished."""
    filesystem, mark = _mark_of(spark, path)
    filesystem.create(mark, True).close()


def _mark_of(spark: SparkSession, path: str, name: str = "_SUCCESS"):
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, name)
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()), mark


def _chunk_mark(chunk: int, chunks: int) -> str:
    """A chunk is finished as one of so many; readers pass by names with an underscore."""
    return f"_chunks/{chunk}-of-{chunks}"


def unfinished_chunks(spark: SparkSession, path: str, chunks: int) -> list[int]:
    """The chunks, counted from 1, that are not finished at the path."""
    found = []
    for chunk in range(1, chunks + 1):
        filesystem, mark = _mark_of(spark, path, _chunk_mark(chunk, chunks))
        if not filesystem.exists(mark):
            found.append(chunk)
    return found


def reopen_chunk(spark: SparkSession, path: str, chunk: int, chunks: int) -> None:
    """Take back that a chunk, and so the output, is finished; the next write replaces it."""
    for name in ("_SUCCESS", _chunk_mark(chunk, chunks)):
        filesystem, mark = _mark_of(spark, path, name)
        filesystem.delete(mark, False)


def sorted_output(df: DataFrame, first: list[str] | None = None) -> DataFrame:
    """Ordered by postcode and key, NULL last, over files and within each.

    The address is the last range key, so that one crowded key can still be cut into
    several ranges.
    """
    names = [*(first or []), "postcode", "unique_id", "address_concat"]
    order = [F.asc_nulls_last(name) for name in names]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_flatfile(
    df: DataFrame,
    path: str,
    chunks: int = 1,
    sort: bool = True,
    compression: str = "zstd",
    compression_level: int = 9,
    overwrite: bool = False,
    chunks_per_job: int | None = None,
) -> int | None:
    """Write a flatfile and return the rows written, counted as they are written.

    Returns None where one exists and ``overwrite`` is not set. With several chunks,
    rows of a key share a ``chunk=n`` folder, counted from 1. A chunk may hold several
    files; their union is the unchunked result.

    ``chunks_per_job`` chunks, by default all, are written by a job and marked as finished
    after it. If a later job fails, the next call writes only the chunks that are not finished
    and leaves the others as they are; the whole is marked after the last one. Chunks that were
    finished as parts of another number of chunks do not count: then all are written anew.
    """
    spark = df.sparkSession
    if not overwrite and has_output(spark, path):
        return None
    if chunks == 1:
        return _written(sorted_output(df) if sort else df, compression, compression_level, lambda w: w.mode("overwrite").parquet(path))

    df = df.selectExpr("*", f"{chunk_of('unique_id', chunks)} + 1 AS chunk")

    def rows_of(now: list[int]) -> DataFrame:
        return df if len(now) == chunks else df.where(F.col("chunk").isin(now))

    return write_chunks(spark, rows_of, path, chunks, sort, compression, compression_level, overwrite, chunks_per_job)


def write_chunks(
    spark: SparkSession,
    rows_of: Callable[[list[int]], DataFrame],
    path: str,
    chunks: int,
    sort: bool = True,
    compression: str = "zstd",
    compression_level: int = 9,
    overwrite: bool = False,
    chunks_per_job: int | None = None,
) -> int | None:
    """As ``write_flatfile`` for rows that are planned for the chunks of each job alone.

    ``rows_of`` gives the rows of some chunks, counted from 1, with their number as ``chunk``,
    so that a plan can read only what these chunks need. It is not asked for finished ones.
    """
    if not overwrite and has_output(spark, path):
        return None
    every = list(range(1, chunks + 1))
    missing = every if overwrite else unfinished_chunks(spark, path, chunks)
    fresh = missing == every
    at_once = chunks_per_job or len(every)
    rows = 0
    for first in range(0, len(missing), at_once):
        now = missing[first : first + at_once]
        # Without a sort files get an even size: small parts of a chunk are put together, large ones split.
        part = sorted_output(rows_of(now), ["chunk"]) if sort else rows_of(now).hint("rebalance", "chunk")
        # What lies at the path goes before the first chunk of a fresh output, and else only the chunks written.
        mode = "static" if fresh and first == 0 else "dynamic"

        def write(writer: DataFrameWriter, mode: str = mode) -> None:
            options = {"partitionOverwriteMode": mode, MARKS_SUCCESS: "false"}
            writer.options(**options).mode("overwrite").partitionBy("chunk").parquet(path)

        rows += _written(part, compression, compression_level, write)
        for chunk in now:
            filesystem, mark = _mark_of(spark, path, _chunk_mark(chunk, chunks))
            filesystem.create(mark, True).close()
    mark_finished(spark, path)
    return rows


def _written(df: DataFrame, compression: str, compression_level: int, write: Callable[[DataFrameWriter], None]) -> int:
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    write(parquet_writer(counted, compression, compression_level))
    return written.get["rows"]


@dataclass(frozen=True)
class OutputMetadata:
    files: int
    records: int
    size_bytes: int


def output_metadata(spark: SparkSession, path: str) -> OutputMetadata:
    """Files, records and bytes of an output; all zero where there is none."""
    if not has_output(spark, path):
        return OutputMetadata(0, 0, 0)
    # No data column is read: the counts come from the file footers.
    per_file = (
        spark.read.parquet(path)
        .select("_metadata.file_path", "_metadata.file_size")
        .groupBy("file_path")
        .agg(F.count("*").alias("records"), F.max("file_size").alias("size"))
    )
    row = per_file.agg(F.count("*"), F.sum("records"), F.sum("size")).first()
    return OutputMetadata(*row)

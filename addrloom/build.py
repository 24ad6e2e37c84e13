"""Whole builds: from raw files to a written flatfile.

Each first looks whether the output is there. If so, and unless ``overwrite`` is set, it
runs nothing but the report.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from addrloom.functions.ranks import DEFAULT_EXCLUDED_STATUSES, chunk_of
from addrloom.plans.abp import abp_flatfile
from addrloom.plans.inspection import flatfile, variant_uplift
from addrloom.plans.ngd import DEFAULT_EXCLUDED, ngd_flatfile
from addrloom.sinks.parquet import OutputMetadata, has_output, output_metadata, write_chunks, write_flatfile
from addrloom.sources.features import (
    convert_feature_folder,
    convert_zipped_features,
    read_zipped_lines,
    wanted_archives,
)
from addrloom.sources.keyed import read_keyed, write_keyed
from addrloom.sources.records import (
    read_lines,
    read_record_tables,
    write_plain_tables,
    write_record_tables,
)
from addrloom.sources.tables import read_features


@dataclass(frozen=True)
class BuildReport(OutputMetadata):
    """What lies at the output: besides files, records and bytes its keys and how many
    percent the records exceed them by."""

    total_uprns: int
    variant_uplift_pct: float


def build_report(spark: SparkSession, output: str) -> BuildReport:
    found = output_metadata(spark, output)
    if not found.files:
        return BuildReport(**asdict(found), total_uprns=0, variant_uplift_pct=0.0)
    uplift = variant_uplift(flatfile(spark, output)).first()
    return BuildReport(**asdict(found), total_uprns=uplift["total_uprns"], variant_uplift_pct=uplift["variant_uplift_pct"])


def _build(
    spark: SparkSession, output: str, plan: Callable[[], DataFrame], overwrite: bool = False, **options
) -> BuildReport:
    if overwrite or not has_output(spark, output):
        write_flatfile(plan(), output, overwrite=overwrite, **options)
    return build_report(spark, output)


def build_ngd_from_folder(
    spark: SparkSession,
    folder: str,
    output: str,
    excluded: Iterable[str] = DEFAULT_EXCLUDED,
    **options,
) -> BuildReport:
    """Flatfile of the feature tables in a folder. Options are those of ``write_flatfile``."""
    return _build(spark, output, lambda: ngd_flatfile(read_features(spark, folder), excluded), **options)


def build_ngd_by_chunk(
    spark: SparkSession,
    folder: str,
    work: str,
    output: str,
    chunks: int = 10,
    buckets: int = 200,
    excluded: Iterable[str] = DEFAULT_EXCLUDED,
    overwrite: bool = False,
    chunks_per_job: int = 1,
    **options,
) -> BuildReport:
    """Flatfile of the feature tables in a folder, which are stored by key below ``work`` first.

    Each job reads the features of its own chunks only and needs no exchange by property. A
    build that stopped goes on with the chunks it lacks, from the tables below ``work``; with
    ``overwrite`` both are made anew. Other options are those of ``write_chunks``.
    """
    if not overwrite and has_output(spark, output):
        return build_report(spark, output)
    write_keyed(read_features(spark, folder), work, chunks, buckets, overwrite=overwrite)
    stored = read_keyed(spark, work)
    if stored.chunks != chunks:
        raise ValueError(f"the tables at {work} have {stored.chunks} chunks, not {chunks}")

    def rows_of(now: list[int]) -> DataFrame:
        flat = ngd_flatfile(stored.chunk(*[chunk - 1 for chunk in now]), excluded, rows_per_task=None)
        return flat.selectExpr("*", f"{chunk_of('unique_id', chunks)} + 1 AS chunk")

    write_chunks(spark, rows_of, output, chunks, overwrite=overwrite, chunks_per_job=chunks_per_job, **options)
    return build_report(spark, output)


def build_ngd_from_csv_folder(
    spark: SparkSession,
    folder: str,
    work: str,
    output: str,
    excluded: Iterable[str] = DEFAULT_EXCLUDED,
    **options,
) -> BuildReport:
    """Flatfile of the feature CSV files below a folder, which are stored below ``work`` first."""

    def plan() -> DataFrame:
        return ngd_flatfile(convert_feature_folder(spark, folder, work, excluded, overwrite=True), excluded)

    return _build(spark, output, plan, **options)


def build_ngd_from_archives(
    spark: SparkSession,
    archives: Iterable[str],
    work: str,
    output: str,
    excluded: Iterable[str] = DEFAULT_EXCLUDED,
    **options,
) -> BuildReport:
    """Flatfile of the features inside ZIP archives, which are stored below ``work`` first."""

    def plan() -> DataFrame:
        chosen = wanted_archives(archives, "ngd", excluded)
        return ngd_flatfile(convert_zipped_features(spark, chosen, work, excluded, overwrite=True), excluded)

    return _build(spark, output, plan, **options)


def _record_tables(spark: SparkSession, work: str, plain: str | None, overwrite: bool) -> dict[str, DataFrame]:
    """The tables at ``work``, written to ``plain`` too if that is given; each reads its own part."""
    tables = read_record_tables(spark, work)
    if plain is not None:
        write_plain_tables(tables, plain, overwrite=overwrite)
    return tables


def build_abp_from_folder(
    spark: SparkSession,
    raw: str,
    work: str,
    output: str,
    excluded_statuses: Iterable[int] = DEFAULT_EXCLUDED_STATUSES,
    overwrite_tables: bool = False,
    plain_tables: str | None = None,
    **options,
) -> BuildReport:
    """Flatfile of the mixed-record CSV files below ``raw``, split into tables at ``work`` first.

    ``plain_tables`` is a folder that gets the six tables as plain Parquet too, a folder each.
    """

    def plan() -> DataFrame:
        write_record_tables(read_lines(spark, raw), work, overwrite=overwrite_tables)
        return abp_flatfile(_record_tables(spark, work, plain_tables, overwrite_tables), excluded_statuses)

    return _build(spark, output, plan, **options)


def build_abp_from_archives(
    spark: SparkSession,
    archives: Iterable[str],
    work: str,
    output: str,
    excluded_statuses: Iterable[int] = DEFAULT_EXCLUDED_STATUSES,
    overwrite_tables: bool = False,
    plain_tables: str | None = None,
    **options,
) -> BuildReport:
    """Flatfile of the mixed-record CSV members of ZIP archives, split into tables at ``work`` first.

    ``plain_tables`` is as in :func:`build_abp_from_folder`.
    """

    def plan() -> DataFrame:
        if overwrite_tables or not has_output(spark, work):
            lines = read_zipped_lines(spark, wanted_archives(archives, "abp"))
            write_record_tables(lines, work, overwrite=overwrite_tables)
        return abp_flatfile(_record_tables(spark, work, plain_tables, overwrite_tables), excluded_statuses)

    return _build(spark, output, plan, **options)

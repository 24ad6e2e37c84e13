"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions import ranks, text
from addrloom.operators.skew import find_hot_keys
from addrloom.operators.staging import staged, staging_folder
from addrloom.plans import abp, inspection, ngd
from addrloom.sinks.parquet import output_metadata, reopen_chunk, sorted_output, unfinished_chunks, write_flatfile
from addrloom.sources import features, keyed, records, tables
from checks import derived

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Keys with more rows than this count as hot in the ``…_hot_keys`` queries, few enough
# that the test tables have such keys.
TEST_ROWS_PER_TASK = 40


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _features(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: derived.read(spark, sf_dir, name) for name in derived.FEATURES}


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: derived.read(spark, sf_dir, name) for name in derived.RECORD_TABLES}


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir)
    return ngd.enrich(ngd.source_addresses(features, ()), ngd.property_lookup(features))


def _lpi_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return abp.lpi_base(tables["lpi"], tables["blpu"], tables["street_descriptor"], ())


def _lpi_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.lpi_distinct(_lpi_base(spark, sf_dir))


def _staged_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(_lpi_distinct(spark, sf_dir))


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.read(spark, sf_dir, "finished_flatfile")


# Text --------------------------------------------------------------------------


@query
def strip_postcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived.read(spark, sf_dir, "add_gb_historicaddress")
    stripped = text.strip_postcode("fulladdress", "postcode")
    return df.selectExpr("uprn", "fulladdress", "postcode", f"{stripped} AS address_concat")


@query
def component_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived.read(spark, sf_dir, "add_gb_royalmailaddress")
    parts = ["organisationname", "departmentname", "subbuildingname", "buildingname", "dependentlocality", "posttown"]
    return df.selectExpr("udprn", *parts, f"{text.comma_joined(*parts)} AS address_concat")


@query
def normalise_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = derived.given(spark, sf_dir, "documents")
    return documents.selectExpr("doc_id", f"{text.normalise_address('text')} AS normalised")


@query
def floor_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived.read(spark, sf_dir, "lpi")
    number, word = text.floor_number("level"), text.floor_word("level")
    return df.selectExpr("lpi_key", "level", f"{number} AS floor", f"{word} AS word")


@query
def build_base_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived.read(spark, sf_dir, "lpi")
    whole = abp.rendered_base_address("area_name", "level", "language")
    return df.selectExpr("lpi_key", f"{whole} AS base_address")


@query
def delivery_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.delivery_variants(derived.read(spark, sf_dir, "delivery_point")).select(
        "uprn", "postcode", "raw_address"
    )


# Feature files -----------------------------------------------------------------


@query
def core_addresses_bilingual(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "add_gb_historicaddress"
    return ngd.core_addresses(derived.read(spark, sf_dir, name), f"{name}.parquet")


@query
def alternate_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "add_gb_builtaddress_altadd"
    return ngd.alternate_addresses(derived.read(spark, sf_dir, name), f"{name}.parquet", "Built Address")


@query
def royal_mail_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "add_gb_royalmailaddress"
    return ngd.royal_mail_addresses(derived.read(spark, sf_dir, name), f"{name}.parquet")


@query
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.source_addresses(_features(spark, sf_dir), ())


@query
def source_union_without_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.source_addresses(_features(spark, sf_dir), ("builtaddress", "royalmailaddress"))


@query
def metadata_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.metadata_lookup(_features(spark, sf_dir))


@query
def local_authority_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.local_authority_lookup(derived.read(spark, sf_dir, "add_gb_builtaddress"))


@query
def property_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.property_lookup(_features(spark, sf_dir))


@query
def enrich_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


@query
def floor_level_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.floor_level_variants(_enriched(spark, sf_dir))


@query
def dedup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.dedup_ngd(ngd.source_addresses(_features(spark, sf_dir), ()))


@query
def ngd_flatfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.ngd_flatfile(_features(spark, sf_dir))


@query
def ngd_flatfile_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngd.ngd_flatfile(_features(spark, sf_dir), excluded=())


@query
def ngd_flatfile_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir)
    keys = reduce(DataFrame.union, [df.select("uprn") for df in features.values()])
    hot = find_hot_keys(keys, TEST_ROWS_PER_TASK)
    return ngd.ngd_flatfile(features, hot=hot)


@query
def ngd_flatfile_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chunk after another is built and written; in one job a task could hold a part of each."""
    chunks = 3
    features = _features(spark, sf_dir)
    parts = [
        staged(
            ngd.ngd_flatfile(
                {name: df.where(ranks.in_chunk("uprn", chunks, chunk)) for name, df in features.items()}
            )
        )
        for chunk in range(chunks)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def output_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_output(ngd.ngd_flatfile(_features(spark, sf_dir)))


# Record tables -----------------------------------------------------------------


def _derived_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived record tables as mixed text, with header and trailer lines among them."""
    parts = []
    for name in derived.RECORD_TABLES:
        line = derived.record_line(records.schema_columns(records.SCHEMAS[name]))
        parts.append(derived.read(spark, sf_dir, name).selectExpr(f"{line} AS value"))
    nation, region = derived.given(spark, sf_dir, "nation"), derived.given(spark, sf_dir, "region")
    header = F.concat(F.lit('\ufeff10,"'), "n_name", F.lit('",7655'))
    parts.append(nation.select(header.alias("value")))
    parts.append(region.selectExpr("'\"99\",0,' || CAST(r_regionkey AS STRING) || ',2024-01-01' AS value"))
    return reduce(DataFrame.unionByName, parts)


# Lines of a packed file, which one task reads.
_LINES_PER_FILE = 1_000_000


@lru_cache(maxsize=8)
def _raw_folder(application: str, sf_dir: str) -> str:
    """The lines as packed CSV files in the shared folder, written once per application."""
    spark = SparkSession.active()
    path = f"{staging_folder(spark).rstrip('/')}/raw-{uuid4().hex}"
    as_they_are = {"sep": "\x1f", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    packed = {"compression": "gzip", "maxRecordsPerFile": _LINES_PER_FILE}
    _derived_lines(spark, sf_dir).write.options(**as_they_are, **packed).csv(path)
    return path


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.read_lines(spark, _raw_folder(spark.sparkContext.applicationId, sf_dir), "*.csv.gz")


@lru_cache(maxsize=8)
def _record_folder(application: str, sf_dir: str) -> str:
    """The record tables split from the written lines, once per application."""
    spark = SparkSession.active()
    path = f"{_raw_folder(application, sf_dir)}-tables"
    records.write_record_tables(_lines(spark, sf_dir), path)
    return path


def _register_split(name: str) -> None:
    def split(spark: SparkSession, sf_dir: str) -> DataFrame:
        return records.split_records(_lines(spark, sf_dir))[name]

    QUERIES[f"split_records_{name}"] = split


for _name in derived.RECORD_TABLES:
    _register_split(_name)


@query
def split_records_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.record_counts(_lines(spark, sf_dir))


@query
def malformed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some have text in a number's place and some a day that is no date."""
    lines = derived.read(spark, sf_dir, "faulty_lines")
    return records.malformed_values(lines.selectExpr("line AS value"))


@query
def used_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.used_streets(derived.read(spark, sf_dir, "lpi"))


@query
def parents_with_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.parents_with_children(derived.read(spark, sf_dir, "blpu"))


@query
def best_street_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return abp.best_street_by_language(tables["street_descriptor"], abp.used_streets(tables["lpi"]))


@query
def best_street_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return abp.best_street_any(tables["street_descriptor"], abp.used_streets(tables["lpi"]))


@query
def lpi_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lpi_base(spark, sf_dir)


@query
def lpi_base_without_historic(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return abp.lpi_base(tables["lpi"], tables["blpu"], tables["street_descriptor"])


@query
def lpi_base_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lpi_distinct(spark, sf_dir)


@query
def lpi_best_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.lpi_best_current(_lpi_distinct(spark, sf_dir))


@query
def lpi_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.lpi_variants(_lpi_distinct(spark, sf_dir))


@query
def occupier_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.occupier_names(derived.read(spark, sf_dir, "organisation"))


@query
def business_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    organisation = derived.read(spark, sf_dir, "organisation")
    return abp.business_current(organisation, _staged_distinct(spark, sf_dir))


@query
def business_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    organisation = derived.read(spark, sf_dir, "organisation")
    return abp.business_historical(organisation, _staged_distinct(spark, sf_dir))


def _crowded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Few properties with very many names and addresses each."""
    tables = _tables(spark, sf_dir)
    lpi = derived.read(spark, sf_dir, "lpi_crowded")
    base = abp.lpi_base(lpi, tables["blpu"], tables["street_descriptor"], ())
    return derived.read(spark, sf_dir, "organisation_crowded"), staged(abp.lpi_distinct(base))


@query
def business_historical_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.business_historical(*_crowded(spark, sf_dir))


@query
def business_historical_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    organisation, distinct = _crowded(spark, sf_dir)
    hot = find_hot_keys(organisation.select("uprn"), TEST_ROWS_PER_TASK)
    return abp.business_historical(organisation, distinct, hot)


@query
def business_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    organisation = derived.read(spark, sf_dir, "organisation")
    return abp.business_variants(organisation, _staged_distinct(spark, sf_dir))


@query
def best_delivery_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.best_delivery_point(derived.read(spark, sf_dir, "delivery_point"))


@query
def delivery_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.delivery_variants(derived.read(spark, sf_dir, "delivery_point"))


@query
def best_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.best_classification(derived.read(spark, sf_dir, "classification"))


@query
def abp_level_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.level_variants(_lpi_base(spark, sf_dir))


@query
def dedup_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = abp.delivery_variants(derived.read(spark, sf_dir, "delivery_point"))
    return abp.dedup_variants(variants.unionByName(abp.lpi_variants(_lpi_distinct(spark, sf_dir))))


@query
def combine_and_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only names and mail, so that properties without a primary variant occur."""
    tables = _tables(spark, sf_dir)
    distinct = _staged_distinct(spark, sf_dir)
    variants = abp.business_current(tables["organisation"], distinct).unionByName(
        abp.delivery_variants(tables["delivery_point"])
    )
    return abp.combine_and_dedupe(
        variants,
        abp.best_classification(tables["classification"]),
        abp.best_delivery_point(tables["delivery_point"]),
    )


@query
def abp_flatfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.abp_flatfile(_tables(spark, sf_dir))


@query
def abp_flatfile_all_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abp.abp_flatfile(_tables(spark, sf_dir), excluded_statuses=())


@query
def abp_flatfile_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return abp.abp_flatfile(tables, crowding=abp.find_crowding(tables, TEST_ROWS_PER_TASK))


@query
def abp_flatfile_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the mixed text lines to the flatfile, through the written record tables."""
    folder = _record_folder(spark.sparkContext.applicationId, sf_dir)
    return abp.abp_flatfile(records.read_record_tables(spark, folder))


# Reports -----------------------------------------------------------------------


@query
def variants_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.variants_per_key(_finished(spark, sf_dir))


@query
def variant_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.variant_statistics(_finished(spark, sf_dir))


@query
def variant_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.variant_uplift(_finished(spark, sf_dir))


@query
def top_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.top_keys(_finished(spark, sf_dir), 100)


@query
def top_keys_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.top_keys(_finished(spark, sf_dir), 50, "source = 'LPI'")


@query
def top_key_at_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.top_key_at_offset(_finished(spark, sf_dir), 7)


@query
def key_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.key_variants(_finished(spark, sf_dir), 7)


@query
def key_variants_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["unique_id", "postcode", "source", "absent_column"]
    return inspection.key_variants(_finished(spark, sf_dir), 7, F.col("is_primary"), wanted)


@query
def random_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.random_key(_finished(spark, sf_dir), seed=1)


@query
def random_large_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.random_large_key(_finished(spark, sf_dir), 100, "source = 'LPI'", seed=1)


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.sample_rows(_finished(spark, sf_dir), 5, seed=1)


@query
def inspect_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inspection.inspect_variants(_finished(spark, sf_dir), offset=3)
    return found.key_rows.withColumn("variant_count", F.lit(found.variant_count).cast("bigint"))


# Files, in the shared folder -----------------------------------------------------


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"


def _of_features(features: dict[str, DataFrame], where: str = "true") -> DataFrame:
    parts = [
        df.where(where).selectExpr(f"'{stem}' AS stem", "uprn", "postcode", "fulladdress") for stem, df in sorted(features.items())
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def csv_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as CSV folders, found, stored as Parquet and read with a condition."""
    folder = _new_folder(spark, "csv")
    for stem in derived.FILE_FEATURES:
        rows = derived.read(spark, sf_dir, stem)
        rows.write.csv(f"{folder}/found/{stem}.csv", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    features.convert_feature_folder(spark, f"{folder}/found", f"{folder}/parquet", overwrite=True)
    kept = {stem: tables.read_table(spark, f"{folder}/parquet/{stem}.parquet", "CAST(uprn AS BIGINT) > 3") for stem in derived.FILE_FEATURES}
    return _of_features(kept)


def _zipped(rows: DataFrame, folder: str) -> DataFrame:
    """Lines (archive, member, place, line) as ZIP archives, in their order; lists what was written.

    A task writes its archives one after another, each line as it comes.
    """

    def write(batches):
        import zipfile
        from contextlib import ExitStack

        import pyarrow as pa
        from pyarrow import fs

        place, _, inner = folder.partition("://")
        filesystem, path = fs.FileSystem.from_uri(folder) if inner or place.startswith("file:") else (fs.LocalFileSystem(), folder)
        filesystem.create_dir(path, recursive=True)
        written, now, file, member = [], None, None, ExitStack()
        with ExitStack() as open_archive:
            for batch in batches:
                for archive, name, line in zip(*(batch.column(n).to_pylist() for n in ("archive", "member", "line"))):
                    if (archive, name) != now:
                        member.close()
                        if not written or archive != written[-1]:
                            open_archive.close()
                            stream = open_archive.enter_context(filesystem.open_output_stream(f"{path}/{archive}.zip"))
                            file = open_archive.enter_context(zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED))
                            written.append(archive)
                        sink = member.enter_context(file.open(f"{name}.csv", "w", force_zip64=True))
                        now = archive, name
                    sink.write(f"{line}\n".encode())
            member.close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array([f"{folder}/{a}.zip" for a in written], pa.string())})

    ordered = rows.repartition("archive").sortWithinPartitions("archive", "member", "place")
    return ordered.select("archive", "member", "line").mapInArrow(write, "archive string")


# Lines that an archive of the checks holds, so that their number follows the table.
_LINES_PER_ARCHIVE = 20_000


@query
def zipped_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written into ZIP archives, stored as Parquet in one job and read back."""
    folder = _new_folder(spark, "zip")
    parts = []
    for stem in derived.FILE_FEATURES:
        df = derived.read(spark, sf_dir, stem)
        line = " || ',' || ".join(f"coalesce('\"' || CAST({c} AS STRING) || '\"', '')" for c in ("uprn", "postcode", "fulladdress"))
        named = [f"'{stem}' AS archive", f"'{stem}' AS member"]
        parts += [
            df.selectExpr(*named, "1 AS place", f"{line} AS line"),
            spark.range(1).selectExpr(*named, "0 AS place", "'uprn,postcode,fulladdress' AS line"),
        ]
    archives = [row["archive"] for row in _zipped(reduce(DataFrame.union, parts), folder).collect()]
    return _of_features(features.convert_zipped_features(spark, archives, f"{folder}/parquet"))


@query
def zipped_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed record lines, dealt to archives of two members each and read from them."""
    folder = _new_folder(spark, "zip")
    lines = _derived_lines(spark, sf_dir)
    number = lines.count() // _LINES_PER_ARCHIVE + 1
    dealt = lines.selectExpr(
        f"'part' || pmod(xxhash64(value), {number}) AS archive", "'records' || pmod(hash(value), 2) AS member", "0 AS place", "value AS line"
    )
    archives = [row["archive"] for row in _zipped(dealt, folder).collect()]
    return records.record_counts(features.read_zipped_lines(spark, archives))


@query
def ngd_flatfile_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features stored by key, then a flatfile of each chunk from its own folders."""
    folder = _new_folder(spark, "keyed")
    keyed.write_keyed(_features(spark, sf_dir), folder, chunks=3, buckets=8)
    stored = keyed.read_keyed(spark, folder)
    return reduce(DataFrame.unionByName, [ngd.ngd_flatfile(stored.chunk(chunk), rows_per_task=None) for chunk in range(stored.chunks)])


@query
def abp_flatfile_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record tables of properties stored by key, then read as a whole."""
    folder = _new_folder(spark, "keyed")
    given = _tables(spark, sf_dir)
    streets = {"street_descriptor": given.pop("street_descriptor")}
    keyed.write_keyed(given, folder, chunks=2, buckets=8)
    return abp.abp_flatfile(streets | keyed.read_keyed(spark, folder).whole())


@query
def written_flatfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flatfile written sorted, compressed and in chunks, then read as one."""
    folder = _new_folder(spark, "flatfile")
    write_flatfile(_finished(spark, sf_dir), folder, chunks=3, compression_level=5)
    return inspection.flatfile(spark, folder).drop("chunk")


@query
def resumed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks written by several jobs, one of them reopened and written again on its own."""
    folder = _new_folder(spark, "flatfile")
    whole = _finished(spark, sf_dir)
    rows = write_flatfile(whole, folder, chunks=5, chunks_per_job=2, compression_level=5)
    reopen_chunk(spark, folder, 4, 5)
    missing = unfinished_chunks(spark, folder, 5)
    again = write_flatfile(whole, folder, chunks=5, compression_level=5)
    flat = inspection.flatfile(spark, folder)
    return flat.agg(
        F.count("*").alias("records"),
        F.lit(rows).cast("bigint").alias("rows_written"),
        F.lit(missing == [4]).alias("one_missing"),
        (F.count_if(F.col("chunk") == 4) == again).alias("one_written_again"),
    )


@query
def key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variants of one key, counted in a written flatfile."""
    folder = _new_folder(spark, "flatfile")
    write_flatfile(_finished(spark, sf_dir), folder, compression_level=5)
    return inspection.key_count(inspection.flatfile(spark, folder), 7)


@query
def written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What writing said, what lies there, and that it is not written again."""
    folder = _new_folder(spark, "flatfile")
    rows = write_flatfile(_finished(spark, sf_dir), folder, sort=False)
    again = write_flatfile(_finished(spark, sf_dir), folder)
    found = output_metadata(spark, folder)
    row = (found.records, rows, found.files > 0, found.size_bytes > 0, again is None)
    return spark.createDataFrame([row], "records bigint, rows_written bigint, has_files boolean, has_bytes boolean, skipped_again boolean")


@query
def plain_record_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split tables as plain Parquet of their own."""
    folder = _new_folder(spark, "plain")
    split = records.read_record_tables(spark, _record_folder(spark.sparkContext.applicationId, sf_dir))
    records.write_plain_tables({"lpi": split["lpi"]}, folder)
    return tables.read_table(spark, f"{folder}/lpi")


@query
def record_tables_of_few_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types without a record are empty tables with all their columns."""
    folder = _new_folder(spark, "tables")
    records.write_record_tables(_lines(spark, sf_dir).where("value LIKE '24,%' OR value LIKE '21,%'"), folder)
    split = records.read_record_tables(spark, folder)
    parts = [
        df.agg(F.count("*").alias("records")).selectExpr(f"'{name}' AS name", "records", f"{len(df.columns)}L AS columns")
        for name, df in split.items()
    ]
    return reduce(DataFrame.unionByName, parts)


UNCHECKED: set[str] = set()

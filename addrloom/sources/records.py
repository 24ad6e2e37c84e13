"""Mixed-record text: one line per record, its type in the first field."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from addrloom.functions.text import choose, listed, record_identifier, without_bom
from addrloom.sinks.parquet import MARKS_SUCCESS, has_output, mark_finished, parquet_writer

# Record identifiers of the supply, and the columns, in file order, of
# the six kinds that are kept.
KEPT_RECORDS = {
    "15": "street_descriptor",
    "21": "blpu",
    "24": "lpi",
    "28": "delivery_point",
    "31": "organisation",
    "32": "classification",
}
IGNORED_RECORDS = {
    "10": "header",
    "11": "street",
    "23": "application_cross_reference",
    "29": "metadata",
    "30": "successor",
    "99": "trailer",
}
_IS_KEPT = f"rid IN ({listed(KEPT_RECORDS)})"

_START = "record_identifier int, change_type string, pro_order bigint"
_DATES = "start_date date, end_date date, last_update_date date, entry_date date"
SCHEMAS = {
    "street_descriptor": f"""{_START}, usrn int, street_description string, locality string,
        town_name string, administrative_area string, language string, {_DATES}""",
    "blpu": f"""{_START}, uprn bigint, logical_status int, blpu_state string, blpu_state_date date,
        parent_uprn bigint, x_coordinate double, y_coordinate double, latitude double,
        longitude double, rpc smallint, local_custodian_code int, country string, {_DATES},
        addressbase_postal string, postcode_locator string, multi_occ_count smallint""",
    "lpi": f"""{_START}, uprn bigint, lpi_key string, language string, logical_status int, {_DATES},
        sao_start_number int, sao_start_suffix string, sao_end_number int, sao_end_suffix string,
        sao_text string, pao_start_number int, pao_start_suffix string, pao_end_number int,
        pao_end_suffix string, pao_text string, usrn int, usrn_match_indicator int,
        area_name string, level string, official_flag string""",
    "delivery_point": f"""{_START}, uprn bigint, udprn bigint, organisation_name string,
        department_name string, sub_building_name string, building_name string,
        building_number int, dependent_thoroughfare string, thoroughfare string,
        double_dependent_locality string, dependent_locality string, post_town string,
        postcode string, postcode_type string, delivery_point_suffix string,
        welsh_dependent_thoroughfare string, welsh_thoroughfare string,
        welsh_double_dependent_locality string, welsh_dependent_locality string,
        welsh_post_town string, po_box_number string, process_date date, {_DATES}""",
    "organisation": f"""{_START}, uprn bigint, org_key string, organisation string,
        legal_name string, {_DATES}""",
    "classification": f"""{_START}, uprn bigint, class_key string, classification_code string,
        class_scheme string, scheme_version double, {_DATES}""",
}


def schema_columns(schema: str) -> dict[str, str]:
    """Column names and types of a schema text, in order."""
    pairs = [column.split() for column in schema.split(",")]
    return {name: kind for name, kind in pairs}


def read_lines(spark: SparkSession, path: str, names: str = "*.csv") -> DataFrame:
    """All files below a folder with such names as text lines; ``*.csv.gz`` are unpacked as they are read."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names)
    return reader.text(path)


def identified(lines: DataFrame) -> DataFrame:
    """Lines without byte order mark, with their record identifier."""
    plain = lines.selectExpr(f"{without_bom('value')} AS line")
    return plain.selectExpr("line", f"{record_identifier('line')} AS rid")


# One more field of a parsed line: the line itself where it has not as many fields as columns.
_UNEVEN = "uneven_line"


def _fields(columns: dict[str, str]) -> str:
    """All fields as text: short lines are padded with NULL and empty fields are NULL."""
    as_text = ", ".join(f"{name} string" for name in [*columns, _UNEVEN])
    options = f"'quote', '\"', 'escape', '\"', 'nullValue', '', 'columnNameOfCorruptRecord', '{_UNEVEN}'"
    return f"from_csv(line, '{as_text}', map({options}))"


def _fits(fields: str, columns: dict[str, str]) -> str:
    """Whether a line has no more fields than columns, and quotes around whole fields only.

    A line without quotes that has one field for each column shows it by its fields.
    """
    field = '(?:"(?:[^"]++|"")*+"|[^",]*+)'
    pattern = f"^{field}(?:,{field}){{0,{len(columns) - 1}}}+$"
    plain = f"{fields}.{_UNEVEN} IS NULL AND NOT contains(line, '\"')"
    return f"CASE WHEN {plain} THEN true ELSE line RLIKE '{pattern}' END"


def _strict(fields: str, columns: dict[str, str]) -> str:
    """The fields of a line that fits; any other is an error."""
    return f"CASE WHEN {_fits(fields, columns)} THEN {fields} ELSE raise_error(concat('malformed line: ', line)) END"


def _is_date_form(text: str) -> str:
    """Whether text that can be cast to a date is written yyyy-MM-dd, without a pattern.

    The cast itself wants digits; a short day could only be followed by a blank or a T.
    """
    dashes = f"substring({text}, 5, 1) = '-' AND substring({text}, 8, 1) = '-'"
    return f"(octet_length({text}) = 10 AND {dashes} AND substring({text}, 10, 1) BETWEEN '0' AND '9')"


def _typed(fields: str, columns: dict[str, str]) -> list[str]:
    """Casts that fail on what does not fit; a date must be written as yyyy-MM-dd."""

    def typed(name: str, kind: str) -> str:
        text = f"{fields}.{name}"
        if kind == "date":
            text = f"CASE WHEN {_is_date_form(text)} THEN {text} ELSE concat('not yyyy-MM-dd: ', {text}) END"
        return f"CAST({text} AS {kind}) AS {name}"

    return [typed(name, kind) for name, kind in columns.items()]


def split_records(lines: DataFrame, schemas: dict[str, str] = SCHEMAS) -> dict[str, DataFrame]:
    """One typed DataFrame per kept record type.

    A value that does not fit its type fails, and so does a line with too many fields or
    with stray quotes; :func:`malformed_values` lists them all.
    """
    known = identified(lines)
    tables = {}
    for rid, name in KEPT_RECORDS.items():
        columns = schema_columns(schemas[name])
        parsed = known.where(f"rid = '{rid}'").selectExpr("line", f"{_fields(columns)} AS f")
        tables[name] = parsed.selectExpr(f"{_strict('f', columns)} AS f").selectExpr(*_typed("f", columns))
    return tables


def record_counts(lines: DataFrame) -> DataFrame:
    """Lines per known record type, from one scan, and whether the type is kept."""
    types = KEPT_RECORDS | IGNORED_RECORDS
    known = identified(lines).where(f"rid IN ({listed(types)})")
    counts = known.groupBy("rid").agg(F.count("*").alias("lines"))
    return counts.selectExpr(
        "rid", f"{choose('rid', types)} AS record_type", f"{_IS_KEPT} AS is_kept", "lines"
    )


def _of_type(rid: str, value: str) -> str:
    return f"CASE WHEN rid = '{rid}' THEN {value} END"


def _parsed(known: DataFrame, schemas: dict[str, str]) -> DataFrame:
    """Kept lines with one struct of text fields per record type, that of its own type filled."""
    structs = [
        f"{_of_type(rid, _fields(schema_columns(schemas[name])))} AS {name}"
        for rid, name in KEPT_RECORDS.items()
    ]
    return known.where(_IS_KEPT).selectExpr("rid", "line", *structs)


def malformed_values(lines: DataFrame, schemas: dict[str, str] = SCHEMAS) -> DataFrame:
    """Values that do not fit their type, with their table, column and line, in one pass.

    A line with too many fields or with stray quotes is listed once, without column and
    text: its fields may be shifted, so its values are not looked at.
    """

    def misfit(table: str, column: str, kind: str) -> str:
        text = f"{table}.{column}"
        found = f"struct('{table}' AS record_type, '{column}' AS column_name, {text} AS text)"
        wrong = f"try_cast({text} AS {kind}) IS NULL" + (f" OR NOT {_is_date_form(text)}" if kind == "date" else "")
        return f"CASE WHEN {text} IS NOT NULL AND ({wrong}) THEN {found} END"

    checks = []
    for rid, name in KEPT_RECORDS.items():
        columns = schema_columns(schemas[name])
        misfits = [misfit(name, column, kind) for column, kind in columns.items() if kind != "string"]
        whole = f"array(struct('{name}' AS record_type, CAST(NULL AS STRING) AS column_name, CAST(NULL AS STRING) AS text))"
        checks.append(f"WHEN '{rid}' THEN CASE WHEN {_fits(name, columns)} THEN array_compact(array({', '.join(misfits)})) ELSE {whole} END")
    found = f"inline(CASE rid {' '.join(checks)} END)"
    return _parsed(identified(lines), schemas).selectExpr("line", found).select(
        "record_type", "line", "column_name", "text"
    )


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@dataclass(frozen=True)
class SplitReport:
    """What a split wrote: rows per table, and the lines of known but unused types."""

    rows: dict[str, int]
    ignored_lines: int


def write_record_tables(
    lines: DataFrame,
    path: str,
    schemas: dict[str, str] = SCHEMAS,
    compression: str = "zstd",
    compression_level: int = 9,
    overwrite: bool = False,
) -> SplitReport | None:
    """Split all lines into typed tables below ``path`` in one pass over the text.

    Every kept line becomes one row with the struct of its own type filled, stored by
    type; :func:`read_record_tables` reads a type back with only its own columns. An
    existing result is left alone unless ``overwrite``; then None is returned. Fails if
    no kept record is found or if the stored rows are not as many as the lines; the result
    is marked as finished only after that, so a later call does not take it for one.
    """
    spark = lines.sparkSession
    if not overwrite and has_output(spark, path):
        return None
    seen = Observation()
    counted = identified(lines).observe(
        seen,
        F.count_if(F.expr(_IS_KEPT)).alias("kept"),
        F.count_if(F.expr(f"rid IN ({listed(IGNORED_RECORDS)})")).alias("ignored"),
    )
    kinds = {rid: (name, schema_columns(schemas[name])) for rid, name in KEPT_RECORDS.items()}
    strict = _parsed(counted, schemas).selectExpr(
        "rid", *[f"{_of_type(rid, _strict(name, columns))} AS {name}" for rid, (name, columns) in kinds.items()]
    )
    typed = strict.selectExpr(
        "rid",
        *[f"{_of_type(rid, f'struct({", ".join(_typed(name, columns))})')} AS {name}" for rid, (name, columns) in kinds.items()],
    )
    writer = parquet_writer(typed, compression, compression_level).option(MARKS_SUCCESS, "false")
    # A task holds a file of each type open, so rows need not be sorted by type.
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(len(KEPT_RECORDS))):
        writer.mode("overwrite").partitionBy("rid").parquet(path)
    kept = seen.get["kept"]
    if kept == 0:
        raise ValueError(f"no record with an identifier of {', '.join(KEPT_RECORDS)} was found")
    stored = spark.read.schema("rid string").parquet(path).groupBy("rid").count().collect()
    counts = {row["rid"]: row["count"] for row in stored}
    if sum(counts.values()) != kept:
        raise ValueError(f"line count mismatch: {kept} lines, {sum(counts.values())} rows")
    mark_finished(spark, path)
    rows = {name: counts.get(rid, 0) for rid, name in KEPT_RECORDS.items()}
    return SplitReport(rows, seen.get["ignored"])


def read_record_tables(
    spark: SparkSession, path: str, schemas: dict[str, str] = SCHEMAS
) -> dict[str, DataFrame]:
    """The tables of :func:`write_record_tables`; a type without records is an empty table."""
    tables = {}
    for rid, name in KEPT_RECORDS.items():
        fields = ", ".join(f"{c}: {kind}" for c, kind in schema_columns(schemas[name]).items())
        stored = spark.read.schema(f"rid string, {name} struct<{fields}>").parquet(path)
        tables[name] = stored.where(f"rid = '{rid}'").select(f"{name}.*")
    return tables


def write_plain_tables(
    tables: dict[str, DataFrame],
    path: str,
    compression: str = "zstd",
    compression_level: int = 9,
    overwrite: bool = False,
) -> list[str]:
    """Each table as plain Parquet at ``path/<name>``; returns the names of those written.

    A table that is there already is left alone unless ``overwrite``.
    """
    written = []
    for name, table in tables.items():
        place = f"{path.rstrip('/')}/{name}"
        if overwrite or not has_output(table.sparkSession, place):
            parquet_writer(table, compression, compression_level).mode("overwrite").parquet(place)
            written.append(name)
    return written

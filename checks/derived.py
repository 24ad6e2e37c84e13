"""Address-shaped tables as plain expressions over the given tables.

Each expression means the same in Spark SQL and in DuckDB, so a query and its check
start from one text. Every table reads all rows of the table it comes from.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession


def _text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def _pick(number: str, *values: str | None) -> str:
    """One of the values by remainder; ``None`` is NULL."""
    cases = " ".join(
        f"WHEN {i} THEN {value}" for i, value in enumerate(values) if value is not None
    )
    return f"CASE {number} % {len(values)} {cases} ELSE NULL END"


def _days_after(day: str, days: str) -> str:
    return f"{day} + CAST({days} AS INTEGER)"


def _postcode(key: str) -> str:
    code = f"'AB' || {_text(f'{key} % 20')} || ' ' || {_text(f'{key} % 9')} || 'XY'"
    return f"CASE WHEN {key} % 11 = 0 THEN NULL ELSE {code} END"


def _full_address(key: str, row: str, street: str, town: str) -> str:
    tail = f"CASE WHEN {key} % 7 = 0 THEN ', ' ELSE '' END || COALESCE(', ' || {_postcode(key)}, '')"
    body = f"{_text(f'{row} % 30')} || ', ' || {street} || ', ' || {town}"
    return f"CASE WHEN {row} % 97 = 0 THEN NULL ELSE {body} || {tail} END"


_FLOORS = ["'1,2'", "'-1'", "'G'", "'9'", "'0'", "'06'", None, "'3'", "''", None]


def _core(key: str, row: str, street: str, town: str, feature: str) -> dict[str, str]:
    welsh_full = _full_address(key, row, f"'STRYD ' || {street}", town)
    return {
        "uprn": key,
        "description": f"CASE WHEN {row} % 13 = 5 THEN 'Prebuild Address' ELSE '{feature}' END",
        "postcode": _postcode(key),
        "fulladdress": _full_address(key, row, street, town),
        "alternatelanguage": _pick(row, "'cym'", "'WEL'", "'eng'", None, "'Welsh'"),
        "alternatelanguagefulladdress": f"CASE WHEN {row} % 3 = 0 THEN {welsh_full} ELSE NULL END",
        "alternatelanguagesubname": _pick(row, "'UNED 4'", None, "''", None),
        "alternatelanguagename": f"CASE WHEN {row} % 6 = 1 THEN {street} ELSE NULL END",
        "alternatelanguagenumber": f"CASE WHEN {row} % 7 < 4 THEN {_text(f'{row} % 30')} ELSE NULL END",
        "alternatelanguagestreetname": f"CASE WHEN {row} % 7 < 4 THEN 'STRYD ' || {street} ELSE NULL END",
        "alternatelanguagelocality": _pick(row, None, "'WESTERBY'", "', '"),
        "alternatelanguagetownname": f"CASE WHEN {row} % 7 < 4 THEN {town} ELSE NULL END",
        "alternatelanguageislandname": _pick(row, None, None, None, None, "'YNYS BELL'"),
        "floorlevel": _pick(row, *_FLOORS),
        "lowestfloorlevel": f"CASE WHEN {row} % 4 = 0 THEN NULL ELSE CAST({row} % 5 AS DOUBLE) END",
        "highestfloorlevel": f"CAST({row} % 9 AS DOUBLE)",
        "classificationcode": f"CASE WHEN {row} % 5 = 2 THEN NULL ELSE 'RD' || {_text(f'{row} % 12')} END",
        "buildstatus": _pick(
            row, "'Built Complete'", "'under construction'", "'Prebuild'", "'Historic'", "'Demolished'", None
        ),
        "addressstatus": _pick(row, "'Approved'", "'PROVISIONAL'", "'Alternative'", "'Historical'", None),
        "parentuprn": f"CASE WHEN {row} % 3 = 1 THEN {key} + 100000 ELSE NULL END",
        "rootuprn": f"CASE WHEN {row} % 4 = 1 THEN {key} + 200000 ELSE NULL END",
        "hierarchylevel": f"CAST({row} % 4 AS INTEGER)",
        "lowertierlocalauthoritygsscode": f"CASE WHEN {row} % 8 = 0 THEN NULL ELSE 'W' || {_text(f'{row} % 22')} END",
    }


def _alternate(key: str, row: str, street: str) -> dict[str, str]:
    return {
        "alternateaddressid": _text(row),
        "uprn": key,
        "addressstatus": _pick(row, "'Alternative'", "'Approved'", None),
        "postcode": _postcode(f"({key})"),
        "fulladdress": _full_address(f"({key})", row, street, "'TOWN ' || " + _text(f"{row} % 3")),
        "floorlevel": _pick(row, "'2'", None, None, "'4,5'"),
        "lowestfloorlevel": f"CASE WHEN {row} % 2 = 0 THEN NULL ELSE CAST(1 AS DOUBLE) END",
        "highestfloorlevel": f"CASE WHEN {row} % 5 = 0 THEN NULL ELSE CAST(2 AS DOUBLE) END",
    }


_ORDER_DAY = "CAST(o_orderdate AS DATE)"
_EVENT_DAY = _days_after("DATE '1995-01-01'", "event_id % 2500")
_SHIP_DAY = "CAST(l_shipdate AS DATE)"
_EVENT_NAME = "event_type || ' ' || CAST(event_id % 40 AS STRING)"


def _validity(row: str, day: str) -> dict[str, str]:
    return {
        "start_date": f"CASE WHEN {row} % 10 = 3 THEN NULL ELSE {day} END",
        "end_date": f"CASE WHEN {row} % 3 = 0 THEN NULL ELSE {_days_after(day, f'{row} % 900')} END",
        "last_update_date": f"CASE WHEN {row} % 8 = 1 THEN NULL ELSE {_days_after(day, f'{row} % 50')} END",
        "entry_date": day,
    }


def _records(change: str, row: str, identifier: int) -> dict[str, str]:
    return {
        "record_identifier": f"CAST({identifier} AS INTEGER)",
        "change_type": change,
        "pro_order": row,
    }


def _street(language: str) -> dict[str, str]:
    return {
        **_records("'I'", "s_suppkey", 15),
        "usrn": "CAST(s_suppkey % 50 AS INTEGER)",
        "street_description": f"CASE WHEN s_suppkey % 9 = 4 THEN NULL ELSE s_name || ' {language} ROAD' END",
        "locality": _pick("s_suppkey", "'WESTERBY'", None, "''"),
        "town_name": "'TOWN ' || CAST(s_nationkey AS STRING)",
        "administrative_area": "'AREA ' || CAST(s_nationkey AS STRING)",
        "language": f"'{language}'",
        **_validity("s_suppkey", _days_after("DATE '1999-01-01'", "s_suppkey % 400")),
    }


def _lpi(key: str) -> dict[str, str]:
    return {
        **_records("'I'", "o_orderkey", 24),
        "uprn": key,
        "lpi_key": "'KEY' || CAST(o_orderkey AS STRING)",
        "language": _pick("o_orderkey", "'ENG'", "'CYM'", "'ENG'", None, "'ENG'", "'GAE'", "''"),
        "logical_status": "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN "
        "CAST(CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 6 END AS INTEGER) ELSE "
        "CAST(CASE WHEN o_orderkey % 2 = 0 THEN 8 ELSE 1 END AS INTEGER) END",
        **_validity("o_orderkey", _ORDER_DAY),
        "sao_start_number": "CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 9 AS INTEGER) ELSE NULL END",
        "sao_start_suffix": _pick("o_orderkey", "'A'", None, "''"),
        "sao_end_number": "CASE WHEN o_orderkey % 8 = 0 THEN CAST(o_orderkey % 9 + 2 AS INTEGER) ELSE NULL END",
        "sao_end_suffix": _pick("o_orderkey", None, "'B'"),
        "sao_text": _pick("o_orderkey", "'FLAT'", None, "''", "'ANNEXE'", None),
        "pao_start_number": "CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey % 40 AS INTEGER) ELSE NULL END",
        "pao_start_suffix": _pick("o_orderkey", None, "'C'", None),
        "pao_end_number": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 40 + 1 AS INTEGER) ELSE NULL END",
        "pao_end_suffix": _pick("o_orderkey", "'D'", None),
        "pao_text": "CASE WHEN o_orderkey % 3 = 2 THEN 'KEEPER' || chr(39) || 'S  LODGE' ELSE NULL END",
        "usrn": "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS INTEGER) END",
        "usrn_match_indicator": "CAST(1 AS INTEGER)",
        "area_name": "o_orderpriority",
        "level": _pick("o_orderkey", *_FLOORS),
        "official_flag": _pick("o_orderkey", "'Y'", "'N'", None),
    }


def _organisation(key: str) -> dict[str, str]:
    ended = _days_after(_EVENT_DAY, "event_id * 7 % 700 - 30")
    return {
        **_records("'I'", "event_id", 31),
        "uprn": key,
        "org_key": "'ORG' || CAST(event_id AS STRING)",
        "organisation": f"CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE {_EVENT_NAME} || ' ' END",
        "legal_name": f"CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN {_EVENT_NAME} "
        f"ELSE {_EVENT_NAME} || ' LTD' END",
        "start_date": f"CASE WHEN event_id % 17 = 0 THEN NULL ELSE {_EVENT_DAY} END",
        "end_date": f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE {ended} END",
        "last_update_date": _EVENT_DAY,
        "entry_date": _EVENT_DAY,
    }


_FAULTY_NUMBER = "CASE WHEN event_id % 7 = 0 THEN 'NO' || CAST(event_id AS STRING) ELSE CAST(event_id AS STRING) END"
_FAULTY_DAY = (
    "CASE event_id % 5 WHEN 0 THEN '2024-13-01' WHEN 1 THEN '' WHEN 2 THEN '2024-5' WHEN 3 THEN '2024-01-05T99' "
    "ELSE '2024-02-01' END"
)

# name -> parts of a UNION ALL: (given table, {column: expression})
TABLES: dict[str, list[tuple[str, dict[str, str]]]] = {
    "add_gb_builtaddress": [
        ("customer", _core("c_custkey", "c_custkey", "c_mktsegment || ' STREET'", "'TOWN ' || CAST(c_nationkey AS STRING)", "Built Address"))
    ],
    "add_gb_prebuildaddress": [
        ("part", _core("p_partkey + 700", "p_partkey", "p_name", "'TOWN ' || CAST(p_size AS STRING)", "Pre-Build Address"))
    ],
    "add_gb_nonaddressableobject": [
        ("supplier", _core("s_suppkey * 7", "s_suppkey", "s_name", "'TOWN ' || CAST(s_nationkey AS STRING)", "Non-Addressable Object"))
    ],
    "add_gb_historicaddress": [
        ("orders", _core("o_custkey + 200", "o_orderkey", "o_orderpriority", "'TOWN ' || o_orderstatus", "Historic Address"))
    ],
    "add_gb_builtaddress_altadd": [("orders", _alternate("o_custkey", "o_orderkey", "o_orderpriority"))],
    **{
        f"{stem}_altadd": [(table, _alternate(f"{key} + {shift}", key, text))]
        for stem, table, key, shift, text in (
            ("add_gb_historicaddress", "customer", "c_custkey", 200, "c_mktsegment"),
            ("add_gb_nonaddressableobject", "supplier", "s_suppkey", 7, "s_name"),
            ("add_gb_prebuildaddress", "part", "p_partkey", 700, "p_name"),
        )
    },
    "add_gb_royalmailaddress": [
        (
            "lineitem",
            {
                "udprn": "l_orderkey",
                "uprn": "CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE l_partkey END",
                "postcode": _postcode("l_partkey"),
                "matchedaddressfeaturetype": _pick("l_orderkey", "'Built Address'", "'Non-Addressable Object'", "'Pre-Build Address'", None),
                "organisationname": "CASE WHEN l_orderkey % 9 = 0 THEN 'SHOP ' || l_returnflag ELSE NULL END",
                "departmentname": _pick("l_orderkey", None, "''", None, "', DEPT '"),
                "subbuildingname": "CASE WHEN l_linenumber % 3 = 0 THEN 'FLAT ' || CAST(l_linenumber AS STRING) ELSE NULL END",
                "buildingname": _pick("l_orderkey", None, "'THE LODGE'", None),
                "buildingnumber": "CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_linenumber END",
                "dependentthoroughfare": _pick("l_orderkey", None, None, "'BACK LANE'"),
                "thoroughfare": "l_returnflag || ' STREET'",
                "doubledependentlocality": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'LOWFORD' END",
                "dependentlocality": _pick("l_suppkey", None, "'WESTERBY'"),
                "posttown": _pick("l_suppkey", "'EASTHAVEN'", "'NORTHMERE'", None),
                "welshdependentthoroughfare": "CASE WHEN l_suppkey % 6 = 0 THEN 'LON FACH' ELSE NULL END",
                "welshthoroughfare": "CASE WHEN l_suppkey % 6 < 2 THEN 'STRYD ' || l_returnflag ELSE NULL END",
                "welshdoubledependentlocality": "CASE WHEN l_suppkey % 10 = 3 THEN ' ' ELSE NULL END",
                "welshdependentlocality": "CASE WHEN l_suppkey % 10 = 4 THEN 'WESTERBY' ELSE NULL END",
                "welshposttown": "CASE WHEN l_suppkey % 6 < 3 THEN 'HAFAN' ELSE NULL END",
            },
        )
    ],
    "street_descriptor": [("supplier", _street("ENG")), ("supplier", _street("CYM"))],
    "blpu": [
        (
            "customer",
            {
                **_records("'I'", "c_custkey", 21),
                "uprn": "c_custkey",
                "logical_status": "CAST(CASE WHEN c_custkey % 6 = 0 THEN 8 ELSE 1 END AS INTEGER)",
                "blpu_state": "CAST(c_custkey % 5 AS STRING)",
                "blpu_state_date": "DATE '2001-02-03'",
                "parent_uprn": "CASE WHEN c_custkey % 5 = 1 THEN c_custkey - 1 ELSE NULL END",
                "x_coordinate": "CAST(c_nationkey AS DOUBLE)",
                "y_coordinate": "CAST(c_nationkey * 2 AS DOUBLE)",
                "latitude": "CAST(51 AS DOUBLE)",
                "longitude": "CAST(-3 AS DOUBLE)",
                "rpc": "CAST(c_custkey % 4 AS SMALLINT)",
                "local_custodian_code": "CAST(6815 AS INTEGER)",
                "country": _pick("c_custkey", "'W'", "'E'"),
                **_validity("c_custkey", _days_after("DATE '1998-01-01'", "c_custkey % 1000")),
                "addressbase_postal": _pick("c_custkey", "'D'", "'N'", None, "'L'", "'C'", "'D'", "'D'"),
                "postcode_locator": _postcode("c_custkey"),
                "multi_occ_count": "CAST(c_custkey % 3 AS SMALLINT)",
            },
        )
    ],
    "lpi": [("orders", _lpi("o_custkey"))],
    "lpi_crowded": [("orders", _lpi("o_custkey % 40"))],
    "organisation": [("events", _organisation("user_id"))],
    "organisation_crowded": [("events", _organisation("user_id % 40"))],
    "delivery_point": [
        (
            "orders",
            {
                **_records("'I'", "o_orderkey", 28),
                "uprn": "o_custkey",
                "udprn": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE o_orderkey END",
                "organisation_name": "CASE WHEN o_orderkey % 10 = 0 THEN 'SHOP ' || o_orderstatus ELSE NULL END",
                "department_name": _pick("o_orderkey", None, "''", None),
                "sub_building_name": _pick("o_orderkey", "'FLAT 1'", None, None),
                "building_name": _pick("o_orderkey", None, None, "'ST DAVID' || chr(39) || 'S HOUSE'", None),
                "building_number": "CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE CAST(o_orderkey % 25 AS INTEGER) END",
                "dependent_thoroughfare": _pick("o_orderkey", None, "''", None, "'BACK LANE'"),
                "thoroughfare": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus || ' STREET' END",
                "double_dependent_locality": "CAST(NULL AS STRING)",
                "dependent_locality": _pick("o_custkey", "'WESTERBY'", None),
                "post_town": _pick("o_custkey", "'EASTHAVEN'", "'NORTHMERE'", "''"),
                "postcode": _postcode("o_custkey"),
                "postcode_type": "'S'",
                "delivery_point_suffix": "'1A'",
                "welsh_dependent_thoroughfare": "CAST(NULL AS STRING)",
                "welsh_thoroughfare": "CAST(NULL AS STRING)",
                "welsh_double_dependent_locality": "CAST(NULL AS STRING)",
                "welsh_dependent_locality": "CAST(NULL AS STRING)",
                "welsh_post_town": "CAST(NULL AS STRING)",
                "po_box_number": "CAST(NULL AS STRING)",
                "process_date": _ORDER_DAY,
                **_validity("o_orderkey", _ORDER_DAY),
            },
        )
    ],
    "classification": [
        (
            "lineitem",
            {
                **_records("'I'", "l_orderkey", 32),
                "uprn": "l_partkey",
                "class_key": "'CLS' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
                "classification_code": "l_returnflag || l_linestatus || CAST(l_suppkey % 7 AS STRING)",
                "class_scheme": "CASE WHEN l_orderkey % 3 = 0 THEN 'AddressBase Premium Classification Scheme' "
                "WHEN l_orderkey % 3 = 1 THEN 'VOA Special Category' ELSE NULL END",
                "scheme_version": "CAST(1 AS DOUBLE)",
                **_validity("l_orderkey", _SHIP_DAY),
            },
        )
    ],
    "faulty_lines": [
        (
            "events",
            {
                "number": _FAULTY_NUMBER,
                "day": _FAULTY_DAY,
                "is_misfit": "event_id % 11 = 0 OR event_id % 13 = 0",
                "line": f"'31,I,' || {_FAULTY_NUMBER} || ',1,\"K\",\"' || CASE WHEN event_id % 13 = 0 THEN 'CA\"FE, ' ELSE '' END "
                f"|| event_type || '\",,' || {_FAULTY_DAY} || ',,,' || CASE WHEN event_id % 11 = 0 THEN ',EXTRA' ELSE '' END",
            },
        )
    ],
    "finished_flatfile": [
        (
            "orders",
            {
                "unique_id": "o_custkey",
                "address_concat": "CAST(o_orderkey % 30 AS STRING) || ' ' || o_orderpriority",
                "postcode": _postcode("o_orderkey"),
                "source": _pick("o_orderkey", "'LPI'", "'ORGANISATION'", None),
                "variant_label": _pick("o_orderkey", "'APPROVED'", "'HISTORICAL'", None, "'DELIVERY'"),
                "is_primary": "o_orderkey % 5 = 0",
                "row_number": "o_orderkey",
            },
        )
    ],
}

FEATURES = [name for name in TABLES if name.startswith("add_gb_")]
# Features that are written as files and read back.
FILE_FEATURES = ["add_gb_builtaddress", "add_gb_nonaddressableobject", "add_gb_prebuildaddress_altadd"]
RECORD_TABLES = ["street_descriptor", "blpu", "lpi", "delivery_point", "organisation", "classification"]


def _as_field(column: str, kind: str) -> str:
    """A typed value as one CSV field: text quoted, numbers and dates bare, NULL empty."""
    if kind == "string":
        return f"COALESCE('\"' || {column} || '\"', '')"
    if kind == "double":
        return f"COALESCE(CAST(CAST({column} AS INTEGER) AS STRING), '')"
    return f"COALESCE(CAST({column} AS STRING), '')"


def record_line(columns: dict[str, str]) -> str:
    return " || ',' || ".join(_as_field(column, kind) for column, kind in columns.items())


@lru_cache(maxsize=64)
def _given(application: str, path: str) -> DataFrame:
    """A given table; its schema is looked up once per application."""
    return SparkSession.active().read.parquet(path)


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _given(spark.sparkContext.applicationId, f"{sf_dir}/{table}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame."""
    parts = [
        given(spark, sf_dir, table).selectExpr(
            *[f"{expression} AS {column}" for column, expression in columns.items()]
        )
        for table, columns in TABLES[name]
    ]
    return reduce(DataFrame.unionByName, parts)


def sql(name: str) -> str:
    """The same table as a SELECT."""
    return " UNION ALL ".join(
        "SELECT "
        + ", ".join(f"{expression} AS {column}" for column, expression in columns.items())
        + f" FROM {table}"
        for table, columns in TABLES[name]
    )

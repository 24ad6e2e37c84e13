"""SQL for DuckDB that says what each registered query should return.

Written apart from the Spark plans: windows with QUALIFY where those aggregate, plain
joins where those go by cells, unions where those explode.
"""

from __future__ import annotations

import re

from addrloom.sources import records
from checks import derived

METADATA = [
    "classificationcode",
    "parentuprn",
    "rootuprn",
    "hierarchylevel",
    "floorlevel",
    "lowestfloorlevel",
    "highestfloorlevel",
]
PROPERTY = [
    "logical_status",
    "official_flag",
    "blpu_state",
    "postal_address_code",
    "parent_uprn",
    "hierarchy_level",
]
WELSH = [f"alternatelanguage{p}" for p in ("subname", "name", "number", "streetname", "locality", "townname", "islandname")]
PREMISES = ["organisationname", "departmentname", "subbuildingname", "buildingname", "buildingnumber"]
PLACES = ["dependentthoroughfare", "thoroughfare", "doubledependentlocality", "dependentlocality", "posttown"]


def _list(names, prefix="", suffix=""):
    return ", ".join(f"{prefix}{name}{suffix}" for name in names)


def _any_of(names):
    return "(" + " OR ".join(f"{name} IS NOT NULL" for name in names) + ")"


def _case(subject, mapping, default="NULL"):
    def literal(value):
        return f"'{value}'" if isinstance(value, str) else str(value)

    arms = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {subject} {arms} ELSE {default} END"


def _pick(keys, order, ties):
    """Keep the first row per key; ties go by the remaining columns, NULL first."""
    sort = [*order, *[f"{tie} NULLS FIRST" for tie in ties]]
    return f"QUALIFY row_number() OVER (PARTITION BY {_list(keys)} ORDER BY {_list(sort)}) = 1"


def _strip(address):
    return (
        f"CASE WHEN suffix({address}, ', ' || postcode) "
        f"THEN rtrim(left({address}, length({address}) - length(postcode)), ', ') ELSE {address} END"
    )


def _joined(parts):
    pieces = " || ".join(f"coalesce({part} || ', ', '')" for part in parts)
    return f"trim({pieces}, ', ')"


def _spaced(*parts):
    return f"trim(concat_ws(' ', {_list(parts)}))"


def _full(*parts):
    return _spaced(*[f"nullif({part}, '')" for part in parts])


def _object(prefix):
    p = prefix
    first = f"{p}_start_number::VARCHAR || coalesce({p}_start_suffix, '')"
    last = f"{p}_end_number::VARCHAR || coalesce({p}_end_suffix, '')"
    return _spaced(f"nullif({p}_text, '')", f"coalesce({first} || '-' || {last}, {first})")


def _base(street, locality, town):
    objects = _spaced(_object("sao"), _object("pao"))
    return _full(objects, street, locality, town)


def _floor(level):
    first = f"split_part({level}, ',', 1)"
    return f"CASE WHEN regexp_full_match({first}, '-?[0-9]+') THEN TRY_CAST({first} AS INTEGER) END"


def _word(level):
    words = "['BASEMENT', 'GROUND', 'FIRST', 'SECOND', 'THIRD', 'FOURTH', 'FIFTH', 'SIXTH']"
    return f"CASE WHEN ({_floor(level)}) BETWEEN -1 AND 6 THEN {words}[({_floor(level)}) + 2] END"


STATUS_RANK = _case("logical_status", {1: 0, 3: 1, 6: 2, 8: 3}, 9)
SOURCE_RANK = _case("source", {"LPI": 0, "ORGANISATION": 1, "DELIVERY_POINT": 2, "CUSTOM_LEVEL": 3}, 4)
NEWEST = ["coalesce(end_date, DATE '9999-12-31') DESC", "coalesce(last_update_date, DATE '0001-01-01') DESC"]
LAST_UPDATED = "coalesce(last_update_date, DATE '0001-01-01') DESC"


# Common table expressions, in order; each may use those before it ------------------

_CTES: dict[str, str] = {name: derived.sql(name) for name in derived.TABLES}

_META = _list(METADATA)
_ROW = f"uprn, address_concat, postcode, filename, {_META}, lowertierlocalauthoritygsscode, feature_type, address_status, build_status"
_NO_META = (
    "NULL::VARCHAR AS classificationcode, NULL::BIGINT AS parentuprn, NULL::BIGINT AS rootuprn, "
    "NULL::INTEGER AS hierarchylevel"
)


def _core(stem):
    shared = (
        f"postcode, '{stem}.parquet' AS filename, {_META}, NULL::VARCHAR AS lowertierlocalauthoritygsscode, "
        "description AS feature_type, addressstatus AS address_status, buildstatus AS build_status"
    )
    welsh = (
        f"CASE WHEN alternatelanguagefulladdress IS NULL THEN {_joined(WELSH)} "
        f"ELSE {_strip('alternatelanguagefulladdress')} END"
    )
    return (
        f"SELECT uprn, {_strip('fulladdress')} AS address_concat, {shared} FROM {stem} UNION ALL "
        f"SELECT uprn, {welsh} AS address_concat, {shared} FROM {stem} "
        "WHERE lower(alternatelanguage) IN ('wel', 'cym', 'welsh', 'cymraeg') AND "
        + _any_of(["alternatelanguagefulladdress", *WELSH])
    )


def _royal_mail(stem):
    shared = (
        f"postcode, '{stem}.parquet' AS filename, {_NO_META}, NULL::VARCHAR AS floorlevel, "
        "NULL::DOUBLE AS lowestfloorlevel, NULL::DOUBLE AS highestfloorlevel, "
        "NULL::VARCHAR AS lowertierlocalauthoritygsscode, 'Royal Mail Address' AS feature_type, "
        "NULL::VARCHAR AS address_status, NULL::VARCHAR AS build_status"
    )
    welsh = [f"welsh{name}" for name in PLACES]
    matched = f"FROM {stem} WHERE matchedaddressfeaturetype <> 'Non-Addressable Object'"
    return (
        f"SELECT uprn, {_joined(PREMISES + PLACES)} AS address_concat, {shared} {matched} UNION ALL "
        f"SELECT uprn, {_joined(PREMISES + welsh)} AS address_concat, {shared} {matched} AND {_any_of(welsh)}"
    )


_CTES["rows_built"] = _core("add_gb_builtaddress")
_CTES["rows_prebuild"] = _core("add_gb_prebuildaddress")
_CTES["rows_nonaddressable"] = _core("add_gb_nonaddressableobject")
_CTES["rows_historic"] = _core("add_gb_historicaddress")
_ALTERNATES = {
    "built": "Built Address",
    "historic": "Historic Address",
    "nonaddressable": "Non-Addressable Object",
    "prebuild": "Pre-Build Address",
}
_STEMS = {
    "built": "add_gb_builtaddress",
    "historic": "add_gb_historicaddress",
    "nonaddressable": "add_gb_nonaddressableobject",
    "prebuild": "add_gb_prebuildaddress",
}
for _part, _feature in _ALTERNATES.items():
    _stem = f"{_STEMS[_part]}_altadd"
    _CTES[f"rows_alternate_{_part}"] = (
        f"SELECT uprn, {_strip('fulladdress')} AS address_concat, postcode, "
        f"'{_stem}.parquet' AS filename, {_NO_META}, floorlevel, lowestfloorlevel, "
        f"highestfloorlevel, NULL::VARCHAR AS lowertierlocalauthoritygsscode, '{_feature}' AS feature_type, "
        f"addressstatus AS address_status, NULL::VARCHAR AS build_status FROM {_stem}"
    )
_CTES["rows_royal_mail"] = _royal_mail("add_gb_royalmailaddress")
_PARTS = ["built", "prebuild", "nonaddressable", "historic", "royal_mail", *[f"alternate_{part}" for part in _ALTERNATES]]


def _union(parts):
    return " UNION ALL ".join(f"SELECT {_ROW} FROM rows_{part}" for part in parts)


_CTES["meta"] = (
    f"SELECT uprn, {_META} FROM ("
    + " UNION ALL ".join(
        f"SELECT uprn, {priority} AS p, {_META} FROM {stem}"
        for priority, stem in enumerate(
            ["add_gb_builtaddress", "add_gb_prebuildaddress", "add_gb_nonaddressableobject", "add_gb_historicaddress"]
        )
    )
    + f") {_pick(['uprn'], ['p'], METADATA)}"
)
_CTES["authority"] = (
    "SELECT uprn, max(lowertierlocalauthoritygsscode) AS lowertierlocalauthoritygsscode "
    "FROM add_gb_builtaddress GROUP BY uprn"
)


def _ngd_stages(parts, tag):
    own = _list([f"coalesce(a.{name}, m.{name}) AS {name}" for name in METADATA])
    enriched = (
        f"SELECT a.uprn, address_concat, postcode, filename, {own}, b.lowertierlocalauthoritygsscode, "
        f"feature_type, address_status, build_status FROM ({_union(parts)}) a "
        "LEFT JOIN meta m ON a.uprn = m.uprn LEFT JOIN authority b ON a.uprn = b.uprn"
    )
    word = _word("floorlevel")
    levels = (
        f"SELECT {_ROW} FROM enriched_{tag} UNION ALL "
        f"SELECT uprn, trim({word} || ' ' || address_concat) AS address_concat, postcode, 'CUSTOM_LEVEL' AS filename, "
        f"{_META}, lowertierlocalauthoritygsscode, 'Custom Level' AS feature_type, address_status, build_status "
        f"FROM enriched_{tag} WHERE address_concat <> '' AND {word} IS NOT NULL"
    )
    return {f"enriched_{tag}": enriched, f"levels_{tag}": levels, f"flatfile_{tag}": _ngd_dedup(f"levels_{tag}")}


def _ngd_dedup(source):
    feature = _case(
        "feature_type",
        {
            "Built Address": 1,
            "Pre-Build Address": 2,
            "Royal Mail Address": 3,
            "Historic Address": 4,
            "Custom Level": 6,
        },
        9,
    )
    status = _case("lower(address_status)", {"approved": 1, "provisional": 2, "alternative": 3, "historical": 9}, 5)
    build = _case(
        "lower(build_status)",
        {"built complete": 1, "under construction": 2, "prebuild": 3, "historic": 8, "demolished": 9},
        5,
    )
    carried = ["postcode", "filename", "classificationcode", "parentuprn", "lowertierlocalauthoritygsscode", "floorlevel"]
    return (
        f"SELECT uprn AS unique_id, address_concat, {_list(carried)} FROM {source} "
        f"WHERE feature_type <> 'Non-Addressable Object' "
        + _pick(["uprn", "address_concat"], [feature, status, build], carried)
    )


_CTES |= _ngd_stages(_PARTS, "all")
_CTES |= _ngd_stages([part for part in _PARTS if "historic" not in part], "default")
_CTES["all_rows"] = _union(_PARTS)

_CTES["used"] = "SELECT DISTINCT usrn, language FROM lpi WHERE usrn IS NOT NULL"
_SD_TIES = [
    name
    for name in records.schema_columns(records.SCHEMAS["street_descriptor"])
    if name not in ("usrn", "language")
]
_CTES["street_by_language"] = (
    "SELECT * FROM street_descriptor s WHERE EXISTS (FROM used u WHERE u.usrn = s.usrn AND u.language = s.language) "
    + _pick(["usrn", "language"], NEWEST, _SD_TIES)
)
_any_ties = [name for name in records.schema_columns(records.SCHEMAS["street_descriptor"]) if name != "usrn"]
_CTES["street_any"] = (
    "SELECT * FROM street_descriptor WHERE usrn IN (SELECT usrn FROM used) " + _pick(["usrn"], NEWEST, _any_ties)
)
_CTES["parents"] = "SELECT DISTINCT parent_uprn AS uprn FROM blpu WHERE parent_uprn IS NOT NULL"


def _lpi_stages(lpi, statuses, tag):
    texts = {"street_description": "street_description", "locality": "locality_name", "town_name": "town_name"}
    located = (
        "SELECT l.*, "
        + _list([f"coalesce(s.{column}, y.{column}) AS {alias}" for column, alias in texts.items()])
        + f" FROM {lpi} l LEFT JOIN street_by_language s ON s.usrn = l.usrn AND s.language = l.language "
        f"LEFT JOIN street_any y ON y.usrn = l.usrn WHERE l.logical_status IN ({statuses})"
    )
    base = (
        "SELECT l.uprn, lpi_key, language, l.logical_status, official_flag, l.start_date, l.end_date, "
        "l.last_update_date, level, street_description, locality_name, town_name, "
        f"{_base('street_description', 'locality_name', 'town_name')} AS base_address, "
        f"{_case('l.logical_status', {1: 0, 3: 1, 6: 2, 8: 3}, 9)} AS status_rank, "
        "postcode_locator AS postcode, blpu_state, addressbase_postal AS postal_address_code, parent_uprn, "
        "CASE WHEN parent_uprn IS NOT NULL THEN 'C' WHEN l.uprn IN (SELECT uprn FROM parents) THEN 'P' "
        f"ELSE 'S' END AS hierarchy_level FROM located_{tag} l JOIN blpu b ON b.uprn = l.uprn "
        "WHERE addressbase_postal IS DISTINCT FROM 'N'"
    )
    distinct = (
        f"SELECT DISTINCT uprn, base_address, postcode, {_list(PROPERTY)}, start_date, end_date, "
        f"last_update_date, status_rank FROM base_{tag} WHERE base_address <> ''"
    )
    best = (
        f"SELECT uprn, base_address, postcode, {_list(PROPERTY)}, status_rank, last_update_date "
        f"FROM distinct_{tag} " + _pick(["uprn"], ["status_rank", LAST_UPDATED], ["base_address", "postcode", *PROPERTY, "last_update_date"])
    )
    return {
        f"located_{tag}": located,
        f"base_{tag}": base,
        f"distinct_{tag}": distinct,
        f"current_{tag}": best,
    }


def _names(organisation):
    trimmed = "nullif(trim(organisation), '')", "nullif(trim(legal_name), '')"
    return (
        f"SELECT uprn, start_date, end_date, FALSE AS is_legal, {trimmed[0]} AS name FROM {organisation} "
        f"WHERE {trimmed[0]} IS NOT NULL UNION ALL "
        f"SELECT uprn, start_date, end_date, TRUE AS is_legal, {trimmed[1]} AS name FROM {organisation} "
        f"WHERE {trimmed[1]} IS NOT NULL AND {trimmed[1]} IS DISTINCT FROM {trimmed[0]}"
    )


_VARIANT = f"uprn, postcode, raw_address, source, {_list(PROPERTY)}, variant_label, is_primary"
_NO_PROPERTY = (
    "NULL::INTEGER AS logical_status, NULL::VARCHAR AS official_flag, NULL::VARCHAR AS blpu_state, "
    "NULL::VARCHAR AS postal_address_code, NULL::BIGINT AS parent_uprn, NULL::VARCHAR AS hierarchy_level"
)


def _business(source, label):
    return (
        f"SELECT uprn, postcode, trim(name || ' ' || base_address) AS raw_address, 'ORGANISATION' AS source, "
        f"{_list(PROPERTY)}, '{label}' || CASE WHEN is_legal THEN '_LEGAL' ELSE '' END AS variant_label, "
        f"FALSE AS is_primary FROM ({source})"
    )


def _current(names, tag):
    source = (
        f"SELECT n.name, n.is_legal, c.* FROM {names} n JOIN current_{tag} c ON c.uprn = n.uprn WHERE n.end_date IS NULL"
    )
    return _business(source, "BUSINESS_CURRENT")


def _historical(names, tag):
    """All pairs of a property, ranked per name: overlapping first."""
    order = [
        "NOT coalesce((d.start_date IS NULL OR d.start_date <= n.end_date) "
        "AND (d.end_date IS NULL OR d.end_date >= n.start_date), FALSE)",
        "status_rank",
        "coalesce(d.last_update_date, DATE '0001-01-01') DESC",
    ]
    ties = ["base_address", "postcode", *PROPERTY]
    source = (
        "SELECT n.name, n.is_legal, d.* FROM "
        f"(SELECT *, row_number() OVER () AS id FROM {names} WHERE end_date IS NOT NULL) n "
        f"JOIN distinct_{tag} d ON d.uprn = n.uprn " + _pick(["n.id"], order, ties)
    )
    return _business(source, "BUSINESS_HISTORICAL")


_CTES["names"] = _names("organisation")
_CTES["names_crowded"] = _names("organisation_crowded")
_CTES["mail"] = (
    "SELECT uprn, postcode, raw_address, 'DELIVERY_POINT' AS source, " + _NO_PROPERTY + ", "
    "'DELIVERY' AS variant_label, FALSE AS is_primary FROM (SELECT uprn, postcode, "
    + _full(
        _spaced("department_name", "organisation_name", "sub_building_name", "building_name", "building_number::VARCHAR"),
        "dependent_thoroughfare",
        "thoroughfare",
        "double_dependent_locality",
        "dependent_locality",
        "post_town",
    )
    + " AS raw_address FROM delivery_point WHERE postcode IS NOT NULL) WHERE raw_address <> ''"
)
_CTES["best_mail"] = (
    "SELECT uprn, udprn FROM delivery_point WHERE udprn IS NOT NULL "
    + _pick(["uprn"], NEWEST, ["udprn", "end_date", "last_update_date"])
)
_CTES["best_class"] = (
    "SELECT uprn, classification_code, class_scheme FROM classification "
    + _pick(
        ["uprn"],
        ["(class_scheme IS DISTINCT FROM 'AddressBase Premium Classification Scheme')", *NEWEST],
        ["classification_code", "class_scheme", "end_date", "last_update_date"],
    )
)


def _lpi_rows(tag):
    label = _case("logical_status", {1: "APPROVED", 3: "ALTERNATIVE", 6: "PROVISIONAL", 8: "HISTORICAL"})
    return (
        f"SELECT uprn, postcode, base_address AS raw_address, 'LPI' AS source, {_list(PROPERTY)}, "
        f"{label} AS variant_label, logical_status = 1 AS is_primary FROM distinct_{tag}"
    )


def _level_rows(tag):
    word = _word("level")
    return (
        f"SELECT uprn, postcode, trim({word} || ' ' || base_address) AS raw_address, 'CUSTOM_LEVEL' AS source, "
        f"{_NO_PROPERTY}, 'CUSTOM_LEVEL' AS variant_label, FALSE AS is_primary FROM base_{tag} "
        f"WHERE base_address <> '' AND {word} IS NOT NULL"
    )


def _dedup(variants):
    carried = [
        "postcode",
        "source",
        "logical_status",
        "blpu_state",
        "postal_address_code",
        "parent_uprn",
        "hierarchy_level",
        "variant_label",
        "is_primary",
    ]
    order = ["is_primary DESC", STATUS_RANK, SOURCE_RANK, "variant_label", "source"]
    return (
        f"SELECT uprn, address_concat, {_list(carried)} FROM (SELECT *, "
        r"regexp_replace(replace(raw_address, chr(39), ''), '\s+', ' ') AS address_concat "
        f"FROM ({variants})) " + _pick(["uprn", "address_concat"], order, carried)
    )


def _combined(deduped):
    first = f"row_number() OVER (PARTITION BY uprn ORDER BY {SOURCE_RANK}, variant_label, address_concat) = 1"
    primary = f"CASE WHEN bool_or(is_primary) OVER (PARTITION BY uprn) THEN is_primary ELSE {first} END"
    return (
        "SELECT v.uprn AS unique_id, postcode, address_concat, classification_code, logical_status, blpu_state, "
        "postal_address_code, udprn, parent_uprn, hierarchy_level, source, variant_label, chosen AS is_primary "
        f"FROM (SELECT *, {primary} AS chosen FROM ({deduped})) v "
        "LEFT JOIN best_class c ON c.uprn = v.uprn LEFT JOIN best_mail m ON m.uprn = v.uprn"
    )


def _every(*parts):
    return " UNION ALL ".join(f"SELECT {_VARIANT} FROM ({part})" for part in parts)


def _whole(tag):
    variants = _every(
        _lpi_rows(tag),
        _current("names", tag),
        _historical("names", tag),
        "SELECT * FROM mail",
        _level_rows(tag),
    )
    return _combined(_dedup(variants))


_CTES |= _lpi_stages("lpi", "1, 3, 6, 8", "full")
_CTES |= _lpi_stages("lpi", "1, 3, 6", "live")
_CTES |= _lpi_stages("lpi_crowded", "1, 3, 6, 8", "crowded")

_COUNTS = "SELECT unique_id, count(*) AS variant_count FROM finished_flatfile"


def _read_back(name):
    """A record table after it has been text: empty text is NULL."""
    columns = records.schema_columns(records.SCHEMAS[name])
    read = [f"nullif({c}, '') AS {c}" if kind == "string" else c for c, kind in columns.items()]
    return f"SELECT {_list(read)} FROM ({derived.sql(name)})"


def _record_counts():
    rows = [
        f"SELECT '{rid}' AS rid, '{name}' AS record_type, TRUE AS is_kept, count(*) AS lines FROM {name}"
        for rid, name in records.KEPT_RECORDS.items()
    ]
    rows.append("SELECT '10', 'header', FALSE, count(*) FROM nation")
    rows.append("SELECT '99', 'trailer', FALSE, count(*) FROM region")
    return " UNION ALL ".join(rows)




def _seeded(*columns):
    """The order of a pick with seed 1."""
    return "md5(concat_ws(':', '1', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + "))"


_REPORTED = "unique_id, address_concat, postcode, source, variant_label, is_primary"

_FINAL: dict[str, str] = {
    "strip_postcode": f"SELECT uprn, fulladdress, postcode, {_strip('fulladdress')} AS address_concat FROM add_gb_historicaddress",
    "component_address": "SELECT udprn, organisationname, departmentname, subbuildingname, buildingname, "
    "dependentlocality, posttown, "
    + _joined(["organisationname", "departmentname", "subbuildingname", "buildingname", "dependentlocality", "posttown"])
    + " AS address_concat FROM add_gb_royalmailaddress",
    "normalise_address": r"SELECT doc_id, regexp_replace(replace(text, chr(39), ''), '\s+', ' ') AS normalised FROM documents",
    "floor_words": f"SELECT lpi_key, level, {_floor('level')} AS floor, {_word('level')} AS word FROM lpi",
    "build_base_address": f"SELECT lpi_key, {_base('area_name', 'level', 'language')} AS base_address FROM lpi",
    "delivery_address": "SELECT uprn, postcode, raw_address FROM mail",
    "core_addresses_bilingual": "SELECT * FROM rows_historic",
    "alternate_addresses": "SELECT * FROM rows_alternate_built",
    "royal_mail_addresses": "SELECT * FROM rows_royal_mail",
    "source_union": "SELECT * FROM all_rows",
    "source_union_without_excluded": _union([part for part in _PARTS if "built" not in part.split("_") and part != "royal_mail"]),
    "metadata_lookup": "SELECT * FROM meta",
    "local_authority_lookup": "SELECT * FROM authority",
    "property_lookup": "SELECT m.*, a.lowertierlocalauthoritygsscode FROM meta m "
    "LEFT JOIN authority a ON a.uprn = m.uprn",
    "enrich_addresses": "SELECT * FROM enriched_all",
    "floor_level_variants": "SELECT * FROM levels_all",
    "dedup_priority": _ngd_dedup("all_rows"),
    "ngd_flatfile": "SELECT * FROM flatfile_default",
    "ngd_flatfile_all_sources": "SELECT * FROM flatfile_all",
    "ngd_flatfile_hot_keys": "SELECT * FROM flatfile_default",
    "ngd_flatfile_chunked": "SELECT * FROM flatfile_default",
    "ngd_flatfile_by_key": "SELECT * FROM flatfile_default",
    "output_sorted": "SELECT * FROM flatfile_default",
    **{f"split_records_{name}": _read_back(name) for name in derived.RECORD_TABLES},
    "split_records_counts": _record_counts(),
    "malformed_values": "SELECT 'organisation' AS record_type, line, 'pro_order' AS column_name, number AS text "
    "FROM faulty_lines WHERE TRY_CAST(number AS BIGINT) IS NULL AND NOT is_misfit UNION ALL "
    "SELECT 'organisation', line, 'start_date', day FROM faulty_lines WHERE NOT is_misfit AND day <> '' "
    r"AND NOT (regexp_full_match(day, '\d{4}-\d{2}-\d{2}') AND TRY_CAST(day AS DATE) IS NOT NULL) UNION ALL "
    "SELECT 'organisation', line, NULL, NULL FROM faulty_lines WHERE is_misfit",
    "used_streets": "SELECT * FROM used",
    "parents_with_children": "SELECT * FROM parents",
    "best_street_by_language": "SELECT * FROM street_by_language",
    "best_street_any": "SELECT * FROM street_any",
    "lpi_base": "SELECT * FROM base_full",
    "lpi_base_without_historic": "SELECT * FROM base_live",
    "lpi_base_distinct": "SELECT * FROM distinct_full",
    "lpi_best_current": "SELECT * FROM current_full",
    "lpi_variants": _lpi_rows("full"),
    "occupier_names": "SELECT * FROM names",
    "business_current": _current("names", "full"),
    "business_historical": _historical("names", "full"),
    "business_historical_crowded": _historical("names_crowded", "crowded"),
    "business_historical_hot_keys": _historical("names_crowded", "crowded"),
    "business_variants": _every(_current("names", "full"), _historical("names", "full")),
    "best_delivery_point": "SELECT * FROM best_mail",
    "delivery_variants": "SELECT * FROM mail",
    "best_classification": "SELECT * FROM best_class",
    "abp_level_variants": _level_rows("full"),
    "dedup_variants": _dedup(_every("SELECT * FROM mail", _lpi_rows("full"))),
    "combine_and_dedupe": _combined(_dedup(_every(_current("names", "full"), "SELECT * FROM mail"))),
    "abp_flatfile": _whole("live"),
    "abp_flatfile_all_statuses": _whole("full"),
    "abp_flatfile_hot_keys": _whole("live"),
    "abp_flatfile_from_raw": _whole("live"),
    "abp_flatfile_by_key": _whole("live"),
    "variants_per_key": f"{_COUNTS} GROUP BY unique_id",
    "variant_statistics": "SELECT count(*) AS total_uprns, sum(variant_count)::BIGINT AS total_variants, "
    "avg(variant_count) AS mean_variants, median(variant_count) AS median_variants, "
    f"min(variant_count) AS min_variants, max(variant_count) AS max_variants FROM ({_COUNTS} GROUP BY unique_id)",
    "variant_uplift": "SELECT count(DISTINCT unique_id) AS total_uprns, count(*) AS total_rows, "
    "(count(*) - count(DISTINCT unique_id)) / count(DISTINCT unique_id) * 100 AS variant_uplift_pct "
    "FROM finished_flatfile",
    "top_keys": f"{_COUNTS} GROUP BY unique_id ORDER BY variant_count DESC, unique_id LIMIT 100",
    "top_keys_filtered": f"{_COUNTS} WHERE source = 'LPI' GROUP BY unique_id ORDER BY variant_count DESC, unique_id LIMIT 50",
    "top_key_at_offset": f"{_COUNTS} GROUP BY unique_id ORDER BY variant_count DESC, unique_id LIMIT 1 OFFSET 7",
    "key_variants": f"SELECT {_REPORTED} FROM finished_flatfile WHERE unique_id = 7",
    "random_key": f"SELECT {_REPORTED} FROM finished_flatfile WHERE unique_id IS NOT DISTINCT FROM "
    f"(SELECT unique_id FROM (SELECT DISTINCT unique_id FROM finished_flatfile) ORDER BY {_seeded('unique_id')} LIMIT 1)",
    "random_large_key": f"SELECT {_REPORTED} FROM finished_flatfile WHERE source = 'LPI' AND unique_id IS NOT DISTINCT FROM "
    f"(SELECT unique_id FROM ({_COUNTS} WHERE source = 'LPI' GROUP BY unique_id ORDER BY variant_count DESC, unique_id LIMIT 100) "
    f"ORDER BY {_seeded('unique_id')} LIMIT 1)",
    "sample_rows": f"SELECT * FROM finished_flatfile ORDER BY {_seeded('unique_id', 'address_concat')}, "
    "address_concat, is_primary NULLS FIRST, postcode NULLS FIRST, row_number LIMIT 5",
    "inspect_key": f"SELECT *, (SELECT count(*) FROM finished_flatfile f WHERE f.unique_id IS NOT DISTINCT FROM k.unique_id) "
    f"AS variant_count FROM finished_flatfile k WHERE unique_id = (SELECT unique_id FROM ({_COUNTS} GROUP BY unique_id "
    "ORDER BY variant_count DESC, unique_id LIMIT 1 OFFSET 3))",
    "csv_features": " UNION ALL ".join(
        f"SELECT '{stem}' AS stem, CAST(uprn AS VARCHAR) AS uprn, postcode, fulladdress FROM {stem} WHERE uprn > 3"
        for stem in derived.FILE_FEATURES
    ),
    "zipped_features": " UNION ALL ".join(
        f"SELECT '{stem}' AS stem, CAST(uprn AS VARCHAR) AS uprn, postcode, fulladdress FROM {stem}" for stem in derived.FILE_FEATURES
    ),
    "zipped_record_counts": _record_counts(),
    "written_flatfile": "SELECT * FROM finished_flatfile",
    "resumed_chunks": "SELECT count(*) AS records, count(*) AS rows_written, true AS one_missing, true AS one_written_again FROM finished_flatfile",
    "key_count": "SELECT 7::BIGINT AS unique_id, count(*) AS variant_count FROM finished_flatfile WHERE unique_id = 7",
    "written_report": "SELECT count(*) AS records, count(*) AS rows_written, true AS has_files, true AS has_bytes, "
    "true AS skipped_again FROM finished_flatfile",
    "plain_record_tables": _read_back("lpi"),
    "record_tables_of_few_types": " UNION ALL ".join(
        f"SELECT '{name}' AS name, {f'(SELECT count(*) FROM {name})' if name in ('lpi', 'blpu') else '0::BIGINT'} AS records, "
        f"{len(records.schema_columns(records.SCHEMAS[name]))}::BIGINT AS columns"
        for name in derived.RECORD_TABLES
    ),
    "key_variants_filtered": "SELECT unique_id, postcode, source FROM finished_flatfile WHERE unique_id = 7 AND is_primary",
}


def _needed(statement: str) -> list[str]:
    """The expressions a statement uses, directly or through others, in their order."""
    found: set[str] = set()
    queue = [statement]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in words & set(_CTES) - found:
            found.add(name)
            queue.append(_CTES[name])
    return [name for name in _CTES if name in found]


_FROM_TEXT = {name: _read_back(name) for name in derived.RECORD_TABLES}


def oracle(name: str) -> str:
    used = _CTES | _FROM_TEXT if name == "abp_flatfile_from_raw" else _CTES
    ctes = ", ".join(f"{cte} AS ({used[cte]})" for cte in _needed(_FINAL[name]))
    return f"WITH {ctes} {_FINAL[name]}" if ctes else _FINAL[name]


ORACLES = {name: oracle(name) for name in _FINAL}

"""Address variants from typed record tables (streets, properties, identifiers, names, mail)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.functions import ranks
from addrloom.functions.text import (
    addressable_object,
    base_address,
    clean_name,
    delivery_address,
    floor_word,
    literal,
    named_address,
    normalise_address,
)
from addrloom.operators.overlap import SMALL_KEY, SPREAD_FROM, best_overlapping, day_or_first, day_or_open
from addrloom.operators.ranking import best_per_key
from addrloom.operators.skew import (
    NO_HOT_KEYS,
    ROWS_PER_TASK,
    HotKeys,
    find_hot_keys,
    lookup_join,
)
from addrloom.operators.staging import staged

TABLES = ("street_descriptor", "blpu", "lpi", "delivery_point", "organisation", "classification")

# What an address row carries about its property, in the order of the common variant row.
PROPERTY = {
    "logical_status": "int",
    "official_flag": "string",
    "blpu_state": "string",
    "postal_address_code": "string",
    "parent_uprn": "bigint",
    "hierarchy_level": "string",
}
VARIANT = ["uprn", "postcode", "raw_address", "source", *PROPERTY, "variant_label", "is_primary"]
DISTINCT = [
    "uprn",
    "base_address",
    "postcode",
    *PROPERTY,
    "start_date",
    "end_date",
    "last_update_date",
    "status_rank",
]
OUTPUT = [
    "unique_id",
    "postcode",
    "address_concat",
    "classification_code",
    "logical_status",
    "blpu_state",
    "postal_address_code",
    "udprn",
    "parent_uprn",
    "hierarchy_level",
    "source",
    "variant_label",
    "is_primary",
]
_STREET_TEXT = {
    "street_description": "street_description",
    "locality": "locality_name",
    "town_name": "town_name",
}
_PREMISES = [
    "department_name",
    "organisation_name",
    "sub_building_name",
    "building_name",
    "building_number",
]
_PLACES = [
    "dependent_thoroughfare",
    "thoroughfare",
    "double_dependent_locality",
    "dependent_locality",
    "post_town",
]


@dataclass(frozen=True)
class Crowding:
    """Hot property and street keys of a supply."""

    uprn: HotKeys = NO_HOT_KEYS
    usrn: HotKeys = NO_HOT_KEYS


def find_crowding(tables: dict[str, DataFrame], rows_per_task: int = ROWS_PER_TASK) -> Crowding:
    uprns = [tables[name].select("uprn") for name in ("blpu", "lpi", "delivery_point", "organisation")]
    return Crowding(
        uprn=find_hot_keys(reduce(DataFrame.union, uprns), rows_per_task),
        usrn=find_hot_keys(tables["lpi"].select("usrn"), rows_per_task),
    )


# Streets -----------------------------------------------------------------------


def used_streets(lpi: DataFrame) -> DataFrame:
    """The (usrn, language) pairs that identifiers refer to."""
    return lpi.where("usrn IS NOT NULL").select("usrn", "language").distinct()


# Streets are ranked before they are limited to the used ones: that leaves one row per
# key for the join, however many descriptors a street has.


def best_street_by_language(street_descriptor: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """The best descriptor per street and language, if given of used pairs only."""
    keys = ["usrn", "language"]
    best = best_per_key(street_descriptor, keys, ranks.latest_valid())
    return best if used is None else best.join(used, keys, "left_semi")


def best_street_any(street_descriptor: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """The best descriptor per street in any language, if given of used streets only."""
    best = best_per_key(street_descriptor, ["usrn"], ranks.latest_valid())
    return best if used is None else best.join(used.select("usrn").distinct(), ["usrn"], "left_semi")


def street_lookup(street_descriptor: DataFrame) -> DataFrame:
    """One row per street: its best texts of any language, and the best ones by language.

    Both come from one exchange by street.
    """
    dealt = street_descriptor.where("usrn IS NOT NULL").repartition("usrn")
    by_language = best_street_by_language(dealt)
    order = [*ranks.latest_valid(), *[c for c in street_descriptor.columns if c != "usrn"]]
    keyed = [f"{value} AS key_{i}" for i, value in enumerate(order)]
    texts = f"struct({', '.join(f'{name} AS {alias}' for name, alias in _STREET_TEXT.items())})"
    return by_language.groupBy("usrn").agg(
        F.expr(f"min(struct({', '.join(keyed)}, {texts} AS texts)).texts").alias("any_language"),
        F.expr(f"map_from_entries(collect_list(struct(language, {texts} AS texts)) FILTER (WHERE language IS NOT NULL))").alias("by_language"),
    )


# Identifiers -------------------------------------------------------------------


def parents_with_children(blpu: DataFrame) -> DataFrame:
    """Properties that another one names as its parent, over the whole supply."""
    return blpu.where("parent_uprn IS NOT NULL").selectExpr("parent_uprn AS uprn").distinct()


def postal_properties(blpu: DataFrame) -> DataFrame:
    """What a variant carries of its property; those marked as not postal are left out.

    Copies of a property's row say nothing more and are dropped, so that they do not
    multiply its addresses. Each row of the one scan speaks for its property and for its
    parent, which it shows to have children; one exchange by property brings both together.
    """
    carried = {
        "postcode": "postcode_locator",
        "blpu_state": "blpu_state",
        "postal_address_code": "addressbase_postal",
        "parent_uprn": "parent_uprn",
    }
    row = f"struct({', '.join(f'{value} AS {name}' for name, value in carried.items())})"
    own = f"struct(uprn, IF(NOT addressbase_postal <=> 'N', {row}, NULL) AS own, false AS is_parent)"
    parent = f"struct(parent_uprn AS uprn, IF(false, {row}, NULL) AS own, true AS is_parent)"
    said = blpu.selectExpr(f"inline(array({own}, {parent}))")
    per_uprn = (
        said.where("own IS NOT NULL OR (is_parent AND uprn IS NOT NULL)")
        .groupBy("uprn")
        .agg(F.collect_set("own").alias("rows"), F.max("is_parent").alias("has_children"))
    )
    code = ranks.hierarchy_code("parent_uprn", "has_children")
    rows = per_uprn.selectExpr("uprn", "has_children", "inline(rows)")
    return rows.selectExpr("uprn", *carried, f"{code} AS hierarchy_level")


def _object(prefix: str) -> str:
    parts = ["text", "start_number", "start_suffix", "end_number", "end_suffix"]
    return addressable_object(*[f"{prefix}_{part}" for part in parts])


def rendered_base_address(street: str, locality: str, town: str) -> str:
    return base_address(_object("sao"), _object("pao"), street, locality, town)


def lpi_base(
    lpi: DataFrame,
    blpu: DataFrame,
    street_descriptor: DataFrame,
    excluded_statuses: Iterable[int] = ranks.DEFAULT_EXCLUDED_STATUSES,
    crowding: Crowding = Crowding(),
) -> DataFrame:
    """Identifiers of postal properties with their rendered base address.

    The text is rendered before the join by property, so that join moves one address
    in place of its components.
    """
    kept = lpi.where("uprn IS NOT NULL").where(
        ranks.status_is_included("logical_status", excluded_statuses)
    )
    located = lookup_join(kept, street_lookup(street_descriptor), ["usrn"], crowding.usrn)
    places = list(_STREET_TEXT.values())
    # A text that the street lacks in the row's language is taken in any language.
    located = located.selectExpr(
        "*", *[f"coalesce(element_at(by_language, language).{name}, any_language.{name}) AS {name}" for name in places]
    )
    rendered = located.selectExpr(
        "uprn",
        "lpi_key",
        "language",
        "logical_status",
        "official_flag",
        "start_date",
        "end_date",
        "last_update_date",
        "level",
        *places,
        f"{rendered_base_address(*places)} AS base_address",
        f"{ranks.logical_status_rank('logical_status')} AS status_rank",
    )
    return lookup_join(rendered, postal_properties(blpu), ["uprn"], crowding.uprn, "inner")


def lpi_distinct(base: DataFrame, also: Iterable[str] = ()) -> DataFrame:
    """Distinct non-empty addresses of each property with what they carry."""
    return base.where("base_address != ''").select(*DISTINCT, *also).distinct()


def lpi_best_current(distinct: DataFrame) -> DataFrame:
    columns = ["uprn", "base_address", "postcode", *PROPERTY, "status_rank", "last_update_date"]
    return best_per_key(distinct.select(*columns), ["uprn"], ["status_rank", ranks.last_updated()])


def _variants(df: DataFrame, carried: bool, **values: str) -> DataFrame:
    """Project onto the common variant row, with the property's columns or typed NULLs."""
    property_values = {
        name: name if carried else f"CAST(NULL AS {kind})" for name, kind in PROPERTY.items()
    }
    values = {"uprn": "uprn", "postcode": "postcode", "is_primary": "false"} | property_values | values
    return df.selectExpr(*[f"{values[name]} AS {name}" for name in VARIANT])


def lpi_variants(distinct: DataFrame) -> DataFrame:
    return _variants(
        distinct,
        carried=True,
        raw_address="base_address",
        source="'LPI'",
        variant_label=ranks.logical_status_label("logical_status"),
        is_primary="logical_status = 1",
    )


# Business names ----------------------------------------------------------------


def occupier_names(organisation: DataFrame) -> DataFrame:
    """Trading names, and legal names that differ from them, from one scan."""
    names = (
        "array(struct(false AS is_legal, trading AS name), "
        "struct(true AS is_legal, CASE WHEN NOT legal <=> trading THEN legal END AS name))"
    )
    dated = ["uprn", "start_date", "end_date"]
    return (
        organisation.where("uprn IS NOT NULL")
        .selectExpr(*dated, f"{clean_name('organisation')} AS trading", f"{clean_name('legal_name')} AS legal")
        .selectExpr(*dated, f"inline({names})")
        .where("name IS NOT NULL")
    )


def _business_variants(named: DataFrame, label: str) -> DataFrame:
    return _variants(
        named,
        carried=True,
        raw_address=named_address("name", "base_address"),
        source="'ORGANISATION'",
        variant_label=f"CASE WHEN is_legal THEN '{label}_LEGAL' ELSE '{label}' END",
    )


def _occupied(distinct: DataFrame, organisation: DataFrame, hot: HotKeys) -> DataFrame:
    """Addresses of the properties that have had an occupier; most have not."""
    return lookup_join(distinct, organisation.select("uprn").distinct(), ["uprn"], hot, "left_semi")


def business_current(
    organisation: DataFrame, distinct: DataFrame, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """Names still in place, before the best current address of their property."""
    names = occupier_names(organisation).where("end_date IS NULL")
    best = lpi_best_current(_occupied(distinct, organisation, hot))
    return _business_variants(lookup_join(names, best, ["uprn"], hot, "inner"), "BUSINESS_CURRENT")


def business_historical(
    organisation: DataFrame,
    distinct: DataFrame,
    hot: HotKeys = NO_HOT_KEYS,
    small_key: int = SMALL_KEY,
    spread_from: int = SPREAD_FROM,
) -> DataFrame:
    """Names that have ended, before the best address valid in their time, else any.

    ``small_key`` and ``spread_from`` are those of ``best_overlapping``; no result depends on them.
    Each name asks for the address whose validity overlaps its own; see
    ``operators.overlap`` for how that avoids pairing names with addresses.
    """
    names = (
        occupier_names(organisation)
        .where("end_date IS NOT NULL")
        .selectExpr(
            "uprn",
            "name",
            "is_legal",
            f"{day_or_open('start_date')} AS from_day",
            f"{day_or_first('end_date')} AS to_day",
        )
    )
    carried = ["base_address", "postcode", *PROPERTY]
    intervals = _occupied(distinct, organisation, hot).selectExpr(
        "uprn",
        f"{day_or_first('start_date')} AS start_day",
        f"{day_or_open('end_date')} AS end_day",
        f"struct(status_rank, {ranks.last_updated()} AS age, {', '.join(carried)}) AS candidate",
    )
    found = best_overlapping(names, intervals, "uprn", hot, small_key, spread_from)
    return _business_variants(
        found.selectExpr("uprn", "name", "is_legal", *[f"candidate.{column}" for column in carried]),
        "BUSINESS_HISTORICAL",
    )


def business_variants(
    organisation: DataFrame, distinct: DataFrame, hot: HotKeys = NO_HOT_KEYS, small_key: int = SMALL_KEY
) -> DataFrame:
    return business_current(organisation, distinct, hot).unionByName(
        business_historical(organisation, distinct, hot, small_key)
    )


# Mail, floors, classification --------------------------------------------------


def best_delivery_point(delivery_point: DataFrame) -> DataFrame:
    known = delivery_point.where("udprn IS NOT NULL")
    columns = known.select("uprn", "udprn", "end_date", "last_update_date")
    return best_per_key(columns, ["uprn"], ranks.latest_valid()).select("uprn", "udprn")


def delivery_variants(delivery_point: DataFrame) -> DataFrame:
    rendered = delivery_address(_PREMISES, _PLACES)
    return _variants(
        delivery_point.where("postcode IS NOT NULL").selectExpr("uprn", "postcode", f"{rendered} AS rendered"),
        carried=False,
        raw_address="rendered",
        source="'DELIVERY_POINT'",
        variant_label="'DELIVERY'",
    ).where("raw_address != ''")


def level_variants(base: DataFrame) -> DataFrame:
    """The base address under the word of its floor; nothing else of the property is carried."""
    worded = base.where("base_address != ''").selectExpr(
        "uprn", "postcode", "base_address", f"{floor_word('level')} AS word"
    )
    return _variants(
        worded.where("word IS NOT NULL"),
        carried=False,
        raw_address="trim(concat(word, ' ', base_address))",
        source="'CUSTOM_LEVEL'",
        variant_label="'CUSTOM_LEVEL'",
    )


def best_classification(classification: DataFrame) -> DataFrame:
    columns = ["uprn", "classification_code", "class_scheme", "end_date", "last_update_date"]
    other_scheme = f"NOT class_scheme <=> {literal(ranks.PREFERRED_CLASS_SCHEME)}"
    best = best_per_key(classification.select(*columns), ["uprn"], [other_scheme, *ranks.latest_valid()])
    return best.select("uprn", "classification_code", "class_scheme")


# Combination -------------------------------------------------------------------


def dedup_variants(variants: DataFrame) -> DataFrame:
    """One row per property and normalised address."""
    normalised = variants.selectExpr(
        "uprn",
        f"{normalise_address('raw_address')} AS address_concat",
        *[name for name in VARIANT if name not in ("uprn", "raw_address", "official_flag")],
    )
    order = [
        "NOT is_primary",
        ranks.logical_status_rank("logical_status"),
        ranks.source_rank("source"),
        ranks.nulls_last("variant_label"),
        ranks.nulls_last("source"),
    ]
    return best_per_key(normalised, ["uprn", "address_concat"], order)


def combine_and_dedupe(
    variants: DataFrame,
    classification_best: DataFrame,
    delivery_best: DataFrame,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """The flatfile: deduplicated variants, a primary for each property, code and postal key.

    Where no variant of a property is primary, the first by source, label and address is.
    """
    deduped = staged(dedup_variants(variants))
    first = f"struct({ranks.source_rank('source')}, {ranks.nulls_last('variant_label')}, address_concat)"
    primaries = deduped.groupBy("uprn").agg(
        F.max("is_primary").alias("has_primary"),
        F.expr(f"min({first}).address_concat").alias("first_address"),
    )
    # One small row per property gathers all that is looked up, for a single join of the variants.
    per_property = primaries.join(
        classification_best.select("uprn", "classification_code"), ["uprn"], "left"
    ).join(delivery_best.select("uprn", "udprn"), ["uprn"], "left")
    is_primary = "CASE WHEN has_primary THEN is_primary ELSE address_concat = first_address END"
    values = {"unique_id": "uprn", "is_primary": is_primary}
    joined = lookup_join(deduped, per_property, ["uprn"], hot)
    return joined.selectExpr(*[f"{values.get(name, name)} AS {name}" for name in OUTPUT])


def abp_flatfile(
    tables: dict[str, DataFrame],
    excluded_statuses: Iterable[int] = ranks.DEFAULT_EXCLUDED_STATUSES,
    crowding: Crowding | None = None,
    small_key: int = SMALL_KEY,
) -> DataFrame:
    """Deduplicated address variants from the six record tables.

    The distinct addresses, which four steps read, and the deduplicated variants, which
    two read, are staged. Unless ``crowding`` is given, crowded keys are counted first.
    ``small_key`` is that of ``best_overlapping``.
    """
    lacking = sorted(set(TABLES) - set(tables))
    if lacking:
        raise ValueError(f"missing record tables: {', '.join(lacking)}")
    tables = {
        name: df if name == "street_descriptor" else df.where("uprn IS NOT NULL")
        for name, df in tables.items()
    }
    if crowding is None:
        crowding = find_crowding(tables)
    base = lpi_base(
        tables["lpi"], tables["blpu"], tables["street_descriptor"], excluded_statuses, crowding
    )
    distinct = staged(lpi_distinct(base, also=["level"]))
    parts = [
        lpi_variants(distinct),
        business_variants(tables["organisation"], distinct, crowding.uprn, small_key),
        delivery_variants(tables["delivery_point"]),
        level_variants(distinct),
    ]
    return combine_and_dedupe(
        reduce(DataFrame.unionByName, parts),
        best_classification(tables["classification"]),
        best_delivery_point(tables["delivery_point"]),
        crowding.uprn,
    )

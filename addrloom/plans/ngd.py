"""Address variants from wide per-feature address files."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.functions import ranks
from addrloom.functions.text import comma_joined, floor_word, listed, literal, strip_postcode
from addrloom.operators.ranking import best_per_key
from addrloom.operators.skew import NO_HOT_KEYS, HotKeys, find_hot_keys, lookup_join, tasks_needed

# File stems of the supply and the order in which the four core
# files are trusted for a property's metadata.
CORE_PRIORITY = {
    "add_gb_builtaddress": 1,
    "add_gb_prebuildaddress": 2,
    "add_gb_nonaddressableobject": 3,
    "add_gb_historicaddress": 4,
}
ALTERNATE_FEATURE_TYPES = {
    "add_gb_builtaddress_altadd": "Built Address",
    "add_gb_historicaddress_altadd": "Historic Address",
    "add_gb_nonaddressableobject_altadd": "Non-Addressable Object",
    "add_gb_prebuildaddress_altadd": "Pre-Build Address",
}
BUILT = "add_gb_builtaddress"
ROYAL_MAIL = "add_gb_royalmailaddress"
EXCLUDABLE = {
    "builtaddress": "add_gb_builtaddress",
    "prebuildaddress": "add_gb_prebuildaddress",
    "historicaddress": "add_gb_historicaddress",
    "nonaddressableobject": "add_gb_nonaddressableobject",
    "royalmailaddress": "add_gb_royalmailaddress",
}
DEFAULT_EXCLUDED = ("historicaddress",)
NON_ADDRESSABLE = "Non-Addressable Object"
WELSH_NAMES = ["wel", "cym", "welsh", "cymraeg"]
CUSTOM_LEVEL_FILE = "CUSTOM_LEVEL"
CUSTOM_LEVEL_TYPE = "Custom Level"

# Rows of the sources that one task enriches and deduplicates; each may give four variants.
ROWS_PER_TASK = 250_000
# A property with more rows than this is spread, at the price of one more exchange of all rows.
HOT_ROWS = 500_000

# The common row of all sources, and the part of it that lookups may fill in.
METADATA = {
    "classificationcode": "string",
    "parentuprn": "bigint",
    "rootuprn": "bigint",
    "hierarchylevel": "int",
    "floorlevel": "string",
    "lowestfloorlevel": "double",
    "highestfloorlevel": "double",
}
COLUMNS = {
    "uprn": "bigint",
    "address_concat": "string",
    "postcode": "string",
    "filename": "string",
    **METADATA,
    "lowertierlocalauthoritygsscode": "string",
    "feature_type": "string",
    "address_status": "string",
    "build_status": "string",
}

_WELSH_TEXT = "alternatelanguagefulladdress"
_WELSH_PARTS = [
    "alternatelanguagesubname",
    "alternatelanguagename",
    "alternatelanguagenumber",
    "alternatelanguagestreetname",
    "alternatelanguagelocality",
    "alternatelanguagetownname",
    "alternatelanguageislandname",
]
_PREMISES = ["organisationname", "departmentname", "subbuildingname", "buildingname", "buildingnumber"]
_PLACES = [
    "dependentthoroughfare",
    "thoroughfare",
    "doubledependentlocality",
    "dependentlocality",
    "posttown",
]


def _common_row(df: DataFrame, **values: str) -> DataFrame:
    """Project onto the common row; columns not given are typed NULLs."""
    return df.selectExpr(
        *[f"CAST({values.get(name, 'NULL')} AS {kind}) AS {name}" for name, kind in COLUMNS.items()]
    )


def _any_given(names: Iterable[str]) -> str:
    return f"coalesce({', '.join(names)}) IS NOT NULL"


def _tracks(df: DataFrame, english: str, welsh: str, is_welsh: str) -> DataFrame:
    """Both languages from one scan: the English address always, the Welsh one if present."""
    both = f"CASE WHEN {is_welsh} THEN array({english}, {welsh}) ELSE array({english}) END"
    return df.selectExpr("*", f"explode({both}) AS track")


def core_addresses(df: DataFrame, filename: str) -> DataFrame:
    """English and Welsh rows of a core feature file."""
    welsh = (
        f"CASE WHEN {_WELSH_TEXT} IS NOT NULL THEN {strip_postcode(_WELSH_TEXT, 'postcode')} "
        f"ELSE {comma_joined(*_WELSH_PARTS)} END"
    )
    is_welsh = (
        f"lower(alternatelanguage) IN ({listed(WELSH_NAMES)}) "
        f"AND {_any_given([_WELSH_TEXT, *_WELSH_PARTS])}"
    )
    return _common_row(
        _tracks(df, strip_postcode("fulladdress", "postcode"), welsh, is_welsh),
        uprn="uprn",
        address_concat="track",
        postcode="postcode",
        filename=literal(filename),
        **{name: name for name in METADATA},
        feature_type="description",
        address_status="addressstatus",
        build_status="buildstatus",
    )


def alternate_addresses(df: DataFrame, filename: str, feature_type: str) -> DataFrame:
    """Rows of an alternate-address file; its metadata comes from the lookups later."""
    return _common_row(
        df,
        uprn="uprn",
        address_concat=strip_postcode("fulladdress", "postcode"),
        postcode="postcode",
        filename=literal(filename),
        floorlevel="floorlevel",
        lowestfloorlevel="lowestfloorlevel",
        highestfloorlevel="highestfloorlevel",
        feature_type=literal(feature_type),
        address_status="addressstatus",
    )


def royal_mail_addresses(df: DataFrame, filename: str) -> DataFrame:
    """English and Welsh postal addresses put together from their components."""
    welsh_places = [f"welsh{name}" for name in _PLACES]
    matched = df.where(f"matchedaddressfeaturetype != {literal(NON_ADDRESSABLE)}")
    return _common_row(
        _tracks(
            matched,
            comma_joined(*_PREMISES, *_PLACES),
            comma_joined(*_PREMISES, *welsh_places),
            _any_given(welsh_places),
        ),
        uprn="uprn",
        address_concat="track",
        postcode="postcode",
        filename=literal(filename),
        feature_type="'Royal Mail Address'",
    )


def _core_metadata(sources: dict[str, DataFrame]) -> DataFrame | None:
    """Metadata columns of every core file given, with the file's priority."""
    authority = "lowertierlocalauthoritygsscode"
    parts = [
        sources[stem].selectExpr(
            "CAST(uprn AS bigint) AS uprn",
            f"{priority} AS source_priority",
            *[f"CAST({name} AS {kind}) AS {name}" for name, kind in METADATA.items()],
            f"CAST({authority if stem == BUILT else 'NULL'} AS string) AS {authority}",
        )
        for stem, priority in CORE_PRIORITY.items()
        if stem in sources
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def metadata_lookup(sources: dict[str, DataFrame]) -> DataFrame:
    """One metadata row per property, from the most trusted core file that has it."""
    core = _core_metadata(sources)
    if core is None:
        return _empty_like(sources, {"uprn": "bigint", **METADATA})
    columns = core.drop("lowertierlocalauthoritygsscode")
    return best_per_key(columns, ["uprn"], ["source_priority"]).drop("source_priority")


def local_authority_lookup(built: DataFrame) -> DataFrame:
    keyed = built.selectExpr(
        "CAST(uprn AS bigint) AS uprn",
        "CAST(lowertierlocalauthoritygsscode AS string) AS lowertierlocalauthoritygsscode",
    )
    authority = F.max("lowertierlocalauthoritygsscode").alias("lowertierlocalauthoritygsscode")
    return keyed.groupBy("uprn").agg(authority)


def property_lookup(sources: dict[str, DataFrame]) -> DataFrame:
    """Metadata and local authority of each property from one aggregate, so one join serves both."""
    core = _core_metadata(sources)
    if core is None:
        return _empty_like(
            sources, {"uprn": "bigint", **METADATA, "lowertierlocalauthoritygsscode": "string"}
        )
    best = F.expr(f"min(struct(source_priority, {', '.join(METADATA)}))").alias("best")
    authority = F.max("lowertierlocalauthoritygsscode").alias("lowertierlocalauthoritygsscode")
    grouped = core.groupBy("uprn").agg(best, authority)
    return grouped.selectExpr("uprn", *[f"best.{name}" for name in METADATA], "lowertierlocalauthoritygsscode")


def _empty_like(sources: dict[str, DataFrame], columns: dict[str, str]) -> DataFrame:
    spark = next(iter(sources.values())).sparkSession
    return spark.createDataFrame([], ", ".join(f"{name} {kind}" for name, kind in columns.items()))


def enrich(addresses: DataFrame, lookup: DataFrame, hot: HotKeys = NO_HOT_KEYS, tasks: int = 0) -> DataFrame:
    """Fill missing metadata from ``property_lookup``; the authority always comes from it.

    ``tasks`` is as in :func:`lookup_join`.
    """
    filled = [*METADATA, "lowertierlocalauthoritygsscode"]
    renamed = lookup.selectExpr("uprn", *[f"{name} AS found_{name}" for name in filled])
    bare = addresses.drop("lowertierlocalauthoritygsscode")
    values = {name: name for name in COLUMNS}
    values |= {name: f"coalesce({name}, found_{name})" for name in METADATA}
    values["lowertierlocalauthoritygsscode"] = "found_lowertierlocalauthoritygsscode"
    return _common_row(lookup_join(bare, renamed, ["uprn"], hot, tasks=tasks), **values)


def floor_level_variants(df: DataFrame) -> DataFrame:
    """The rows, and after each with a nameable floor the same address under that floor's word."""
    worded = df.selectExpr(
        "*", f"CASE WHEN address_concat != '' THEN {floor_word('floorlevel')} END AS word"
    )
    named = ["address_concat", "filename", "feature_type"]
    itself = f"struct({', '.join(named)})"
    variant = (
        "struct(trim(concat(word, ' ', address_concat)) AS address_concat, "
        f"{literal(CUSTOM_LEVEL_FILE)} AS filename, {literal(CUSTOM_LEVEL_TYPE)} AS feature_type)"
    )
    rows = f"CASE WHEN word IS NOT NULL THEN array({itself}, {variant}) ELSE array({itself}) END"
    return worded.selectExpr("*", f"explode({rows}) AS named").selectExpr(
        *[f"named.{name}" if name in named else name for name in COLUMNS]
    )


def dedup_ngd(
    df: DataFrame, feature_type_ranks: dict[str, int] = ranks.FEATURE_TYPE_RANKS
) -> DataFrame:
    """One row per property and address, by feature type, address status and build status."""
    output = [
        "unique_id",
        "address_concat",
        "postcode",
        "filename",
        "classificationcode",
        "parentuprn",
        "lowertierlocalauthoritygsscode",
        "floorlevel",
    ]
    order = {
        "feature_rank": ranks.feature_type_rank("feature_type", feature_type_ranks),
        "address_rank": ranks.address_status_rank("address_status"),
        "build_rank": ranks.build_status_rank("build_status"),
    }
    ranked = (
        df.where(f"feature_type != {literal(NON_ADDRESSABLE)}")
        .withColumnRenamed("uprn", "unique_id")
        .selectExpr(*output, *[f"{rank} AS {name}" for name, rank in order.items()])
    )
    return best_per_key(ranked, ["unique_id", "address_concat"], list(order)).select(*output)


def excluded_stems(excluded: Iterable[str] = DEFAULT_EXCLUDED) -> set[str]:
    """File stems left out of the union; a feature also excludes its alternate file."""
    unknown = set(excluded) - set(EXCLUDABLE)
    if unknown:
        raise ValueError(f"unknown features {sorted(unknown)}; known: {list(EXCLUDABLE)}")
    stems = {EXCLUDABLE[feature] for feature in excluded}
    return stems | {f"{stem}_altadd" for stem in stems}


def source_addresses(
    sources: dict[str, DataFrame], excluded: Iterable[str] = DEFAULT_EXCLUDED
) -> DataFrame:
    """UNION ALL of the common rows of every recognised source that is not excluded."""
    left_out = excluded_stems(excluded)
    parts = []
    for stem, df in sorted(sources.items()):
        filename = f"{stem}.parquet"
        if stem in left_out:
            continue
        if stem in CORE_PRIORITY:
            parts.append(core_addresses(df, filename))
        elif stem in ALTERNATE_FEATURE_TYPES:
            parts.append(alternate_addresses(df, filename, ALTERNATE_FEATURE_TYPES[stem]))
        elif stem == ROYAL_MAIL:
            parts.append(royal_mail_addresses(df, filename))
    if not parts:
        raise ValueError("no address source left to process")
    return reduce(DataFrame.unionByName, parts)


def check_keys(sources: dict[str, DataFrame]) -> None:
    """Every source needs a uprn column, in any letter case. Runs no job."""
    lacking = sorted(
        stem for stem, df in sources.items() if "uprn" not in [name.lower() for name in df.columns]
    )
    if lacking:
        raise ValueError(f"no uprn column in: {', '.join(lacking)}")


def ngd_flatfile(
    sources: dict[str, DataFrame],
    excluded: Iterable[str] = DEFAULT_EXCLUDED,
    feature_type_ranks: dict[str, int] = ranks.FEATURE_TYPE_RANKS,
    hot: HotKeys | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Deduplicated address variants from feature DataFrames keyed by file stem.

    An excluded core file still serves the metadata lookup. Unless ``hot`` is given, one job
    counts the rows per property now. The rows counted are dealt to tasks of ``rows_per_task``;
    None leaves them where they are, for features stored by key, whose buckets are tasks already.
    """
    known = {*CORE_PRIORITY, *ALTERNATE_FEATURE_TYPES, ROYAL_MAIL}
    used = {stem: df for stem, df in sources.items() if stem in known - excluded_stems(excluded)}
    check_keys(used)
    addresses = source_addresses(sources, excluded)
    if hot is None:
        keys = [df.selectExpr("CAST(uprn AS bigint) AS uprn") for df in used.values()]
        hot = find_hot_keys(reduce(DataFrame.union, keys), HOT_ROWS)
    tasks = tasks_needed(addresses.sparkSession, hot.rows, rows_per_task) if rows_per_task else 0
    enriched = enrich(addresses, property_lookup(sources), hot, tasks)
    return dedup_ngd(floor_level_variants(enriched), feature_type_ranks)

"""Priority ranks, labels and dates shared by the plans, as Spark SQL expressions."""

from __future__ import annotations

from collections.abc import Iterable

from addrloom.functions.text import choose, listed

# Lower ranks win.
FEATURE_TYPE_RANKS = {
    "Built Address": 1,
    "Pre-Build Address": 2,
    "Royal Mail Address": 3,
    "Historic Address": 4,
    "Non-Addressable Object": 5,
    "Custom Level": 6,
}
FEATURE_TYPE_DEFAULT_RANK = 9
ADDRESS_STATUS_RANKS = {"approved": 1, "provisional": 2, "alternative": 3, "historical": 9}
BUILD_STATUS_RANKS = {
    "built complete": 1,
    "under construction": 2,
    "prebuild": 3,
    "historic": 8,
    "demolished": 9,
}
STATUS_DEFAULT_RANK = 5

# Logical statuses and the sources of record-table variants.
LOGICAL_STATUS_RANKS = {1: 0, 3: 1, 6: 2, 8: 3}
LOGICAL_STATUS_DEFAULT_RANK = 9
LOGICAL_STATUS_LABELS = {1: "APPROVED", 3: "ALTERNATIVE", 6: "PROVISIONAL", 8: "HISTORICAL"}
DEFAULT_EXCLUDED_STATUSES = (8,)
SOURCE_RANKS = {"LPI": 0, "ORGANISATION": 1, "DELIVERY_POINT": 2, "CUSTOM_LEVEL": 3}
SOURCE_DEFAULT_RANK = 4
PREFERRED_CLASS_SCHEME = "AddressBase Premium Classification Scheme"

# What an open end or an unknown update date stands for.
OPEN_END = "9999-12-31"
UNKNOWN_UPDATE = "0001-01-01"


def feature_type_rank(feature_type: str, ranks: dict[str, int] = FEATURE_TYPE_RANKS) -> str:
    return choose(feature_type, ranks, FEATURE_TYPE_DEFAULT_RANK)


def address_status_rank(status: str) -> str:
    return choose(f"lower({status})", ADDRESS_STATUS_RANKS, STATUS_DEFAULT_RANK)


def build_status_rank(status: str) -> str:
    return choose(f"lower({status})", BUILD_STATUS_RANKS, STATUS_DEFAULT_RANK)


def logical_status_rank(status: str) -> str:
    return choose(status, LOGICAL_STATUS_RANKS, LOGICAL_STATUS_DEFAULT_RANK)


def logical_status_label(status: str) -> str:
    return choose(status, LOGICAL_STATUS_LABELS)


def source_rank(source: str) -> str:
    return choose(source, SOURCE_RANKS, SOURCE_DEFAULT_RANK)


def newest_first(date: str, missing: str) -> str:
    """An ascending sort key that puts the newest date first."""
    return f"-unix_date(coalesce({date}, DATE '{missing}'))"


def latest_valid() -> list[str]:
    """Sort keys of dated records: open or latest-ending first, then latest updated."""
    return [newest_first("end_date", OPEN_END), last_updated()]


def last_updated() -> str:
    return newest_first("last_update_date", UNKNOWN_UPDATE)


def nulls_last(value: str) -> str:
    """An ascending sort key with NULL after every value."""
    return f"struct({value} IS NULL, {value})"


def included_statuses(excluded: Iterable[int] = DEFAULT_EXCLUDED_STATUSES) -> list[int]:
    excluded = set(excluded)
    unknown = excluded - set(LOGICAL_STATUS_RANKS)
    if unknown:
        raise ValueError(f"unknown logical statuses {sorted(unknown)}; known: {list(LOGICAL_STATUS_RANKS)}")
    return [status for status in LOGICAL_STATUS_RANKS if status not in excluded]


def status_is_included(status: str, excluded: Iterable[int]) -> str:
    kept = included_statuses(excluded)
    return f"{status} IN ({listed(kept)})" if kept else "false"


def hierarchy_code(parent: str, has_children: str) -> str:
    """C for a child, P for a parent, S for a property that is neither."""
    return f"CASE WHEN {parent} IS NOT NULL THEN 'C' WHEN {has_children} THEN 'P' ELSE 'S' END"


def chunk_of(key: str, chunks: int) -> str:
    """Zero-based chunk of a key. Equal keys share a chunk; a NULL key has one too."""
    if chunks < 1:
        raise ValueError(f"chunks must be at least 1, got {chunks}")
    return f"CAST(pmod(xxhash64({key}), {chunks}) AS INT)"


def in_chunk(key: str, chunks: int, chunk: int) -> str:
    if not 0 <= chunk < chunks:
        raise ValueError(f"chunk must be in [0, {chunks}), got {chunk}")
    return f"{chunk_of(key, chunks)} = {chunk}"

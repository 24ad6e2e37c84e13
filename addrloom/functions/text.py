"""Address text as Spark SQL expressions.

Every function takes and returns SQL text for ``selectExpr`` and ``where``. Catalyst
sees plain built-in functions, and a wide projection is one call to the JVM.
"""

from __future__ import annotations

# Words put before an address for its floor level.
LEVEL_WORDS = {
    -1: "BASEMENT",
    0: "GROUND",
    1: "FIRST",
    2: "SECOND",
    3: "THIRD",
    4: "FOURTH",
    5: "FIFTH",
    6: "SIXTH",
}


def literal(value) -> str:
    """A Python value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def listed(values) -> str:
    return ", ".join(literal(value) for value in values)


def choose(subject: str, mapping: dict, default=None) -> str:
    """A literal lookup. The subject is evaluated once."""
    entries = listed(part for entry in mapping.items() for part in entry)
    picked = f"element_at(map({entries}), {subject})"
    return picked if default is None else f"coalesce({picked}, {literal(default)})"


def blank_to_null(text: str) -> str:
    return f"nullif({text}, '')"


def strip_postcode(address: str, postcode: str) -> str:
    """Drop ``, <postcode>`` from the end of an address, and any separators left over."""
    kept = f"left({address}, length({address}) - length({postcode}))"
    return (
        f"CASE WHEN endswith({address}, concat(', ', {postcode})) "
        f"THEN trim(TRAILING ', ' FROM {kept}) ELSE {address} END"
    )


def comma_joined(*parts: str) -> str:
    """Parts joined by ``, ``; missing parts leave no separator, ends are trimmed.

    An empty part keeps its separator inside the text; at the ends commas and spaces go.
    """
    return f"trim(BOTH ', ' FROM concat_ws(', ', {', '.join(parts)}))"


def space_joined(*parts: str) -> str:
    return f"trim(concat_ws(' ', {', '.join(parts)}))"


def addressable_object(
    text: str, start: str, start_suffix: str, end: str, end_suffix: str
) -> str:
    """``TEXT 1A-3B``. Without a start number there is no number part at all."""
    first = f"concat({start}, coalesce({start_suffix}, ''))"
    last = f"concat('-', {end}, coalesce({end_suffix}, ''))"
    return space_joined(blank_to_null(text), f"concat({first}, coalesce({last}, ''))")


def base_address(secondary: str, primary: str, street: str, locality: str, town: str) -> str:
    """Both addressable objects, then the non-empty street, locality and town."""
    objects = blank_to_null(space_joined(secondary, primary))
    return space_joined(objects, *[blank_to_null(part) for part in (street, locality, town)])


def delivery_address(premises: list[str], places: list[str]) -> str:
    """Postal address on one line: the premises part, then the non-empty place names."""
    joined = blank_to_null(space_joined(*premises))
    return space_joined(joined, *[blank_to_null(place) for place in places])


def named_address(name: str, address: str) -> str:
    return space_joined(name, address)


def normalise_address(address: str) -> str:
    """Without apostrophes, and with the first run of whitespace made one space.

    Later runs stay as they are. The pattern is anchored and its prefix holds no
    whitespace, so long texts are read once.
    """
    plain = rf"translate({address}, '\'', '')"
    return rf"regexp_replace({plain}, r'^([^\t\n\f\r ]*)[\t\n\f\r ]+', '$1 ')"


def floor_number(floor: str) -> str:
    """The first of the comma-separated levels where it is a whole number, else NULL."""
    first = f"substring_index({floor}, ',', 1)"
    return rf"CASE WHEN {first} RLIKE r'^-?[0-9]+\z' THEN try_cast({first} AS INT) END"


def floor_word(floor: str) -> str:
    return choose(floor_number(floor), LEVEL_WORDS)


BYTE_ORDER_MARK = "\\uFEFF"


def without_bom(line: str) -> str:
    return f"CASE WHEN startswith({line}, '{BYTE_ORDER_MARK}') THEN substring({line}, 2) ELSE {line} END"


def record_identifier(line: str) -> str:
    return f"trim(BOTH '\"' FROM substring_index({line}, ',', 1))"


def clean_name(name: str) -> str:
    """Trimmed, with an empty name as NULL."""
    return blank_to_null(f"trim({name})")

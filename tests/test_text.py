import pytest

from addrloom.functions import ranks, text


@pytest.mark.parametrize(
    "address, postcode, expected",
    [
        ("1, HIGH STREET, ZZ9 4AB", "ZZ9 4AB", "1, HIGH STREET"),
        ("1, HIGH STREET, , ZZ9 4AB", "ZZ9 4AB", "1, HIGH STREET"),
        ("1, HIGH STREET ZZ9 4AB", "ZZ9 4AB", "1, HIGH STREET ZZ9 4AB"),
        ("1, HIGH STREET, ZZ9 4AB", None, "1, HIGH STREET, ZZ9 4AB"),
        (None, "ZZ9 4AB", None),
    ],
)
def test_strip_postcode(value, address, postcode, expected):
    assert value(text.strip_postcode("a", "p"), a=address, p=postcode) == expected


def test_comma_joined_skips_null_and_keeps_inner_blanks(value):
    joined = text.comma_joined("a", "b", "c")
    assert value(joined, a="FLAT 1", b=None, c="CARDIFF") == "FLAT 1, CARDIFF"
    assert value(joined, a="FLAT 1", b=" ", c="CARDIFF") == "FLAT 1,  , CARDIFF"
    assert value(joined, a=", X", b="Y", c="") == "X, Y"
    assert value(joined, a=None, b=None, c=None) == ""


@pytest.mark.parametrize(
    "parts, expected",
    [
        (("FLAT", "1", "A", None, None), "FLAT 1A"),
        (("FLAT", "1", None, "3", "B"), "FLAT 1-3B"),
        (("", None, "A", "3", "B"), ""),
        (("ANNEXE", None, None, None, None), "ANNEXE"),
    ],
)
def test_addressable_object(value, parts, expected):
    columns = dict(zip("tabcd", parts))
    assert value(text.addressable_object(*"tabcd"), **columns) == expected


def test_base_address_drops_empty_parts(value):
    whole = text.base_address("s", "p", "st", "l", "t")
    assert value(whole, s="FLAT 1", p="12", st="MAIN ROAD", l="", t="CARDIFF") == "FLAT 1 12 MAIN ROAD CARDIFF"
    assert value(whole, s="", p="", st=None, l=None, t="CARDIFF") == "CARDIFF"


@pytest.mark.parametrize(
    "address, expected",
    [
        ("a  b   c", "a b   c"),
        ("a \t\n b  c", "a b  c"),
        ("  a  b", " a  b"),
        ("O'BRIEN'S  BAR", "OBRIENS BAR"),
        ("abc", "abc"),
    ],
)
def test_normalise_collapses_only_the_first_run(value, address, expected):
    assert value(text.normalise_address("a"), a=address) == expected


@pytest.mark.parametrize(
    "level, number, word",
    [
        ("1,2", 1, "FIRST"),
        ("-1", -1, "BASEMENT"),
        ("06", 6, "SIXTH"),
        ("7", 7, None),
        ("G", None, None),
        ("1.0", None, None),
        ("", None, None),
        (None, None, None),
        ("99999999999", None, None),
    ],
)
def test_floor(value, level, number, word):
    assert value(text.floor_number("l"), l=level) == number
    assert value(text.floor_word("l"), l=level) == word


def test_record_identifier_and_bom(value):
    assert value(text.record_identifier("l"), l='"24",x') == "24"
    assert value(text.without_bom("l"), l="﻿10,x﻿") == "10,x﻿"


def test_literals_are_escaped(value):
    assert value(text.literal("O'B\\x")) == "O'B\\x"


def test_rank_defaults(value):
    assert value(ranks.feature_type_rank("f"), f="Prebuild Address") == 9
    assert value(ranks.address_status_rank("f"), f="APPROVED") == 1
    assert value(ranks.address_status_rank("f"), f=None) == 5
    assert value(ranks.build_status_rank("f"), f="Demolished") == 9
    assert value(ranks.source_rank("f"), f="OTHER") == 4


def test_included_statuses():
    assert ranks.included_statuses() == [1, 3, 6]
    assert ranks.included_statuses(()) == [1, 3, 6, 8]
    assert ranks.status_is_included("s", (1, 3, 6, 8)) == "false"
    with pytest.raises(ValueError, match="unknown logical statuses"):
        ranks.included_statuses((2,))


def test_chunk_bounds():
    with pytest.raises(ValueError):
        ranks.chunk_of("k", 0)
    with pytest.raises(ValueError):
        ranks.in_chunk("k", 3, 3)

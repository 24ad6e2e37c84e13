import datetime

import pytest

from addrloom.operators.skew import HotKeys
from addrloom.plans import abp
from addrloom.sources.records import SCHEMAS, schema_columns

DAY = datetime.date


def table(spark, name, *rows):
    columns = schema_columns(SCHEMAS[name])
    schema = ", ".join(f"{column} {kind}" for column, kind in columns.items())
    return spark.createDataFrame([tuple(row.get(column) for column in columns) for row in rows], schema)


def street(usrn, language, text, end=None, updated=None, locality=None, town="TOWN"):
    return {
        "usrn": usrn,
        "language": language,
        "street_description": text,
        "locality": locality,
        "town_name": town,
        "end_date": end,
        "last_update_date": updated,
    }


def lpi(uprn, status=1, number=1, usrn=1, language="ENG", **more):
    return {
        "uprn": uprn,
        "lpi_key": f"{uprn}-{status}-{number}",
        "language": language,
        "logical_status": status,
        "pao_start_number": number,
        "usrn": usrn,
        "official_flag": "Y",
    } | more


def blpu(uprn, parent=None, postal="D", postcode="AB1 1AB"):
    return {
        "uprn": uprn,
        "parent_uprn": parent,
        "addressbase_postal": postal,
        "postcode_locator": postcode,
        "blpu_state": "2",
    }


def tables(spark, **rows):
    return {name: table(spark, name, *rows.get(name, ())) for name in abp.TABLES}


@pytest.fixture(scope="module")
def supply(spark):
    return tables(
        spark,
        street_descriptor=[
            street(1, "ENG", "OLD ROAD", end=DAY(2001, 1, 1)),
            street(1, "ENG", "HIGH ROAD", updated=DAY(2010, 1, 1)),
            street(1, "CYM", "HEOL FAWR", updated=DAY(2012, 1, 1)),
        ],
        blpu=[blpu(1), blpu(2, parent=1), blpu(3, postal="N"), blpu(4, postal=None, postcode=None), blpu(5)],
        lpi=[
            lpi(1, number=1, level="0", start_date=DAY(2005, 1, 1)),
            lpi(1, status=3, number=10, start_date=DAY(1990, 1, 1), end_date=DAY(2004, 12, 31)),
            lpi(1, status=8, number=99),
            lpi(2, number=2, language="CYM"),
            lpi(3, number=3),
            lpi(4, number=4, status=6, language=None),
            lpi(5, number=5, usrn=77),
        ],
        delivery_point=[
            {
                "uprn": 1,
                "udprn": 11,
                "building_number": 1,
                "thoroughfare": "HIGH  ROAD",
                "post_town": "TOWN",
                "postcode": "AB1 1AB",
            },
            {"uprn": 1, "udprn": 12, "building_number": 1, "postcode": "AB1 1AB", "end_date": DAY(2000, 1, 1)},
            {"uprn": 9, "udprn": None, "organisation_name": "O'BRIEN", "post_town": "X", "postcode": "Z"},
            {"uprn": 9, "udprn": 91, "organisation_name": "NO POSTCODE"},
        ],
        organisation=[
            {"uprn": 1, "organisation": " CAFE ", "legal_name": "CAFE LTD"},
            {"uprn": 1, "organisation": "INN", "legal_name": "INN", "start_date": DAY(1995, 1, 1), "end_date": DAY(1999, 1, 1)},
            {"uprn": 1, "organisation": "BAR", "start_date": None, "end_date": DAY(2006, 1, 1)},
            {"uprn": 42, "organisation": "NOWHERE", "end_date": DAY(2006, 1, 1)},
        ],
        classification=[
            {"uprn": 1, "classification_code": "X", "class_scheme": "Other"},
            {
                "uprn": 1,
                "classification_code": "RD",
                "class_scheme": "AddressBase Premium Classification Scheme",
                "end_date": DAY(2000, 1, 1),
            },
        ],
    )


EXPECTED = {
    # key, address, source, label, primary
    (1, "1 HIGH ROAD TOWN", "LPI", "APPROVED", True),
    (1, "10 HIGH ROAD TOWN", "LPI", "ALTERNATIVE", False),
    (1, "CAFE 1 HIGH ROAD TOWN", "ORGANISATION", "BUSINESS_CURRENT", False),
    (1, "CAFE LTD 1 HIGH ROAD TOWN", "ORGANISATION", "BUSINESS_CURRENT_LEGAL", False),
    (1, "INN 10 HIGH ROAD TOWN", "ORGANISATION", "BUSINESS_HISTORICAL", False),
    (1, "BAR 1 HIGH ROAD TOWN", "ORGANISATION", "BUSINESS_HISTORICAL", False),
    (1, "1 HIGH  ROAD TOWN", "DELIVERY_POINT", "DELIVERY", False),
    (1, "1", "DELIVERY_POINT", "DELIVERY", False),
    (1, "GROUND 1 HIGH ROAD TOWN", "CUSTOM_LEVEL", "CUSTOM_LEVEL", False),
    (2, "2 HEOL FAWR TOWN", "LPI", "APPROVED", True),
    (4, "4 HEOL FAWR TOWN", "LPI", "PROVISIONAL", True),
    (5, "5", "LPI", "APPROVED", True),
    (9, "OBRIEN X", "DELIVERY_POINT", "DELIVERY", True),
}


def listing(flatfile):
    columns = ["unique_id", "address_concat", "source", "variant_label", "is_primary"]
    return {tuple(row) for row in flatfile.select(columns).collect()}


def test_flatfile(supply):
    flatfile = abp.abp_flatfile(supply)
    assert flatfile.columns == abp.OUTPUT
    rows = flatfile.collect()
    assert len(rows) == len(EXPECTED)
    assert listing(flatfile) == EXPECTED
    by_address = {(row["unique_id"], row["address_concat"]): row for row in rows}
    approved = by_address[1, "1 HIGH ROAD TOWN"]
    assert (approved["classification_code"], approved["udprn"], approved["hierarchy_level"]) == ("RD", 11, "P")
    assert (approved["postcode"], approved["blpu_state"], approved["postal_address_code"]) == ("AB1 1AB", "2", "D")
    assert by_address[2, "2 HEOL FAWR TOWN"]["hierarchy_level"] == "C"
    assert by_address[5, "5"]["hierarchy_level"] == "S"
    floor = by_address[1, "GROUND 1 HIGH ROAD TOWN"]
    assert floor["logical_status"] is None and floor["hierarchy_level"] is None


def test_hot_keys_change_nothing(supply):
    crowding = abp.Crowding(uprn=HotKeys({1: 3, 9: 2}, null_groups=2), usrn=HotKeys({1: 4}))
    assert listing(abp.abp_flatfile(supply, crowding=crowding)) == EXPECTED


def test_historic_status_may_be_included(supply):
    more = listing(abp.abp_flatfile(supply, excluded_statuses=()))
    assert more - EXPECTED == {(1, "99 HIGH ROAD TOWN", "LPI", "HISTORICAL", False)}
    assert not [row for row in listing(abp.abp_flatfile(supply, (1, 3, 6, 8))) if row[2] == "LPI"]


def test_every_property_has_a_primary(supply):
    per_key = abp.abp_flatfile(supply).groupBy("unique_id").agg({"is_primary": "max"})
    assert per_key.where("NOT `max(is_primary)`").isEmpty()


def test_two_approved_addresses_stay_primary(spark):
    supply = tables(spark, blpu=[blpu(1)], lpi=[lpi(1, number=1), lpi(1, number=2)])
    assert {row["is_primary"] for row in abp.abp_flatfile(supply).collect()} == {True}


def test_street_falls_back_per_column(spark):
    streets = table(
        spark,
        "street_descriptor",
        street(1, "ENG", None, town="TOWN"),
        street(1, "CYM", "HEOL", updated=DAY(2020, 1, 1), town="TREF", locality="LLE"),
    )
    rows = [{**lpi(1, number=i), "usrn": 1, "language": language} for i, language in enumerate(["ENG", None, "GAE"])]
    base = abp.lpi_base(table(spark, "lpi", *rows), table(spark, "blpu", blpu(1)), streets)
    assert {row["base_address"] for row in base.collect()} == {
        "0 HEOL LLE TOWN",
        "1 HEOL LLE TREF",
        "2 HEOL LLE TREF",
    }


def test_best_street_only_of_used_ones(spark):
    streets = table(spark, "street_descriptor", street(1, "ENG", "A"), street(2, "ENG", "B"))
    used = spark.createDataFrame([(1, "ENG")], "usrn int, language string")
    assert [row["usrn"] for row in abp.best_street_by_language(streets, used).collect()] == [1]
    assert [row["usrn"] for row in abp.best_street_any(streets, used).collect()] == [1]


def test_occupier_names(spark):
    rows = [("A", "A"), ("A", "B"), ("", "B"), (None, " "), (" ", None)]
    organisation = table(
        spark, "organisation", *[{"uprn": 1, "organisation": o, "legal_name": n} for o, n in rows]
    )
    got = sorted((row["name"], row["is_legal"]) for row in abp.occupier_names(organisation).collect())
    assert got == [("A", False), ("A", False), ("B", True), ("B", True)]


def test_delivery_keeps_inner_blanks(spark):
    mail = table(
        spark,
        "delivery_point",
        {"uprn": 1, "postcode": "P", "department_name": "D", "organisation_name": "", "building_number": 3, "post_town": "T"},
        {"uprn": 2, "postcode": "P", "department_name": ""},
    )
    assert [row["raw_address"] for row in abp.delivery_variants(mail).collect()] == ["D  3 T"]


def test_best_delivery_point_is_the_latest_valid(spark):
    mail = table(
        spark,
        "delivery_point",
        {"uprn": 1, "udprn": 1, "end_date": DAY(2020, 1, 1), "last_update_date": DAY(2021, 1, 1)},
        {"uprn": 1, "udprn": 2, "last_update_date": DAY(1999, 1, 1)},
        {"uprn": 1, "udprn": 3, "last_update_date": None},
        {"uprn": 1, "udprn": None, "last_update_date": DAY(2022, 1, 1)},
    )
    assert [tuple(row) for row in abp.best_delivery_point(mail).collect()] == [(1, 2)]


def test_missing_table(supply):
    with pytest.raises(ValueError, match="missing record tables: blpu"):
        abp.abp_flatfile({name: df for name, df in supply.items() if name != "blpu"})


def test_plans_are_lazy_and_lean(spark, supply):
    lpi_table, blpu_table, streets = (supply[n] for n in ("lpi", "blpu", "street_descriptor"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "")
    try:
        base = abp.lpi_base(lpi_table, blpu_table, streets)
        abp.business_current(supply["organisation"], abp.lpi_distinct(base))
        assert len(tracker.getJobIdsForGroup("lazy")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = base._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 6
    assert plan.count("Scan ExistingRDD") == 3


def test_repeated_property_rows(spark):
    """Copies of a property's row count once, differing rows each."""
    rows = tables(spark, blpu=[blpu(1), blpu(1), blpu(1, postcode="ZZ9 4AB"), blpu(2, parent=1)], lpi=[lpi(1), lpi(2)])
    got = abp.lpi_base(rows["lpi"], rows["blpu"], rows["street_descriptor"])
    found = sorted((row["uprn"], row["postcode"], row["hierarchy_level"]) for row in got.collect())
    assert found == [(1, "AB1 1AB", "P"), (1, "ZZ9 4AB", "P"), (2, "AB1 1AB", "C")]

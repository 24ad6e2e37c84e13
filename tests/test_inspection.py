import pytest
from pyspark.sql import functions as F

from addrloom.plans import inspection


@pytest.fixture(scope="module")
def flat(spark):
    rows = [
        (1001, "B", "LPI", "APPROVED", True),
        (1001, "A", "CUSTOM_LEVEL", "CUSTOM_LEVEL", False),
        (1002, "C", None, None, None),
        (1003, "D", "LPI", "APPROVED", True),
        (1003, "E", "LPI", "ALTERNATIVE", False),
        (1003, "F", "DELIVERY_POINT", "DELIVERY", False),
    ]
    return spark.createDataFrame(
        rows, "unique_id bigint, address_concat string, source string, variant_label string, is_primary boolean"
    )


def test_statistics(flat):
    assert inspection.variant_statistics(flat).first().asDict() == {
        "total_uprns": 3,
        "total_variants": 6,
        "mean_variants": 2.0,
        "median_variants": 2.0,
        "min_variants": 1,
        "max_variants": 3,
    }
    two = flat.where("unique_id > 1001")
    assert inspection.variant_statistics(two).first()["median_variants"] == 2.0
    assert inspection.variant_summary(flat.where("address_concat != 'A'"))["mean_variants"] == 1.67


def test_statistics_of_nothing(flat):
    nothing = flat.where("false")
    assert set(inspection.variant_summary(nothing).values()) == {0}
    assert tuple(inspection.variant_uplift(nothing).first()) == (0, 0, 0.0)


def test_uplift(flat):
    assert tuple(inspection.variant_uplift(flat).first()) == (3, 6, 100.0)


def test_top_keys(flat):
    assert [row["unique_id"] for row in inspection.top_keys(flat, 2).collect()] == [1003, 1001]
    assert [row["unique_id"] for row in inspection.top_keys(flat, 5, F.col("source") == "LPI").collect()] == [1003, 1001]
    assert inspection.top_key_at_offset(flat, 1).first()["unique_id"] == 1001
    assert inspection.top_key_at_offset(flat, 9).first() is None
    with pytest.raises(ValueError):
        inspection.top_key_at_offset(flat, -1)


def test_key_variants_in_listing_order(flat):
    rows = inspection.key_variants(flat, 1003).collect()
    assert [row["address_concat"] for row in rows] == ["D", "F", "E"]
    assert inspection.key_variants(flat, 1003, "source = 'LPI'").count() == 2
    assert inspection.key_variants(flat, 1003, columns=["none"]).columns == flat.columns


def test_listing_without_report_columns(spark):
    narrow = spark.createDataFrame([(1, "B"), (1, "A")], "unique_id bigint, address_concat string")
    assert [row["address_concat"] for row in inspection.key_variants(narrow, 1).collect()] == ["A", "B"]


def test_random_keys(flat):
    assert inspection.random_key(flat, seed=1).select("unique_id").distinct().count() == 1
    large = inspection.random_large_key(flat, 1).collect()
    assert {row["unique_id"] for row in large} == {1003}
    with pytest.raises(LookupError):
        inspection.random_large_key(flat, 5, "source = 'none'")


def test_inspection(flat):
    top = inspection.inspect_variants(flat, sample_limit=2)
    assert (top.selected_key, top.variant_count, top.sample_rows.count(), top.key_rows.count()) == (1003, 3, 2, 3)
    chosen = inspection.inspect_variants(flat, key=1001)
    assert (chosen.selected_key, chosen.variant_count) == (1001, 2)
    assert inspection.inspect_variants(flat, key=5).variant_count == 0
    with pytest.raises(ValueError):
        inspection.inspect_variants(flat, sample_limit=0)
    with pytest.raises(LookupError):
        inspection.inspect_variants(flat, offset=99)


def test_written_flatfile_is_read_back(spark, flat, tmp_path):
    from addrloom.sinks.parquet import write_flatfile

    with_postcode = flat.withColumn("postcode", F.lit(None).cast("string"))
    write_flatfile(with_postcode, str(tmp_path / "out"), chunks=2)
    assert inspection.flatfile(spark, str(tmp_path / "out")).count() == 6


def test_rows_without_a_key_are_a_group(spark):
    rows = [(None, "A"), (None, "B"), (None, "C"), (5, "D")]
    df = spark.createDataFrame(rows, "unique_id bigint, address_concat string")
    found = inspection.inspect_variants(df)
    assert (found.selected_key, found.variant_count, found.key_rows.count()) == (None, 3, 3)
    assert inspection.random_large_key(df, top_n=1, seed=3).count() == 3
    assert {inspection.random_key(df, seed).count() for seed in range(20)} == {1, 3}
    assert inspection.key_variants(df, 5).count() == 1


def test_picks_follow_the_seed_and_not_the_layout(spark):
    df = spark.range(500).selectExpr("id % 50 AS unique_id", "CAST(id AS string) AS address_concat")
    for pick in (lambda d: inspection.random_key(d, seed=4), lambda d: inspection.sample_rows(d, 7, seed=4)):
        assert sorted(pick(df.repartition(1)).collect()) == sorted(pick(df.repartition(9)).collect())

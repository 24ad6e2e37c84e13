import pytest
from pyspark.sql import functions as F

from addrloom.functions import ranks
from addrloom.operators.skew import HotKeys, lookup_join
from addrloom.plans import ngd
from addrloom.sinks.parquet import output_metadata, write_flatfile
from addrloom.sources.features import convert_feature_csv, read_feature_csv

WELSH = ["subname", "name", "number", "streetname", "locality", "townname", "islandname"]
CORE = (
    ["uprn", "description", "postcode", "fulladdress"]
    + [f"alternatelanguage{part}" for part in WELSH]
    + ["alternatelanguage", "alternatelanguagefulladdress", "floorlevel", "lowestfloorlevel"]
    + ["highestfloorlevel", "classificationcode", "buildstatus", "addressstatus", "parentuprn"]
    + ["rootuprn", "hierarchylevel", "lowertierlocalauthoritygsscode"]
)
ALTERNATE = ["uprn", "addressstatus", "postcode", "fulladdress", "floorlevel", "lowestfloorlevel", "highestfloorlevel"]
PLACES = ["dependentthoroughfare", "thoroughfare", "doubledependentlocality", "dependentlocality", "posttown"]
ROYAL = (
    ["uprn", "postcode", "matchedaddressfeaturetype", "organisationname", "departmentname"]
    + ["subbuildingname", "buildingname", "buildingnumber", *PLACES, *[f"welsh{p}" for p in PLACES]]
)
OUTPUT = [
    "unique_id",
    "address_concat",
    "postcode",
    "filename",
    "classificationcode",
    "parentuprn",
    "lowertierlocalauthoritygsscode",
    "floorlevel",
]


def frame(spark, columns, *rows):
    schema = ", ".join(f"{name} string" for name in columns)
    return spark.createDataFrame([tuple(row.get(name) for name in columns) for row in rows], schema)


TOWN, WELSH_TOWN, POSTCODE = "EASTHAVEN", "HAFAN DDWYRAIN", "ZZ9 4AB"


def built(**changes):
    """A workshop on the second floor, with an address in either language."""
    return {
        "uprn": "7001",
        "description": "Built Address",
        "postcode": POSTCODE,
        "fulladdress": f"STUDIO 3, MILL HOUSE, QUAY STREET, {TOWN}, {POSTCODE}",
        "alternatelanguage": "wel",
        "alternatelanguagename": "TY MELIN",
        "alternatelanguagestreetname": "STRYD Y CEI",
        "alternatelanguagetownname": WELSH_TOWN,
        "alternatelanguagefulladdress": f"STIWDIO 3, TY MELIN, STRYD Y CEI, {WELSH_TOWN}, {POSTCODE}",
        "floorlevel": "2",
        "lowestfloorlevel": "2.0",
        "highestfloorlevel": "3.0",
        "classificationcode": "CO01",
        "buildstatus": "Built Complete",
        "addressstatus": "Approved",
        "parentuprn": "7100",
        "rootuprn": "7200",
        "hierarchylevel": "3",
        "lowertierlocalauthoritygsscode": "W99000007",
    } | changes


def royal(**changes):
    """The firm in it, by mail."""
    return {
        "uprn": "7001",
        "postcode": POSTCODE,
        "matchedaddressfeaturetype": "Built Address",
        "organisationname": "HARBOUR PRINTS",
        "buildingname": "MILL HOUSE",
        "thoroughfare": "QUAY STREET",
        "posttown": TOWN,
        "welshthoroughfare": "STRYD Y CEI",
        "welshposttown": WELSH_TOWN,
    } | changes


NO_WELSH = {name: None for name in CORE if name.startswith("alternatelanguage")}
# A barn that is gone, and a plot with nothing on it yet.
HISTORIC = {
    "uprn": "7010",
    "description": "Historic Address",
    "postcode": POSTCODE,
    "fulladdress": f"BARN, QUAY STREET, {TOWN}",
    "classificationcode": "LB",
    "buildstatus": "Demolished",
    "addressstatus": "Historical",
}
PREBUILD = {
    "uprn": "7020",
    "description": "Prebuild Address",
    "postcode": POSTCODE,
    "fulladdress": f"PLOT 12, NEW CLOSE, {TOWN}, {POSTCODE}",
    "classificationcode": "PP",
    "buildstatus": "Prebuild",
    "addressstatus": "Provisional",
    "parentuprn": "7021",
    "lowertierlocalauthoritygsscode": "W99000008",
}
# Another name of the workshop, for its gallery one floor up.
ALTERNATIVE = {
    "uprn": "7001",
    "addressstatus": "Alternative",
    "postcode": POSTCODE,
    "fulladdress": f"THE GALLERY, MILL HOUSE, {TOWN}, {POSTCODE}",
    "floorlevel": "3",
    "lowestfloorlevel": "3.0",
    "highestfloorlevel": "3.0",
}


@pytest.fixture(scope="module")
def sources(spark):
    return {
        "add_gb_builtaddress": frame(spark, CORE, built()),
        "add_gb_builtaddress_altadd": frame(spark, ALTERNATE, ALTERNATIVE),
        "add_gb_historicaddress": frame(spark, CORE, HISTORIC),
        "add_gb_prebuildaddress": frame(spark, CORE, PREBUILD),
        "add_gb_royalmailaddress": frame(spark, ROYAL, royal()),
    }


def expected(historic=True):
    """Every address once and, where it has a floor, once more under the floor's word."""
    workshop = ("CO01", 7100, "W99000007")
    found = [
        (7001, f"STUDIO 3, MILL HOUSE, QUAY STREET, {TOWN}", "add_gb_builtaddress", *workshop, "2"),
        (7001, f"STIWDIO 3, TY MELIN, STRYD Y CEI, {WELSH_TOWN}", "add_gb_builtaddress", *workshop, "2"),
        (7001, f"THE GALLERY, MILL HOUSE, {TOWN}", "add_gb_builtaddress_altadd", *workshop, "3"),
        (7001, f"HARBOUR PRINTS, MILL HOUSE, QUAY STREET, {TOWN}", "add_gb_royalmailaddress", *workshop, "2"),
        (7001, f"HARBOUR PRINTS, MILL HOUSE, STRYD Y CEI, {WELSH_TOWN}", "add_gb_royalmailaddress", *workshop, "2"),
        (7020, f"PLOT 12, NEW CLOSE, {TOWN}", "add_gb_prebuildaddress", "PP", 7021, None, None),
    ]
    if historic:
        found.append((7010, f"BARN, QUAY STREET, {TOWN}", "add_gb_historicaddress", "LB", None, None, None))
    words = {"2": "SECOND", "3": "THIRD"}
    rows = [(uprn, text, POSTCODE, f"{stem}.parquet", *rest) for uprn, text, stem, *rest in found]
    rows += [(uprn, f"{words[rest[-1]]} {text}", POSTCODE, "CUSTOM_LEVEL", *rest) for uprn, text, _, *rest in found if rest[-1]]
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_flatfile_of_all_sources(sources):
    flatfile = ngd.ngd_flatfile(sources, excluded=())
    assert flatfile.columns == OUTPUT
    assert rows_of(flatfile) == expected()


def test_historic_is_excluded_by_default(sources):
    assert rows_of(ngd.ngd_flatfile(sources)) == expected(historic=False)


def test_hot_keys_change_nothing(sources):
    hot = HotKeys({7001: 3}, null_groups=2)
    assert rows_of(ngd.ngd_flatfile(sources, excluded=(), hot=hot)) == expected()


def test_the_rows_of_a_task_do_not_grow_with_the_sources(spark, many_partitions):
    texts = {name: f"CAST(NULL AS string) AS {name}" for name in CORE}
    texts |= {"uprn": "CAST(id AS string) AS uprn", "fulladdress": "id || ' QUAY STREET' AS fulladdress"}
    many = {ngd.BUILT: spark.range(20_000).selectExpr(*texts.values()).withColumn("description", F.lit("Built Address"))}
    flat = ngd.ngd_flatfile(many, rows_per_task=1000)
    assert flat.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2000
    assert rows_of(flat) == rows_of(ngd.ngd_flatfile(many, rows_per_task=None))


def test_a_crowded_property_is_spread_before_it_fills_a_task(sources, monkeypatch):
    found = []
    monkeypatch.setattr(ngd, "HOT_ROWS", 2)
    monkeypatch.setattr(ngd, "lookup_join", lambda *given, **named: found.append(given[3]) or lookup_join(*given, **named))
    assert rows_of(ngd.ngd_flatfile(sources, excluded=())) == expected()
    assert found[0].groups[7001] > 1


def test_the_chunks_query_builds_one_chunk_after_another(spark, sources, monkeypatch):
    from checks import queries

    monkeypatch.setattr(queries, "_features", lambda *_: sources)
    chunked = queries.QUERIES["ngd_flatfile_chunked"](spark, "")
    assert rows_of(chunked) == expected(historic=False)
    # What is left is reading them: no task joins or sorts rows of several chunks.
    plan = chunked._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("Join", "Sort", "Window", "Exchange"))


@pytest.mark.parametrize("sort", [True, False])
def test_chunks_together_are_the_whole(spark, sources, tmp_path, sort):
    flatfile = ngd.ngd_flatfile(sources, excluded=())
    assert write_flatfile(flatfile, str(tmp_path / "out"), chunks=3, sort=sort) == 12
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(stored.drop("chunk").select(OUTPUT)) == expected()
    per_key = stored.groupBy("unique_id").agg(F.countDistinct("chunk").alias("n"))
    assert per_key.where("n > 1").isEmpty()
    assert {row[0] for row in stored.select("chunk").distinct().collect()} <= {1, 2, 3}


def test_output_is_sorted_compressed_and_kept(spark, sources, tmp_path):
    path = str(tmp_path / "out")
    flatfile = ngd.ngd_flatfile(sources, excluded=())
    assert write_flatfile(flatfile, path) == 12
    assert write_flatfile(flatfile, path) is None
    assert write_flatfile(flatfile, path, overwrite=True) == 12
    import pyarrow.parquet as pq

    order = []
    for file in sorted((tmp_path / "out").glob("*.parquet")):
        parquet = pq.ParquetFile(file)
        if parquet.metadata.num_rows:
            assert parquet.metadata.row_group(0).column(0).compression == "ZSTD"
        order += [(row["postcode"], row["unique_id"]) for row in parquet.read().to_pylist()]
    assert order == sorted(order, key=lambda row: (row[0] is None, row[0] or "", row[1]))
    metadata = output_metadata(spark, path)
    sizes = [file.stat().st_size for file in (tmp_path / "out").glob("*.parquet")]
    assert (metadata.files, metadata.records, metadata.size_bytes) == (len(sizes), 12, sum(sizes))
    assert output_metadata(spark, str(tmp_path / "none")).files == 0


def test_csv_features(spark, tmp_path):
    header = ",".join(CORE)
    values = ",".join(f'"{built()[name]}"' if built().get(name) else "" for name in CORE)
    (tmp_path / "add_gb_builtaddress.csv").write_text(f"{header}\n{values}\n")
    read = read_feature_csv(spark, str(tmp_path / "add_gb_builtaddress.csv"))
    assert set(dict(read.dtypes).values()) == {"string"}
    assert convert_feature_csv(read, str(tmp_path / "built"))
    assert not convert_feature_csv(read, str(tmp_path / "built"))
    stored = {"add_gb_builtaddress": spark.read.parquet(str(tmp_path / "built"))}
    assert ngd.ngd_flatfile(stored).count() == 4


def test_no_duplicate_key_and_address(spark):
    rows = [built(uprn=str(i % 3), fulladdress=f"{i % 5}, ROAD, {POSTCODE}") for i in range(60)]
    flatfile = ngd.ngd_flatfile({"add_gb_builtaddress": frame(spark, CORE, *rows)})
    assert flatfile.groupBy("unique_id", "address_concat").count().where("count > 1").isEmpty()


def test_prebuild_description_ranks_last_unless_told(spark):
    same = {"fulladdress": "SAME", **NO_WELSH, "floorlevel": None}
    both = {
        "add_gb_prebuildaddress": frame(spark, CORE, built(description="Prebuild Address", **same)),
        "add_gb_royalmailaddress": frame(
            spark, ROYAL, {"uprn": "7001", "matchedaddressfeaturetype": "x", "posttown": "SAME"}
        ),
    }
    assert [r["filename"] for r in ngd.ngd_flatfile(both).collect()] == ["add_gb_royalmailaddress.parquet"]
    told = ranks.FEATURE_TYPE_RANKS | {"Prebuild Address": 2}
    preferred = ngd.ngd_flatfile(both, feature_type_ranks=told).collect()
    assert [r["filename"] for r in preferred] == ["add_gb_prebuildaddress.parquet"]


def test_excluded_core_file_still_serves_the_lookup(spark):
    sources = {
        "add_gb_builtaddress": frame(spark, CORE, built()),
        "add_gb_royalmailaddress": frame(spark, ROYAL, royal()),
    }
    rows = ngd.ngd_flatfile(sources, excluded=("builtaddress",)).collect()
    assert {row["classificationcode"] for row in rows} == {"CO01"}
    assert {row["lowertierlocalauthoritygsscode"] for row in rows} == {"W99000007"}


def test_metadata_prefers_built_over_historic(spark):
    sources = {
        "add_gb_historicaddress": frame(spark, CORE, built(classificationcode="A")),
        "add_gb_builtaddress": frame(spark, CORE, built(classificationcode="Z")),
    }
    assert ngd.metadata_lookup(sources).first()["classificationcode"] == "Z"


def test_missing_addresses_collapse_to_one_row(spark):
    rows = [built(fulladdress=None, postcode=p, **NO_WELSH) for p in ("A", "B")]
    flatfile = ngd.ngd_flatfile({"add_gb_builtaddress": frame(spark, CORE, *rows)}).collect()
    assert [row["address_concat"] for row in flatfile] == [None]


def test_non_addressable_object_keeps_only_its_floor_variant(spark):
    row = built(description="Non-Addressable Object", fulladdress=f"SHED, {POSTCODE}", **NO_WELSH)
    sources = {"add_gb_nonaddressableobject": frame(spark, CORE, row)}
    flatfile = ngd.ngd_flatfile(sources).collect()
    assert [(r["address_concat"], r["filename"]) for r in flatfile] == [("SECOND SHED", "CUSTOM_LEVEL")]


def test_feature_type_null_is_dropped(spark):
    assert ngd.ngd_flatfile({"add_gb_builtaddress": frame(spark, CORE, built(description=None, floorlevel=None))}).isEmpty()


def test_null_key_is_kept(spark):
    sources = {"add_gb_builtaddress": frame(spark, CORE, built(uprn=None, floorlevel=None, **NO_WELSH))}
    assert [row["unique_id"] for row in ngd.ngd_flatfile(sources).collect()] == [None]


def test_unmatched_and_non_addressable_mail_is_left_out(spark):
    df = frame(
        spark,
        ROYAL,
        royal(matchedaddressfeaturetype="Non-Addressable Object"),
        royal(matchedaddressfeaturetype=None),
        royal(posttown="KEPT"),
    )
    assert ngd.royal_mail_addresses(df, "f").count() == 2


def test_welsh_components_without_full_text(spark):
    rows = ngd.core_addresses(frame(spark, CORE, built(alternatelanguagefulladdress=None)), "f").collect()
    assert rows[1]["address_concat"] == f"TY MELIN, STRYD Y CEI, {WELSH_TOWN}"


def test_missing_key_column_names_the_files(spark, sources):
    broken = sources | {
        "add_gb_royalmailaddress": sources["add_gb_royalmailaddress"].drop("uprn"),
        "add_gb_prebuildaddress": sources["add_gb_prebuildaddress"].withColumnRenamed("uprn", "UPRN"),
    }
    with pytest.raises(ValueError, match="no uprn column in: add_gb_royalmailaddress$"):
        ngd.ngd_flatfile(broken)


def test_exclusions_cover_alternate_files():
    assert ngd.excluded_stems(("builtaddress",)) == {"add_gb_builtaddress", "add_gb_builtaddress_altadd"}
    with pytest.raises(ValueError, match="unknown features"):
        ngd.excluded_stems(("builtaddresses",))


def test_lookup_without_core_files_is_empty(spark):
    sources = {"add_gb_royalmailaddress": frame(spark, ROYAL, royal())}
    assert ngd.metadata_lookup(sources).isEmpty()
    assert ngd.ngd_flatfile(sources).count() == 2


def test_nothing_left_to_process(spark, sources):
    with pytest.raises(ValueError, match="no address source"):
        ngd.ngd_flatfile({"other": sources["add_gb_builtaddress"]})

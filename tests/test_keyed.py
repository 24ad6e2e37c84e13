import pytest
from pyspark.sql import functions as F

from addrloom.build import build_ngd_by_chunk
from addrloom.functions.ranks import in_chunk
from addrloom.operators.skew import NO_HOT_KEYS, HotKeys
from addrloom.plans import abp, ngd
from addrloom.plans.inspection import flatfile
from addrloom.sinks.parquet import reopen_chunk
from addrloom.sources.keyed import read_keyed, write_keyed
from tests.test_ngd import CORE, built

LOOSE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def exact_plans(spark):
    """Plans as they are before anything is measured, without broadcasts."""
    before = {name: spark.conf.get(name, None) for name in LOOSE}
    for name, value in LOOSE.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def codes(spark, n=500, hot=0):
    rows = [(i if i % 50 else None, f"C{i % 7}", "Other", None, None) for i in range(n)]
    rows += [(7, f"H{i % 9}", "Other", None, None) for i in range(hot)]
    kinds = "uprn bigint, classification_code string, class_scheme string, end_date date, last_update_date date"
    return spark.createDataFrame(rows, kinds)


def mail(spark, n=400):
    rows = [(i, 1000 + i, None, None) for i in range(n)]
    return spark.createDataFrame(rows, "uprn bigint, udprn bigint, end_date date, last_update_date date")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_tables_come_back_whole_and_by_chunk(spark, tmp_path):
    path = str(tmp_path / "keyed")
    given = {"classification": codes(spark, hot=2000), "delivery_point": mail(spark)}
    assert write_keyed(given, path, chunks=3, buckets=4)
    assert not write_keyed(given, path, chunks=3, buckets=4)
    stored = read_keyed(spark, path)
    for name, df in given.items():
        assert rows_of(stored.whole()[name]) == rows_of(df)
        for chunk in range(3):
            assert rows_of(stored.chunk(chunk)[name]) == rows_of(df.where(in_chunk("uprn", 3, chunk)))
    with pytest.raises(ValueError, match="chunk must be in"):
        stored.chunk(3)


def test_buckets_grow_in_number_and_not_in_size(spark, tmp_path):
    given = {"classification": codes(spark), "delivery_point": mail(spark)}
    for asked, rows_per_bucket, made in ((4, 1000, 4), (4, 50, 9), (12, 50, 12)):
        path = str(tmp_path / f"keyed-{asked}-{rows_per_bucket}")
        write_keyed(given, path, chunks=2, buckets=asked, rows_per_bucket=rows_per_bucket)
        stored = read_keyed(spark, path)
        assert stored.buckets == made
        assert {name: rows_of(df) for name, df in stored.whole().items()} == {name: rows_of(df) for name, df in given.items()}


def test_text_keys_empty_tables_and_tables_without_a_key(spark, tmp_path):
    path = str(tmp_path / "keyed")
    text = spark.createDataFrame([("2", "b"), (None, "c")], "UPRN string, `odd name` string")
    write_keyed({"text": text, "none": mail(spark, 0)}, path, chunks=2, buckets=2)
    stored = read_keyed(spark, path).whole()
    assert rows_of(stored["text"]) == [(2, "b"), (None, "c")]
    assert stored["none"].columns == mail(spark, 0).columns and stored["none"].isEmpty()
    with pytest.raises(ValueError, match="needs one column uprn"):
        write_keyed({"bad": text.select("odd name")}, path, overwrite=True)
    with pytest.raises(ValueError, match="no tables"):
        write_keyed({}, path)


def test_a_chunk_reads_its_own_folder_only(spark, tmp_path):
    path = str(tmp_path / "keyed")
    write_keyed({"delivery_point": mail(spark)}, path, chunks=4, buckets=2)
    part = read_keyed(spark, path).chunk(1)["delivery_point"]
    files = {r[0] for r in part.select(F.input_file_name()).distinct().collect()}
    assert files and all("/key_chunk=1/" in name for name in files)
    assert "key_chunk" in plan_of(part).split("PartitionFilters")[1].split("]")[0]


def test_steps_by_key_need_no_exchange(spark, tmp_path, exact_plans):
    path = str(tmp_path / "keyed")
    given = {"classification": codes(spark), "delivery_point": mail(spark)}
    write_keyed(given, path, chunks=2, buckets=4)
    stored = read_keyed(spark, path)

    def attributes(tables):
        best = abp.best_classification(tables["classification"])
        return best.join(abp.best_delivery_point(tables["delivery_point"]), "uprn", "full")

    for tables in (stored.whole(), stored.chunk(1)):
        assert "Exchange" not in plan_of(attributes(tables))
    assert "Exchange" in plan_of(attributes(given))
    assert rows_of(attributes(stored.whole())) == rows_of(attributes(given))


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    """Three features stored by key, and as they were given."""
    folder = tmp_path_factory.mktemp("features")
    row = built()
    given = {}
    for number, stem in enumerate(["add_gb_builtaddress", "add_gb_prebuildaddress", "add_gb_historicaddress"], 2):
        rows = [tuple(str(i) if name == "uprn" else row.get(name) for name in CORE) for i in range(number, 200, number)]
        given[stem] = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in CORE))
        given[stem].write.parquet(str(folder / "given" / f"{stem}.parquet"))
    write_keyed(given, str(folder / "keyed"), chunks=3, buckets=4)
    return folder, given, read_keyed(spark, str(folder / "keyed"))


def test_a_flatfile_of_features_needs_no_exchange(features, exact_plans):
    _, given, stored = features
    flat = [ngd.ngd_flatfile(tables, hot=NO_HOT_KEYS) for tables in (given, stored.whole(), stored.chunk(0, 2), stored.chunk(1))]
    assert "Exchange" in plan_of(flat[0]) and not any("Exchange" in plan_of(df) for df in flat[1:])
    assert rows_of(flat[1]) == rows_of(flat[0]) == sorted([*rows_of(flat[2]), *rows_of(flat[3])], key=repr)
    assert plan_of(flat[3]).count("FileScan") == plan_of(flat[1]).count("FileScan")


def test_crowded_keys_are_spread_from_keyed_tables_too(features):
    _, given, stored = features
    hot = HotKeys({6: 3, 12: 2}, rows_per_task=1)
    assert rows_of(ngd.ngd_flatfile(stored.whole(), hot=hot)) == rows_of(ngd.ngd_flatfile(given, hot=NO_HOT_KEYS))


def test_a_build_goes_on_with_the_chunks_it_lacks(spark, features, tmp_path):
    folder, given, _ = features
    work, output = str(tmp_path / "work"), str(tmp_path / "out")
    report = build_ngd_by_chunk(spark, str(folder / "given"), work, output, chunks=4, buckets=2)
    whole = ngd.ngd_flatfile(given)
    assert rows_of(flatfile(spark, output).select(whole.columns)) == rows_of(whole) and report.records == whole.count()
    kept = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").glob("chunk=[134]/*.parquet")}
    reopen_chunk(spark, output, 2, 4)
    assert build_ngd_by_chunk(spark, str(folder / "given"), work, output, chunks=4, buckets=2) == report
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "out").glob("chunk=[134]/*.parquet")} == kept
    with pytest.raises(ValueError, match="have 4 chunks, not 5"):
        build_ngd_by_chunk(spark, str(folder / "given"), work, str(tmp_path / "other"), chunks=5)

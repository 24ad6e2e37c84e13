import pytest
from pyspark.sql import functions as F

from addrloom.plans import inspection
from addrloom.sinks.parquet import has_output, output_metadata, reopen_chunk, unfinished_chunks, write_flatfile


@pytest.fixture(scope="module")
def flat(spark):
    return spark.range(0, 6000).selectExpr(
        "pmod(id * 7919, 3001) * 10 AS unique_id", "concat('PC', lpad(pmod(id * 31, 500), 4, '0')) AS postcode", "concat('ADDRESS ', id) AS address_concat"
    )


def rows_of(df):
    return sorted(map(tuple, df.select("unique_id", "postcode", "address_concat").collect()))


def files_of(path, chunk):
    return sorted((f.name, f.stat().st_mtime_ns) for f in (path / f"chunk={chunk}").glob("*.parquet"))


@pytest.mark.parametrize("sort", [True, False])
def test_a_broken_run_goes_on_where_it_stopped(spark, flat, tmp_path, sort):
    path = tmp_path / "out"
    # The third job fails: chunk 5 holds the keys that raise.
    fails = "CASE WHEN pmod(xxhash64(unique_id), 5) = 4 THEN raise_error('stop') ELSE postcode END"
    broken = flat.selectExpr("unique_id", f"{fails} AS postcode", "address_concat")
    with pytest.raises(Exception, match="stop"):
        write_flatfile(broken, str(path), chunks=5, chunks_per_job=2, sort=sort)
    assert unfinished_chunks(spark, str(path), 5) == [5] and not has_output(spark, str(path))
    kept = {chunk: files_of(path, chunk) for chunk in (1, 2, 3, 4)}
    rows = write_flatfile(flat, str(path), chunks=5, sort=sort)
    stored = spark.read.parquet(str(path))
    assert rows == stored.where("chunk = 5").count() > 0 and has_output(spark, str(path))
    assert {chunk: files_of(path, chunk) for chunk in (1, 2, 3, 4)} == kept
    assert rows_of(stored) == rows_of(flat) and output_metadata(spark, str(path)).records == 6000
    assert write_flatfile(flat, str(path), chunks=5) is None


def test_one_chunk_is_replaced(spark, flat, tmp_path):
    path = tmp_path / "out"
    assert write_flatfile(flat, str(path), chunks=4) == 6000
    kept = files_of(path, 1)
    reopen_chunk(spark, str(path), 3, 4)
    changed = flat.withColumn("postcode", F.lit("NEW"))
    rows = write_flatfile(changed, str(path), chunks=4)
    stored = spark.read.parquet(str(path))
    assert {r[0] for r in stored.where("postcode = 'NEW'").select("chunk").distinct().collect()} == {3}
    assert stored.where("chunk = 3 AND postcode <> 'NEW'").isEmpty() and stored.where("chunk = 3").count() == rows
    assert files_of(path, 1) == kept and stored.count() == 6000


def test_chunks_of_another_number_do_not_count(spark, flat, tmp_path):
    path = str(tmp_path / "out")
    assert write_flatfile(flat, path, chunks=3) == 6000
    reopen_chunk(spark, path, 1, 3)
    assert write_flatfile(flat, path, chunks=2) == 6000
    assert rows_of(spark.read.parquet(path)) == rows_of(flat)
    assert write_flatfile(flat, path, chunks=3, overwrite=True) == 6000
    assert {r[0] for r in spark.read.parquet(path).select("chunk").distinct().collect()} == {1, 2, 3}


def test_chunks_without_rows_are_finished(spark, flat, tmp_path):
    path = str(tmp_path / "out")
    few = flat.where("unique_id = 70")
    rows = few.count()
    assert write_flatfile(few, path, chunks=6, chunks_per_job=1) == rows
    assert unfinished_chunks(spark, path, 6) == [] and spark.read.parquet(path).count() == rows


def rows_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_skip_files_by_key(spark, flat, tmp_path):
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_flatfile(flat, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = inspection.flatfile(spark, path)
    # 5 lies between the keys there are, so that minima and maxima do not tell.
    assert rows_read(stored.where("unique_id = 5")) == 0
    found = stored.where("unique_id = 70")
    assert 0 < rows_read(found) < 6000
    assert inspection.key_count(stored, 70).first().asDict() == {"unique_id": 70, "variant_count": found.count()}
    assert inspection.key_count(stored, 5).first()["variant_count"] == 0
    assert inspection.key_count(stored, None).first()["variant_count"] == 0


def test_picks_take_a_row_per_task(spark, flat):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert inspection.random_key(flat, seed=3).count() in (1, 2, 3)
        plan = flat.agg(F.min(F.struct(inspection._shuffled(3, "unique_id").alias("place"), "unique_id")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan and "hashpartitioning" not in plan
    keys = {inspection.random_key(flat, seed=s).first()["unique_id"] for s in range(6)}
    assert len(keys) > 3 and keys <= {r[0] for r in flat.select("unique_id").distinct().collect()}
    with pytest.raises(LookupError):
        inspection.random_key(flat.where("false"), seed=1)

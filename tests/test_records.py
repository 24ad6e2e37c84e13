import datetime
from pathlib import Path

import pytest

from addrloom.sources import records

LPI = '24,"I",7,100,"K1","ENG",1,2001-02-03,,2002-01-01,2001-02-03,,"",,"","FLAT ""A""",12,"",,"","",55,1,"AREA","1,2","Y"'
BLPU = '21,"I",8,100,1,"2",2000-01-01,,1.5,2.5,51.5,-3.5,1,6815,"W",2000-01-01,,,2000-01-01,"D","ZZ9 4AB",0'
SHORT = '31,"I",9,100,"ORG1","CAFE"'
LINES = [
    "﻿10,\"NAG\",7655,2024-01-01",
    LPI,
    BLPU,
    SHORT,
    '"24","U",10,101',
    '99,0,4,2024-01-01,00:00:00',
    "77,unknown",
]


def lines_of(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_schemas_have_the_published_widths():
    widths = {name: len(records.schema_columns(schema)) for name, schema in records.SCHEMAS.items()}
    assert widths == {
        "street_descriptor": 13,
        "blpu": 22,
        "lpi": 26,
        "delivery_point": 29,
        "organisation": 11,
        "classification": 12,
    }


def test_split(spark):
    tables = records.split_records(lines_of(spark, *LINES))
    first, short = sorted(tables["lpi"].collect(), key=lambda row: row["pro_order"])
    assert (first["uprn"], first["sao_text"], first["level"]) == (100, 'FLAT "A"', "1,2")
    assert first["start_date"] == datetime.date(2001, 2, 3) and first["end_date"] is None
    assert first["sao_start_suffix"] is None
    assert (short["record_identifier"], short["uprn"], short["official_flag"]) == (24, 101, None)
    assert tables["blpu"].first()["latitude"] == 51.5
    assert tables["organisation"].first()["legal_name"] is None
    assert tables["classification"].isEmpty()
    assert dict(tables["blpu"].dtypes)["rpc"] == "smallint"


def test_counts(spark):
    counts = {row["record_type"]: (row["is_kept"], row["lines"]) for row in records.record_counts(lines_of(spark, *LINES)).collect()}
    assert counts == {
        "header": (False, 1),
        "lpi": (True, 2),
        "blpu": (True, 1),
        "organisation": (True, 1),
        "trailer": (False, 1),
    }


def test_written_tables_equal_split_ones(spark, tmp_path):
    lines = lines_of(spark, *LINES)
    path = str(tmp_path / "tables")
    report = records.write_record_tables(lines, path)
    assert report.rows == {
        "street_descriptor": 0,
        "blpu": 1,
        "lpi": 2,
        "delivery_point": 0,
        "organisation": 1,
        "classification": 0,
    }
    assert report.ignored_lines == 2
    assert records.write_record_tables(lines, path) is None
    assert records.write_record_tables(lines, path, overwrite=True) == report
    stored, split = records.read_record_tables(spark, path), records.split_records(lines)
    for name, table in split.items():
        assert stored[name].dtypes == table.dtypes
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, table.collect()))


def test_a_type_is_read_without_the_others(spark, tmp_path):
    path = str(tmp_path / "tables")
    records.write_record_tables(lines_of(spark, *LINES), path)
    lpi = records.read_record_tables(spark, path)["lpi"].select("uprn").where("uprn > 100")
    plan = lpi._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lpi:struct<uprn:bigint>>" in plan
    assert "rid#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_nothing_to_split(spark, tmp_path):
    with pytest.raises(ValueError, match="no record"):
        records.write_record_tables(lines_of(spark, "10,x", "77,y"), str(tmp_path / "t"))


def test_bad_value_fails_and_is_listed(spark):
    bad = lines_of(spark, LPI.replace(",7,100,", ",7,1OO,"), BLPU)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        records.split_records(bad)["lpi"].collect()
    found = [(row["record_type"], row["column_name"], row["text"]) for row in records.malformed_values(bad).collect()]
    assert found == [("lpi", "uprn", "1OO")]


def test_lines_of_all_csv_files_below(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "one.csv").write_text(f"{LPI}\n")
    (tmp_path / "a" / "b" / "two.csv").write_text(f"{BLPU}\n{SHORT}\n")
    (tmp_path / "a" / "notes.txt").write_text("24,not read\n")
    assert records.read_lines(spark, str(tmp_path)).count() == 3


def test_line_is_parsed_once(spark):
    table = records.split_records(lines_of(spark, *LINES))["lpi"]
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") <= 1


def test_dates_and_lines_must_have_their_form(spark):
    def with_day(day):
        return f'31,"I",9,100,"ORG1","CAFE",,{day},,,'

    short, trailing, long, quoted = with_day("2024-5"), with_day("2024-01-05T99"), with_day("2024-01-05") + ",EXTRA", '31,"I",9,1,"O","CA"FE, X",,2024-01-05'
    for line in (short, trailing, long, quoted):
        with pytest.raises(Exception, match="malformed line|not yyyy-MM-dd"):
            records.split_records(lines_of(spark, line))["organisation"].collect()
    good = [with_day("2024-01-05"), SHORT, '31,"I",9,1,"O","A ""B"", C"', "31"]
    assert records.split_records(lines_of(spark, *good))["organisation"].count() == 4
    listed = records.malformed_values(lines_of(spark, short, trailing, long, quoted, *good)).collect()
    assert {(row["line"], row["column_name"], row["text"]) for row in listed} == {
        (short, "start_date", "2024-5"),
        (trailing, "start_date", "2024-01-05T99"),
        (long, None, None),
        (quoted, None, None),
    }


def test_quotes_and_counts_of_fields(spark):
    """Each kind of line is taken or refused alike by both ways of looking at it."""
    full = '31,"I",9,100,"ORG1","CAFE",,2024-01-05,,,'
    fits = [full, '31,"I",9,100,"A, B","",,,,,', '31,"I",9,1,"O","A ""B""",,,,,', '31,"I",9,1,O,P,"Q,R",,,,']
    stray = ['31,"I",9,1,O","P,,,,,,', '31,"I",9,1,"O,"P",,,,,', '31,I,9,1,O,P,,,,,"x', '31,"I",9,1,"O" ,P,,,,,', '31,"I",9,1,O"P",Q,,,,,', full + ","]
    assert records.split_records(lines_of(spark, *fits))["organisation"].count() == 4
    names = [r["organisation"] for r in records.split_records(lines_of(spark, *fits))["organisation"].collect()]
    assert sorted(names, key=str) == sorted(["CAFE", None, 'A "B"', "P"], key=str)
    for line in stray:
        with pytest.raises(Exception, match="malformed line"):
            records.split_records(lines_of(spark, line))["organisation"].collect()
    listed = records.malformed_values(lines_of(spark, *fits, *stray)).collect()
    assert sorted(r["line"] for r in listed) == sorted(stray) and {r["column_name"] for r in listed} == {None}


@pytest.mark.parametrize("day", ["2024-1-05", "2024-01-5T", "2024-01-5 ", " 024-01-05", "+024-01-05", "2024-01-0x", "20240-1-05", "2024/01/05", "2024-13-01"])
def test_other_ways_to_write_a_date_fail(spark, day):
    line = f'31,"I",9,100,"ORG1","CAFE",,{day},,,'
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not yyyy-MM-dd"):
        records.split_records(lines_of(spark, line))["organisation"].collect()
    assert [r["text"] for r in records.malformed_values(lines_of(spark, line)).collect()] == [day]


def test_types_are_written_without_a_sort(spark, tmp_path):
    """A task writes one file per type it meets; the setting is as before afterwards."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    lines = lines_of(spark, *[LPI, BLPU, SHORT] * 50).coalesce(1)
    records.write_record_tables(lines, str(tmp_path / "t"))
    assert spark.conf.get(name) == before
    for rid in (24, 21, 31):
        assert len(list((tmp_path / "t" / f"rid={rid}").glob("*.parquet"))) == 1


def test_packed_lines_are_read_by_name(spark, tmp_path):
    spark.createDataFrame([(i, LPI) for i in range(9)], "i int, value string").select("value").write.option("compression", "gzip").text(str(tmp_path / "lines"))
    for number, file in enumerate((tmp_path / "lines").glob("*.txt.gz")):
        (tmp_path / f"{number}.csv.gz").write_bytes(file.read_bytes())
    assert [r["value"] for r in records.read_lines(spark, str(tmp_path), "*.csv.gz").collect()] == [LPI] * 9
    assert records.read_lines(spark, str(tmp_path)).isEmpty()


def test_the_checks_pack_their_raw_lines(spark, tmp_path):
    from checks import queries

    (tmp_path / "tables").mkdir()
    texts = {
        "supplier": "1L AS s_suppkey, 'S' AS s_name, 1 AS s_nationkey",
        "customer": "1L AS c_custkey, 'A' AS c_mktsegment, 1 AS c_nationkey",
        "orders": "id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, DATE '2001-01-01' AS o_orderdate, 'HIGH' AS o_orderpriority",
        "events": "id AS event_id, id AS user_id, 'view' AS event_type",
        "lineitem": "id AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 'A' AS l_returnflag, 'O' AS l_linestatus, DATE '2001-01-01' AS l_shipdate",
        "nation": "'N' AS n_name",
        "region": "1 AS r_regionkey",
    }
    spark.range(1000).createOrReplaceTempView("thousand")
    for name, columns in texts.items():
        spark.sql(f"SELECT {columns} FROM thousand").write.parquet(str(tmp_path / "tables" / f"{name}.parquet"))
    folder = queries._raw_folder(spark.sparkContext.applicationId, str(tmp_path / "tables"))
    read = queries._lines(spark, str(tmp_path / "tables"))
    lines = queries._derived_lines(spark, str(tmp_path / "tables"))
    # A byte order mark at the start of a file is not part of its text.
    assert sorted(r["value"].lstrip("\ufeff") for r in read.collect()) == sorted(r["value"].lstrip("\ufeff") for r in lines.collect())
    packed = sum(f.stat().st_size for f in Path(folder).glob("*.csv*"))
    assert packed < read.selectExpr("sum(octet_length(value))").first()[0] / 3

import io
import zipfile

import pyarrow as pa
import pytest

from addrloom.sources import features


def archive(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as file:
        for name, text in members.items():
            file.writestr(name.replace("__", "/") + ("" if "." in name else ".csv"), text)
    return str(path)


BUILT = 'uprn,fulladdress,floorlevel\n1,"A, B",\n2,"line one\nline two",1\n'


def test_members_become_features_by_stem(spark, tmp_path):
    first = archive(
        tmp_path / "add_gb_builtaddress.zip",
        Data__add_gb_builtaddress=BUILT,
        **{"readme.txt": "no"},
        notes="uprn\n9\n",
    )
    second = archive(tmp_path / "add_gb_royalmailaddress.zip", add_gb_royalmailaddress="uprn,posttown\n3\n")
    found = features.convert_zipped_features(spark, [first, second], str(tmp_path / "out"))
    assert sorted(found) == ["add_gb_builtaddress", "add_gb_royalmailaddress"]
    rows = sorted(tuple(row) for row in found["add_gb_builtaddress"].collect())
    assert rows == [("1", "A, B", None), ("2", "line one\nline two", "1")]
    assert [tuple(row) for row in found["add_gb_royalmailaddress"].collect()] == [("3", None)]
    assert features.convert_zipped_features(spark, [first, second], str(tmp_path / "out")) is None
    plan = found["add_gb_builtaddress"].select("uprn")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<add_gb_builtaddress:struct<uprn:string>>" in plan


def test_large_member_is_streamed_whole(spark, tmp_path):
    text = "uprn,fulladdress\n" + "".join(f"{i},ROAD {i}\n" for i in range(10_001))
    path = archive(tmp_path / "add_gb_builtaddress.zip", add_gb_builtaddress=text)
    found = features.convert_zipped_features(spark, [path], str(tmp_path / "out"))["add_gb_builtaddress"]
    assert found.count() == 10_001
    assert found.selectExpr("sum(CAST(uprn AS bigint))").first()[0] == 10_000 * 10_001 // 2


def test_excluded_features_are_not_read(spark, tmp_path):
    path = archive(tmp_path / "add_gb.zip", add_gb_builtaddress="uprn\n1\n", add_gb_historicaddress="uprn\n2\n")
    _, headers = features.read_zipped_features(spark, [path], ("historicaddress",))
    assert list(headers) == ["add_gb_builtaddress"]
    with pytest.raises(ValueError, match="no eligible CSV members"):
        features.read_zipped_features(spark, [path], ("historicaddress", "builtaddress"))


def test_same_output_twice_is_refused(spark, tmp_path):
    one = archive(tmp_path / "one.zip", a__add_gb_builtaddress="uprn\n1\n", b__add_gb_builtaddress="uprn\n2\n")
    with pytest.raises(ValueError, match="same output add_gb_builtaddress"):
        features.convert_zipped_features(spark, [one], str(tmp_path / "out"))
    first = archive(tmp_path / "first.zip", add_gb_builtaddress="uprn\n1\n")
    second = archive(tmp_path / "second.zip", add_gb_builtaddress="uprn\n2\n")
    with pytest.raises(ValueError, match="same output add_gb_builtaddress"):
        features.convert_zipped_features(spark, [first, second], str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_archives_are_chosen_by_name():
    paths = ["/d/add_gb_builtaddress.zip", "/d/add_gb_historicaddress.zip", "/d/AddressBasePremium_1.zip"]
    assert features.wanted_archives(paths, "ngd", ("historicaddress",)) == paths[:1]
    assert features.wanted_archives(paths, "abp") == paths[2:]
    assert features.wanted_archives(["/d/b.zip", "/d/a.zip"], "ngd") == ["/d/a.zip", "/d/b.zip"]


def test_only_files_with_broken_lines_are_read_whole(spark, tmp_path, monkeypatch):
    found = tmp_path / "found here%20"
    (found / "add_gb_historicaddress.csv").mkdir(parents=True)
    plain = "uprn,fulladdress\n" + "".join(f'{i},"ROAD ""{i}"", X"\n' for i in range(5000))
    (found / "add_gb_builtaddress.csv").write_text(plain)
    (found / "add_gb_prebuildaddress.CSV").write_text('uprn,fulladdress\n1,"line one\nline ""two"""\n2,B\n')
    (found / "add_gb_historicaddress.csv" / "part-0.csv").write_text("uprn,fulladdress\n8,C\n")
    (found / "add_gb_historicaddress.csv" / "part-1.csv").write_text('uprn,fulladdress\n9,"D\nE"\n')
    files = features.feature_files(spark, str(found))
    assert {stem: path.rpartition("/")[2] for stem, path in files.items()} == {
        "add_gb_builtaddress": "add_gb_builtaddress.csv",
        "add_gb_historicaddress": "add_gb_historicaddress.csv",
        "add_gb_prebuildaddress": "add_gb_prebuildaddress.CSV",
    }
    broken = features.files_with_broken_lines(spark, files.values())
    assert sorted(path.rpartition("/")[2] for path in broken) == ["add_gb_prebuildaddress.CSV", "part-1.csv"]
    asked, read = {}, features.read_feature_csv
    monkeypatch.setattr(features, "read_feature_csv", lambda s, path, whole: asked.update({features.stem_of(path): whole}) or read(s, path, whole))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        stored = features.convert_feature_folder(spark, str(found), str(tmp_path / "out"))
        assert read(spark, files["add_gb_builtaddress"], False).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert asked == {"add_gb_builtaddress": False, "add_gb_prebuildaddress": True, "add_gb_historicaddress": True}
    assert stored["add_gb_builtaddress"].count() == 5000
    assert stored["add_gb_builtaddress"].where("uprn = '4999'").first()["fulladdress"] == 'ROAD "4999", X'
    assert sorted(map(tuple, stored["add_gb_prebuildaddress"].collect())) == [("1", 'line one\nline "two"'), ("2", "B")]
    assert sorted(map(tuple, stored["add_gb_historicaddress"].collect())) == [("8", "C"), ("9", "D\nE")]
    assert features.convert_feature_folder(spark, str(found), str(tmp_path / "out"))["add_gb_builtaddress"].count() == 5000


def test_feature_names():
    assert features.is_wanted_feature("x/ADD_GB_BuiltAddress.csv")
    assert not features.is_wanted_feature("add_gb_builtaddress_altadd.csv", ("builtaddress",))
    assert not features.is_wanted_feature("lnk_gb_other.csv")


def test_blocks_end_at_records(spark, tmp_path, monkeypatch):
    """However a member is cut, quoted line breaks and short records come out whole."""
    rows = [(i, "" if i % 5 == 0 else f'road {i}\n"{i}", x' * (i % 3 + 1)) for i in range(300)]
    quoted = "".join("{},{}\r\n".format(i, '"' + t.replace('"', '""') + '"' if t else "") + f"{i}\n" for i, t in rows)
    data = ("uprn,fulladdress\n" + quoted).encode()
    for size in (1, 7, 64, 1000, 1 << 20):
        monkeypatch.setattr(features, "_BLOCK", size)
        blocks = list(features._cut_at(io.BytesIO(data), features._RecordEnds()))
        assert b"".join(blocks) == data
        assert all(b.endswith(b"\n") and b.count(b'"') % 2 == 0 for b in blocks)
        lines = list(features._cut_at(io.BytesIO(data[:-1]), lambda b: b.rfind(b"\n") + 1))
        assert b"".join(lines) == data[:-1] and all(b.endswith(b"\n") for b in lines[:-1])
    monkeypatch.undo()
    made = [
        pa.RecordBatch.from_pydict({"stem": pa.array(["s"]), "width": pa.array([2], pa.int32()), "number": pa.array([n]), "block": pa.array([b])})
        for n, b in enumerate(features._cut_at(io.BytesIO(data), features._RecordEnds()))
    ]
    got = [tuple(f) for b in features._parse_blocks(iter(made)) for f in b.column("fields").to_pylist()]
    assert sorted(got, key=repr) == sorted([*((str(i), t or None) for i, t in rows), *((str(i), None) for i, _ in rows)], key=repr)


def test_lines_of_members(spark, tmp_path):
    text = "24,a\r\n\n21,b\r31,c\n"
    first, second = archive(tmp_path / "a.zip", one=text, two="99,x"), archive(tmp_path / "b.zip", three="\n", four="")
    lines = features.read_zipped_lines(spark, [first, second])
    assert sorted(r["value"] for r in lines.collect()) == sorted(["24,a", "", "21,b", "31,c", "99,x", ""])


def test_members_are_parsed_after_an_exchange(spark, tmp_path):
    path = archive(tmp_path / "add_gb_builtaddress.zip", add_gb_builtaddress=BUILT)
    records, _ = features.read_zipped_features(spark, [path])
    for df in (records, features.read_zipped_lines(spark, [path])):
        assert "REBALANCE" in df._jdf.queryExecution().executedPlan().toString().upper()

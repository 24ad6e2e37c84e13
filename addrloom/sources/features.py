"""Per-feature CSV files with a header, and the CSV members of ZIP archives."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import PurePosixPath
from typing import BinaryIO
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyarrow import csv as pa_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.plans.ngd import excluded_stems
from addrloom.sinks.parquet import has_output, parquet_writer

# How files of the two supplies are recognised by name.
FEATURE_PREFIX = "add_gb_"
RECORD_ARCHIVE_MARK = "addressbasepremium"

_ROWS_PER_BATCH = 4_096
# Bytes of a member that are parsed by one step; a longer record makes a longer block.
_BLOCK = 4 << 20


def stem_of(name: str) -> str:
    return PurePosixPath(name).stem


def is_wanted_feature(name: str, excluded: Iterable[str] = ()) -> bool:
    """An address feature file that is not excluded; letter case does not matter."""
    stem = stem_of(name).lower()
    return stem.startswith(FEATURE_PREFIX) and stem not in excluded_stems(excluded)


def wanted_archives(paths: Iterable[str], supply: str, excluded: Iterable[str] = ()) -> list[str]:
    """Archives of a supply ("ngd" or "abp") by name, or all if none is named like it."""
    paths = sorted(paths)
    names = {path: PurePosixPath(path).name.lower() for path in paths}
    if supply == "ngd":
        named = [path for path in paths if names[path].startswith(FEATURE_PREFIX)]
        return [path for path in named if is_wanted_feature(path, excluded)] if named else paths
    named = [path for path in paths if RECORD_ARCHIVE_MARK in names[path]]
    return named or paths


def read_feature_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A feature CSV with every column as text; the plans cast what they use.

    Line breaks inside quotes are kept, as they are in ZIP members, at the price of one
    task per file. Where the supply has none, ``multi_line=False`` reads a file in splits;
    :func:`files_with_broken_lines` tells which files have some.
    """
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multi_line)


def files_with_broken_lines(spark: SparkSession, paths: Iterable[str]) -> set[str]:
    """Files of CSV files or folders that may have a line break inside quotes.

    A record that goes on in a further line has an odd number of quotes in its first one, as
    quotes within a field are doubled. One scan of all files in splits counts such lines; a
    file with a stray quote is listed too, which only costs it its splits. Carriage returns
    count as line breaks, as they do for the reader.
    """
    lines = spark.read.text(list(paths))
    odd = lines.where("(length(value) - length(replace(value, '\"'))) % 2 = 1")
    return {unquote(row[0]) for row in odd.select("_metadata.file_path").distinct().collect()}


def feature_files(spark: SparkSession, folder: str, excluded: Iterable[str] = ()) -> dict[str, str]:
    """The wanted feature CSV files below a folder by stem; two files of one stem are refused.

    A folder that is itself named like a CSV file, as Spark writes them, is one file here.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = files.option("pathGlobFilter", "*.[cC][sS][vV]").load(folder).select("path")
    found: dict[str, str] = {}
    paths = (_whole_csv(row["path"]) for row in listed.where("lower(path) LIKE '%.csv'").collect())
    for path in sorted(set(paths)):
        if is_wanted_feature(path, excluded):
            stem = stem_of(path).lower()
            if stem in found:
                raise ValueError(f"files map to the same output {stem}: {found[stem]} and {path}")
            found[stem] = path
    if not found:
        raise ValueError(f"no eligible CSV files found in {folder}")
    return found


def _whole_csv(path: str) -> str:
    parent = path.rpartition("/")[0]
    return parent if parent.lower().endswith(".csv") else path


def convert_feature_folder(
    spark: SparkSession,
    folder: str,
    path: str,
    excluded: Iterable[str] = (),
    overwrite: bool = False,
    **options,
) -> dict[str, DataFrame]:
    """Store every wanted feature CSV below a folder as ``path/<stem>.parquet``; returned by stem.

    Only files with line breaks inside quotes are read whole by a task each, all others in splits.
    """
    files = feature_files(spark, folder, excluded)
    places = {stem: f"{path.rstrip('/')}/{stem}.parquet" for stem in files}
    new = [stem for stem, place in places.items() if overwrite or not has_output(spark, place)]
    broken = files_with_broken_lines(spark, [files[stem] for stem in new]) if new else set()
    for stem in new:
        whole = any(file == files[stem] or file.startswith(f"{files[stem]}/") for file in broken)
        convert_feature_csv(read_feature_csv(spark, files[stem], whole), places[stem], overwrite=overwrite, **options)
    return {stem: spark.read.parquet(place) for stem, place in places.items()}


def convert_feature_csv(
    df: DataFrame,
    path: str,
    compression: str = "zstd",
    compression_level: int = 9,
    overwrite: bool = False,
) -> bool:
    """Store a feature as Parquet; False where it exists and ``overwrite`` is not set."""
    if not overwrite and has_output(df.sparkSession, path):
        return False
    parquet_writer(df, compression, compression_level).mode("overwrite").parquet(path)
    return True


def _open_archive(path: str):
    """A seekable stream from any file system that the path names."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(path)
    filesystem, inner = fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(inner)


def _list_members(batches: Iterator[pa.RecordBatch], headers: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            with _open_archive(path) as stream, zipfile.ZipFile(stream) as archive:
                names = [n for n in archive.namelist() if n.lower().endswith(".csv")]
                found = [_header(archive, name) if headers else [] for name in names]
            arrays = [pa.array([path] * len(names), pa.string()), pa.array(names, pa.string()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, ["archive", "member", "header"])


def _header(archive: zipfile.ZipFile, member: str) -> list[str]:
    with archive.open(member) as raw:
        return next(csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline="")), [])


def _cut_at(raw: BinaryIO, last_end: Callable[[bytes], int]) -> Iterator[bytes]:
    """A stream in blocks; ``last_end`` says behind which byte a block may end, 0 for nowhere."""
    kept: list[bytes] = []
    while block := raw.read(_BLOCK):
        end = last_end(block)
        if end:
            yield b"".join([*kept, block[:end]])
            kept = []
        kept.append(block[end:])
    if rest := b"".join(kept):
        yield rest


class _RecordEnds:
    """Finds the last line break of each block that does not lie between quotes."""

    def __init__(self) -> None:
        self.quotes = 0

    def __call__(self, block: bytes) -> int:
        data = np.frombuffer(block, np.uint8)
        quotes = np.cumsum(data == ord('"'), dtype=np.int64)
        ends = np.flatnonzero(data == ord("\n"))
        outside = ends[(quotes[ends] + self.quotes) % 2 == 0]
        self.quotes += int(quotes[-1])
        return int(outside[-1]) + 1 if len(outside) else 0


def _inflate_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each member as blocks of bytes, numbered from the one with the header."""
    for batch in batches:
        for path, member, stem, width in zip(*(batch.column(n).to_pylist() for n in ("archive", "member", "stem", "width"))):
            with _open_archive(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(member) as raw:
                for number, block in enumerate(_cut_at(raw, _RecordEnds()) if width else ()):
                    arrays = [pa.array([stem]), pa.array([width], pa.int32()), pa.array([number], pa.int64()), pa.array([block], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["stem", "width", "number", "block"])


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block as Arrow batches, every field as text, empty ones NULL.

    The few records that lack fields are set aside by the reader and padded with NULL; one
    with too many fields is an error.
    """
    for batch in batches:
        for stem, width, number, block in zip(*(batch.column(n) for n in ("stem", "width", "number", "block"))):
            stem, width, data = stem.as_py(), width.as_py(), block.as_buffer()
            names = [f"f{i}" for i in range(width)]
            short: list[str] = []

            def set_aside(row: pa_csv.InvalidRow) -> str:
                if row.actual_columns > row.expected_columns:
                    return "error"
                short.append(row.text)
                return "skip"

            records = pa_csv.read_csv(
                pa.BufferReader(data),
                pa_csv.ReadOptions(
                    column_names=names, skip_rows_after_names=0 if number.as_py() else 1, block_size=data.size + 1, use_threads=False
                ),
                pa_csv.ParseOptions(newlines_in_values=True, invalid_row_handler=set_aside),
                pa_csv.ConvertOptions(
                    column_types=dict.fromkeys(names, pa.string()), null_values=[""], strings_can_be_null=True
                ),
            ).combine_chunks()
            for part in records.to_batches(max_chunksize=_ROWS_PER_BATCH):
                rows = part.num_rows
                # Column after column becomes row after row.
                order = np.arange(rows * width).reshape(width, rows).T.ravel()
                values = pa.concat_arrays(part.columns).take(pa.array(order))
                offsets = pa.array(np.arange(0, rows * width + 1, width, dtype=np.int32))
                fields = pa.ListArray.from_arrays(offsets, values)
                yield pa.RecordBatch.from_arrays([pa.array([stem] * rows, pa.string()), fields], ["stem", "fields"])
            if short:
                yield _padded(stem, short, width)


def _padded(stem: str, records: list[str], width: int) -> pa.RecordBatch:
    rows = [[value or None for value in row] + [None] * (width - len(row)) for row in csv.reader(records)]
    arrays = [pa.array([stem] * len(rows), pa.string()), pa.array(rows, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(arrays, ["stem", "fields"])


def _inflate_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole lines of each member as blocks of text, without the last line's break."""
    for batch in batches:
        for path, member in zip(batch.column("archive").to_pylist(), batch.column("member").to_pylist()):
            with _open_archive(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(member) as raw:
                for block in _cut_at(raw, lambda block: block.rfind(b"\n") + 1):
                    text = block.replace(b"\r\n", b"\n").replace(b"\r", b"\n").removesuffix(b"\n")
                    yield pa.RecordBatch.from_arrays([pa.array([text], pa.binary()).cast(pa.string())], ["block"])


def archive_members(spark: SparkSession, archives: Iterable[str], headers: bool = True) -> DataFrame:
    """The CSV members of each archive, if wanted with their header, one task per archive."""
    archives = list(archives)
    listed = spark.createDataFrame([(path,) for path in archives], "archive string")
    return listed.repartitionByRange(max(len(archives), 1), "archive").mapInArrow(
        lambda batches: _list_members(batches, headers), "archive string, member string, header array<string>"
    )


def read_zipped_features(
    spark: SparkSession, archives: Iterable[str], excluded: Iterable[str] = ()
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Records of all wanted members as (stem, fields), and the header of each stem.

    Only the member list comes to the driver. A compressed member cannot be split, so one
    task each inflates them, side by side, and does no more than send blocks of whole records;
    all tasks then parse these, and write what is made of them. Nothing is held whole.
    """
    wanted: dict[str, tuple[str, str, list[str]]] = {}
    archives = list(archives)
    for row in archive_members(spark, archives).collect():
        if not is_wanted_feature(row["member"], excluded):
            continue
        stem = stem_of(row["member"])
        if stem in wanted:
            first = wanted[stem]
            raise ValueError(
                f"members map to the same output {stem}: "
                f"{first[0]}!{first[1]} and {row['archive']}!{row['member']}"
            )
        wanted[stem] = (row["archive"], row["member"], list(row["header"]))
    lacking = set(archives) - {archive for archive, _, _ in wanted.values()}
    if lacking:
        raise ValueError(f"no eligible CSV members found in {', '.join(sorted(lacking))}")
    members = [(archive, member, stem, len(header)) for stem, (archive, member, header) in wanted.items()]
    listed = spark.createDataFrame(members, "archive string, member string, stem string, width int")
    blocks = listed.repartitionByRange(len(members), "stem").mapInArrow(
        _inflate_members, "stem string, width int, number bigint, block binary"
    )
    records = blocks.hint("rebalance").mapInArrow(_parse_blocks, "stem string, fields array<string>")
    return records, {stem: header for stem, (_, _, header) in wanted.items()}


def read_zipped_lines(spark: SparkSession, archives: Iterable[str]) -> DataFrame:
    """Lines of all CSV members of the archives.

    One task for each member inflates it and sends blocks of lines; these are cut into lines,
    and what follows is done, in all tasks.
    """
    members = [tuple(row)[:2] for row in archive_members(spark, archives, headers=False).collect()]
    listed = spark.createDataFrame(members, "archive string, member string")
    spread = listed.repartitionByRange(max(len(members), 1), "archive", "member")
    blocks = spread.mapInArrow(_inflate_lines, "block string").hint("rebalance")
    return blocks.selectExpr("explode(split(block, '\\n', -1)) AS value")


def convert_zipped_features(
    spark: SparkSession,
    archives: Iterable[str],
    path: str,
    excluded: Iterable[str] = (),
    compression: str = "zstd",
    compression_level: int = 9,
    overwrite: bool = False,
) -> dict[str, DataFrame] | None:
    """Store all wanted members below ``path`` in one job and return them by file stem.

    Rows are stored by stem with the struct of their own stem filled, so that reading a
    feature touches only the columns it uses. None where an output exists and
    ``overwrite`` is unset.
    """
    if not overwrite and has_output(spark, path):
        return None
    records, headers = read_zipped_features(spark, archives, excluded)
    structs = [
        F.when(
            F.col("stem") == stem,
            F.struct(*[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(header)]),
        ).alias(stem)
        for stem, header in headers.items()
    ]
    by_stem = records.select("stem", *structs)
    parquet_writer(by_stem, compression, compression_level).mode("overwrite").partitionBy("stem").parquet(path)
    features = {}
    for stem, header in headers.items():
        fields = ", ".join(f"`{name}`: string" for name in header)
        stored = spark.read.schema(f"stem string, `{stem}` struct<{fields}>").parquet(path)
        features[stem] = stored.where(F.col("stem") == stem).select(f"{stem}.*")
    return features

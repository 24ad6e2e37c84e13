"""WARC archives of web pages: written with revisit records, read by byte ranges.

An archive is a row of gzip members, one per record. The reader is splittable: a task scans
a byte range for the gzip magic, takes a place for a member only if it decodes to a WARC
header, and owns the records that start inside its range; it reads on behind the range to
finish the last of them. So any file is read by as many tasks as it has ranges.

The writer keeps one response of equal payloads, the others revisit it. Digests are grouped
without the payloads; a payload is shuffled only if a Bloom filter of the repeated digests
knows its digest, and then a map task sends one per digest at most.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from addrloom.llm.bloom import MAX_FILTER_BYTES, make_filter, with_maybe
from addrloom.llm.rows import utf8
from addrloom.operators.skew import HotKeys, lookup_join
from addrloom.operators.staging import staged, staging_folder

# Payloads of fewer bytes are never revisits.
LEAST_BYTES = 1000
RANGE_BYTES = 64 << 20
# A digest with more records than this is spread when its records look up their response.
ROWS_PER_TASK = 100_000

# The start of a gzip member, a member of nothing, and the profile of a revisit.
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"
_ID = "urn:x-record:"
_BLOCK = 1 << 20
# A batch of read records holds about this many payload bytes, or one record.
_BATCH_BYTES = 8 << 20


def _line(value: str) -> str:
    """A header's value; a line break, which would end it, is written as in an address."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _named_by(value: str) -> str:
    return _line(value.replace("%", "%25"))


def _name_of(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def member(
    record_id: str | None, url: str | None, digest: bytes, length: int, payload: bytes | None, refers_to: str | None, refers_url: str | None,
    date: str = _DATE,
) -> bytes:
    """The gzip member of a response or, without a payload, of a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = {
        "WARC-Type": "revisit" if payload is None else "response",
        "WARC-Record-ID": f"<{_ID}{_named_by(record_id)}>" if record_id is not None else f"<{uuid.UUID(bytes=digest[:16]).urn}>",
        "WARC-Date": date,
        "WARC-Target-URI": _line(url) if url is not None else None,
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(digest).decode()}",
        "WARC-Profile": SAME_PAYLOAD if payload is None else None,
        "WARC-Refers-To": f"<{_ID}{_named_by(refers_to)}>" if refers_to is not None else None,
        "WARC-Refers-To-Target-URI": _line(refers_url) if refers_url is not None else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    names = ("record_id", "url", "digest", "payload_bytes", "payload", "refers_to", "refers_url")
    for batch in batches:
        columns = [batch.column(n) for n in names]
        made = (member(*(c[i].as_py() for c in columns), now) for i in range(batch.num_rows))
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])


@dataclass(frozen=True)
class Archives:
    """Folders that together hold one record per page."""

    folders: tuple[str, ...]


def _heads(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    data = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"), utf8(f"`{payload_col}`").alias("payload"))
    return data.selectExpr("page_id", "url", "unhex(sha1(payload)) AS digest", "CAST(octet_length(payload) AS BIGINT) AS payload_bytes", "payload")


def revisits(heads: DataFrame, groups: DataFrame, hot: HotKeys) -> DataFrame:
    """The ``heads`` that revisit another one, with ``best``, what they refer to.

    Of rows that repeat the best id and address one is the response and the others revisit it.
    """
    met = lookup_join(heads, groups.select("digest", "best"), ["digest"], hot, "inner")
    is_best = "page_id <=> best.page_id AND url <=> best.url"
    columns = ["page_id", "url", "digest", "payload_bytes", "best"]
    again = met.where(is_best).groupBy(*columns).count().where("count > 1")
    ties = again.selectExpr(*columns, "explode(sequence(2, count)) AS nth").select(*columns)
    return met.where(f"NOT ({is_best})").select(*columns).union(ties)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    max_filter_bytes: int = MAX_FILTER_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> Archives:
    """Write one record per row of ``pages`` to archives below ``folder``.

    Of equal payloads of at least ``least_bytes`` bytes the row with the largest id, of equal
    ids that with the largest address, is the response and the others are revisits. A null
    payload is an empty one, a null address leaves its header out, line breaks in one are
    written as ``%0D`` and ``%0A``. A row without an id is
    written without one; it is a response to others only if none of them has an id. Repeated
    rows are records each; an empty table leaves archives without records. Spark's writer
    commits the files, so lost and repeated tasks leave none behind; between members it
    sets a member of nothing as its line end, which readers of gzip skip.
    """
    rows = _heads(pages, id_col, url_col, payload_col)
    heads = staged(rows.drop("payload")).where(F.col("payload_bytes") >= least_bytes)
    # Written, so that the join has two plain exchanges.
    groups = staged(
        heads.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("best"), F.count("*").alias("n")).where("n > 1")
    )
    crowded = groups.where(F.col("n") > rows_per_task).select("digest", "n").collect()  # at most rows / rows_per_task
    hot = HotKeys({bytes(r["digest"]): -(-r["n"] // rows_per_task) for r in crowded}, 1, rows_per_task)

    made = make_filter(groups.select("digest"), groups.count(), "once", max_filter_bytes)
    tested = with_maybe(rows, made)
    may_repeat = F.col("maybe") & (F.col("payload_bytes") >= least_bytes)
    best = (
        tested.where(may_repeat).groupBy("digest", "payload_bytes").agg(F.max(F.struct("page_id", "url", "payload")).alias("best"))
        .selectExpr("best.page_id", "best.url", "digest", "payload_bytes", "best.payload")
    )
    none = ["CAST(NULL AS STRING) AS refers_to", "CAST(NULL AS STRING) AS refers_url"]
    alone = tested.where(~may_repeat).select("page_id", "url", "digest", "payload_bytes", "payload")
    again = revisits(heads, groups, hot).selectExpr(
        "page_id", "url", "digest", "payload_bytes", "CAST(NULL AS BINARY) AS payload",
        "CAST(best.page_id AS STRING) AS refers_to", "best.url AS refers_url",
    )
    parts = {"single": alone.selectExpr("*", *none), "repeated": best.selectExpr("*", *none).union(again)}
    folders = []
    for name, records in parts.items():
        members = records.withColumnRenamed("page_id", "record_id").withColumn("record_id", F.col("record_id").cast("string"))
        packed = members.mapInArrow(_members, "member binary").selectExpr("CAST(member AS STRING) AS value")
        folders.append(f"{folder.rstrip('/')}/{name}")
        packed.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(folders[-1])
    return Archives(tuple(folders))


def open_file(path: str):
    """A file by its path or address, for reading at any place."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file" or len(scheme) < 2:
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if scheme == "file" else path)
    system, place = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}:{rest}")
    return system.open_input_file(place)


class Member:
    """A gzip member that is read from a file as far as asked."""

    def __init__(self, file, at: int) -> None:
        self.file, self.at = file, at
        self.opener = zlib.decompressobj(31)
        self.ready = b""

    def more(self, most: int = 0) -> bool:
        """Decode some more; false at the member's end. Raises ``zlib.error`` where it is none."""
        if self.opener.eof:
            return False
        data = self.opener.unconsumed_tail
        if not data:
            data = self.file.read_at(min(_BLOCK, 1 << 14 if most else _BLOCK), self.at)
            self.at += len(data)
            if not data:
                raise zlib.error("the file ends within a member")
        self.ready += self.opener.decompress(data, most or 0)
        return True

    def starts_like_a_record(self) -> bool:
        try:
            while len(self.ready) < 7 and self.more(64):
                pass
        except zlib.error:
            return False
        return self.ready.startswith((b"WARC/1.", b"WARC/0."))

    def rest(self) -> bytes:
        parts = []
        while True:
            parts.append(self.ready)
            self.ready = b""
            if not self.more():
                return b"".join(parts)

    def end(self) -> int:
        return self.at - len(self.opener.unused_data)


def owned_members(file, size: int, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """Place, end and content of the records that start in a byte range.

    A place that looks like a member but does not decode to the start of a record is passed
    by; one that does and then breaks off or is damaged raises. Text payloads hold no magic,
    as it is no UTF-8; a payload that is itself an archive and is stored uncompressed could be
    taken for one where a range starts inside it.
    """
    at = start
    window, window_at = b"", start
    while at < end:
        found = window.find(MAGIC, at - window_at) if window_at <= at else -1
        if found < 0:
            # Read on; the last two bytes may start a magic that goes over the block's end.
            at = max(at, window_at + len(window) - 2) if window else at
            if at >= end:
                return
            window_at, window = at, file.read_at(min(_BLOCK, size - at), at)
            if len(window) < len(MAGIC):
                return
            found = window.find(MAGIC)
            if found < 0:
                if window_at + len(window) >= size:
                    return
                continue
        place = window_at + found
        if place >= end:
            return
        one = Member(file, place)
        if one.starts_like_a_record():
            content = one.rest()
            yield place, one.end(), content
            at = one.end()
            if at > window_at + len(window):
                window, window_at = b"", at
        else:
            at = place + 1


def _named(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _hex_digest(value: str | None) -> str | None:
    """``sha1:`` and 32 base-32 letters or 40 hex digits, as lower-case hex."""
    kind, _, digits = (value or "").partition(":")
    if kind.lower() != "sha1" or len(digits) not in (32, 40):
        return None
    return base64.b32decode(digits.upper()).hex() if len(digits) == 32 else digits.lower()


def _own_id(value: str | None) -> str | None:
    inner = (value or "").strip("<>")
    return _name_of(inner[len(_ID) :]) if inner.startswith(_ID) else None


def parse_record(content: bytes) -> tuple:
    """record_type, record_id, url, payload, payload_bytes, payload_digest, refers_to, intact."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _named(head)
    block = rest[: int(fields.get("content-length", len(rest)))]
    payload, length = block, None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = _named(http).get("content-length")
    kind, said = fields.get("warc-type"), _hex_digest(fields.get("warc-payload-digest"))
    common = kind, _own_id(fields.get("warc-record-id")), fields.get("warc-target-uri")
    if kind == "revisit":
        return *common, None, None if length is None else int(length), said, _own_id(fields.get("warc-refers-to")), said is not None
    digest = hashlib.sha1(payload).hexdigest()
    intact = said in (None, digest) and length in (None, str(len(payload)))
    return *common, payload, len(payload), digest, None, intact


RECORD = (
    "path string, offset bigint, record_type string, record_id string, url string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to string, intact boolean"
)


def byte_ranges(spark: SparkSession, folders: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path``, ``size``, ``start`` and ``end`` of ranges that cover the files; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders).where("length > 0")
    return files.select("path", F.col("length").alias("size")).selectExpr(
        "path", "size", f"explode(sequence(0L, size - 1, {range_bytes}L)) AS start"
    ).selectExpr("path", "size", "start", f"least(start + {range_bytes}L, size) AS end")


def read_archives(spark: SparkSession, folders: list[str] | tuple[str, ...], range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in the folders, see ``RECORD``.

    Any gzipped WARC will do. ``payload_digest`` is hex; that of a response is computed from
    what was read, and ``intact`` tells whether its header says the same. A revisit has no
    payload; its length and digest are those its headers give. ``record_id`` and ``refers_to`` are
    those of this writer, null for others'. Files without records give no rows. Without
    ``payloads`` these are left out of the rows. Each range is a row that is dealt to the
    tasks, so a lost task repeats its own ranges only.
    """
    ranges = byte_ranges(spark, list(folders), range_bytes)
    schema = StructType.fromDDL(RECORD)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, end in zip(*(batch.column(n).to_pylist() for n in ("path", "size", "start", "end")), strict=True):
                rows, held = [], 0
                with open_file(path) as file:
                    for place, _, content in owned_members(file, size, start, end):
                        kind, record_id, url, payload, *others = parse_record(content)
                        rows.append((path, place, kind, record_id, url, payload if payloads else None, *others))
                        held += len(payload or b"") if payloads else 200
                        if held >= _BATCH_BYTES:
                            yield _batch(rows, arrow)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, arrow)

    tasks = spark.sparkContext.defaultParallelism * 4
    return ranges.repartition(tasks, "path", "start").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the pages to archives in the shared folder and read these back.

    One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to; see
    ``write_archives`` for nulls, ties and repeated rows.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType
    folder = f"{staging_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    made = write_archives(pages, folder, id_col, url_col, payload_col)
    records = read_archives(spark, made.folders, range_bytes, payloads=False)
    return records.select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )

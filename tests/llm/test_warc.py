import gzip
import hashlib
import io
import random
import zlib

import pytest

from addrloom.llm.warc import (
    EMPTY_MEMBER, Member, archived_pages, byte_ranges, member, open_file, owned_members, parse_record, read_archives, write_archives,
)

SCHEMA = "page_id long, url string, html string, digest string, maybe string, n long, best string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", None, 3, "b", None) for i, u, h in rows], SCHEMA)


def html(seed, n):
    rnd = random.Random(seed)
    return "".join(rnd.choice(["<p>", "word ", "é", "中", "\r\n\r\n", "WARC/1.1", "%0A"]) for _ in range(n))


def odd_pages():
    big, other, small = html(1, 900), html(2, 700), "tiny"
    exact = "x" * 1000
    rows = [(i, f"http://a/{i}", big) for i in range(40)] + [(100, None, other), (101, "u\r\nWARC-Type: revisit %0A", other)]
    rows += [(i, "s", small) for i in (200, 201, 201)] + [(300, "n", None), (301, "n", ""), (302, None, None)]
    rows += [(400, "a", exact), (401, "b", exact), (402, "c", "x" * 999), (403, "d", "x" * 999)]
    rows += [(500, "t", html(5, 800))] * 3 + [(600, "p", html(6, 800)), (600, "q", html(6, 800)), (599, "q", html(6, 800))]
    rows += [(None, "z", html(7, 800)), (None, "y", html(7, 800)), (700, "long", html(8, 300_000)), (None, "w", html(9, 900)), (701, "w", html(9, 900))]
    return rows


def expected(rows):
    groups = {}
    for at, (page, url, text) in enumerate(rows):
        data = (text or "").encode()
        groups.setdefault(data, []).append((page is not None, page or 0, url is not None, url or "", at))
    out = []
    for data, members in groups.items():
        best = max(members)
        for one in members:
            revisit = len(data) >= 1000 and one is not best
            page = rows[one[-1]][0]
            target = rows[best[-1]][0]
            out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(map(repr, out))


def test_records_against_brute_force(spark):
    rows = odd_pages()
    for range_bytes in (700, 1 << 26):
        got = archived_pages(pages(spark, rows), range_bytes=range_bytes)
        assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows)


def test_crowded_digests_are_spread_and_full_filters_are_exact(spark, tmp_path):
    rows = odd_pages()
    made = write_archives(pages(spark, rows), str(tmp_path / "a"), rows_per_task=3, max_filter_bytes=1 << 18)
    got = read_archives(spark, made.folders, 5000)
    assert got.count() == len(rows) and got.where("NOT intact").count() == 0
    assert got.where("record_type = 'revisit' AND payload IS NOT NULL").count() == 0
    texts = {(r["record_id"], bytes(r["payload"])) for r in got.where("record_type = 'response'").collect()}
    assert texts <= {(None if i is None else str(i), (h or "").encode()) for i, _, h in rows}
    assert {r["url"] for r in got.collect()} == {u and u.replace("\r", "%0D").replace("\n", "%0A") for _, u, _ in rows}


def test_ranges_of_any_size_find_each_record_once(spark, tmp_path):
    made = write_archives(pages(spark, odd_pages()), str(tmp_path / "a"))
    whole = sorted(tuple(r) for r in read_archives(spark, made.folders, 1 << 30).select("path", "offset").collect())
    for size in (1000, 4096, 65_537):
        assert sorted(tuple(r) for r in read_archives(spark, made.folders, size).select("path", "offset").collect()) == whole
    lengths = byte_ranges(spark, list(made.folders), 1000).selectExpr("sum(end - start) AS n", "count(distinct path) AS f").first()
    assert lengths["f"] >= 1 and lengths["n"] > 1000


def test_archives_are_plain_gzip(spark, tmp_path):
    folder = tmp_path / "a"
    write_archives(pages(spark, odd_pages()[:5]), str(folder))
    content = b"".join(gzip.decompress(f.read_bytes()) for f in folder.rglob("part-*"))
    assert content.count(b"WARC/1.1\r\nWARC-Type: ") == 5 and content.count(b"WARC-Type: revisit\r\n") == 4


def test_any_split_of_bytes_and_false_magic(tmp_path):
    rnd = random.Random(3)
    digest = b"d" * 20
    junk = [b"", b"\x1f\x8b\x08", b"\x1f\x8b\x08\x00junk" * 3, gzip.compress(b"no record"), EMPTY_MEMBER, b"\x1f\x8b"]
    parts, want, at = [], [], 0
    for i in range(60):
        data = rnd.choice(junk)
        body = rnd.randbytes(rnd.choice([0, 10, 5000]))
        one = member(str(i), "u", digest, len(body), body, None, None)
        want.append(at + len(data))
        parts += [data, one]
        at += len(data) + len(one)
    path = tmp_path / "mixed.warc.gz"
    path.write_bytes(b"".join(parts))
    with open_file(f"file:{path}") as file:
        for step in (1, 2, 3, 17, 1000, at):
            if step < 17:
                cuts = sorted({0, *(p + d for p in want for d in range(-step, step + 1) if 0 < p + d < at), at})
            else:
                cuts = [*range(0, at, step), at]
            found = [p for a, b in zip(cuts, cuts[1:]) for p, _, _ in owned_members(file, at, a, b)]
            assert found == want
        contents = [c for _, _, c in owned_members(file, at, 0, at)]
    assert [parse_record(c)[1] for c in contents] == [str(i) for i in range(60)]


def test_damage_is_an_error(tmp_path):
    one = member("1", "u", b"d" * 20, 5000, random.Random(1).randbytes(5000), None, None)
    for broken in (one[:-100], one[:-6] + b"xx" + one[-4:]):
        path = tmp_path / f"{len(broken)}-{broken[-6]}.gz"
        path.write_bytes(broken)
        with open_file(str(path)) as file, pytest.raises(zlib.error):
            list(owned_members(file, len(broken), 0, len(broken)))


def test_others_archives_are_read(spark, tmp_path):
    payload = b"<html>hello</html>"
    http = b"HTTP/1.1 200 OK\r\ncontent-length: 18\r\n\r\n" + payload
    digest = hashlib.sha1(payload).hexdigest()
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:5>\r\nWARC-Target-URI: http://x/\r\nWARC-Payload-Digest: sha1:{digest.upper()}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    buffer = io.BytesIO()
    for record in (info, head.encode() + http + b"\r\n\r\n"):
        buffer.write(gzip.compress(record))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.warc.gz").write_bytes(buffer.getvalue())
    got = {r["record_type"]: r for r in read_archives(spark, [str(tmp_path / "c")]).collect()}
    assert set(got) == {"warcinfo", "response"}
    assert bytes(got["response"]["payload"]) == payload and got["response"]["intact"] and got["response"]["payload_digest"] == digest


def test_no_pages(spark):
    assert archived_pages(pages(spark, [])).collect() == []


def test_members_decode_as_far_as_asked(tmp_path):
    path = tmp_path / "m"
    path.write_bytes(member("1", None, b"d" * 20, 1 << 20, bytes(1 << 20), None, None))
    with open_file(str(path)) as file:
        one = Member(file, 0)
        assert one.starts_like_a_record() and len(one.ready) < 1000 and len(one.rest()) > 1 << 20

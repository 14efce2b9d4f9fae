from __future__ import annotations

import base64
import gzip
import hashlib
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from salestream.llm import warc
from salestream.workspace import new_path
from tests.llm.conftest import rows_of

SCHEMA = "page_id long, url string, html string, key string, block int, row int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)


def round_trip(spark, rows):
    path = new_path(spark, "archive")
    warc.write_archive(pages(spark, rows), path)
    return warc.read_archive(spark, path)


def brute(rows):
    groups: dict[str, list] = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for html, ids in groups.items():
        data = html.encode()
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        revisits = list(ids)
        revisits.remove(keep)
        first = [keep] if len(data) >= 1000 else ids
        figures = (len(data), hashlib.sha1(data).hexdigest())
        out += [(i, *figures, "response", None, None) for i in first]
        out += [(i, *figures, "revisit", keep, None) for i in revisits if len(data) >= 1000]
    return sorted(out, key=repr)


def test_round_trip_of_odd_pages(spark):
    pick = random.Random(1)
    tricky = "WARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\n0\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"
    rows = [(1, None, None), (2, "a\r\nb", "x" * 40_000), (3, "u", "x" * 40_000), (3, "u", "x" * 40_000),
            (None, None, "x" * 40_000), (4, "é", tricky * 900 + "é" * 9000), (5, "", ""), (6, None, "short"), (7, None, "short"),
            (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "z" * 1000), (11, "u", "z" * 1000), (12, "u", "é" * 500), (13, "v", "é" * 500)]
    rows += [(100 + i, f"http://h/{i}", "".join(pick.choice("ab\r\n é") for _ in range(pick.randrange(30_000)))) for i in range(20)]
    archive = round_trip(spark, rows)
    found = warc.resolve(archive)
    assert rows_of(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error") == brute(rows)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in archive.where("record_type = 'response'").collect()}
    assert all(payloads[i] == (html or "").encode() for i, _, html in rows if i is not None and i in payloads)
    assert archive.select("record_id").distinct().count() == len(rows)


def records(*rows):
    """(type, id, origin, segment, total, block)"""
    return [(k, i, None, 1, None, None, o, s, t, b) for k, i, o, s, t, b in rows]


@pytest.mark.parametrize(("rows", "error"), [
    ([("response", "a", None, 1, None, b"ab"), ("continuation", "b", "a", 3, 6, b"ef"), ("continuation", "c", "a", 2, None, b"cd")], None),
    ([("response", "a", None, 1, None, b"ab"), ("continuation", "b", "a", 3, 6, b"ef")], "segments are missing or repeated"),
    ([("response", "a", None, 1, None, b"ab"), ("continuation", "b", "a", 2, 4, b"cd"), ("continuation", "c", "a", 2, 4, b"cd")],
     "segments are missing or repeated"),
    ([("response", "a", None, 1, None, b"ab"), ("continuation", "b", "a", 2, 9, b"cd")], "total length differs"),
    ([("response", "a", None, 1, None, b"ab"), ("continuation", "b", "a", 2, None, b"cd")], "last segment is missing"),
    ([("continuation", "b", "a", 2, 4, b"cd")], "first segment is missing"),
])
def test_segments(spark, rows, error):
    (one,) = warc.reassemble(spark.createDataFrame(records(*rows), warc.RECORD)).collect()
    assert one["error"] == error and one["record_id"] == "a"
    assert error or bytes(one["block"]) == b"abcdef"


def test_chunked_framing():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert warc.decode_http(head + b"3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n") == (b"abcde", None)
    assert warc.decode_http(head + b"0\r\n\r\n") == (b"", None)
    assert warc.decode_http(head + b"5\r\nabc\r\n0\r\n\r\n")[1] == "broken chunk end"
    assert warc.decode_http(head + b"zz\r\nabc\r\n")[1] == "broken chunk size"
    assert warc.decode_http(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nplain") == (b"plain", None)
    assert warc.decode_http(b"nothing")[1] == "no end of HTTP headers"


def test_broken_files():
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse_records(b"hello"))
    member = warc.zlib.compressobj(wbits=31)
    one = member.compress(b"ab") + member.flush()
    assert warc.gunzip(one + one) == b"abab"


def test_empty_table(spark):
    path = new_path(spark, "archive")
    warc.write_archive(pages(spark, [(1, "u", "x")]).where(F.lit(False)), path)
    assert rows_of(warc.resolve(warc.read_archive(spark, path))) == []


def record(kind, record_id, block, *headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", *headers, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_a_folder_of_ordinary_archives(spark):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    body = b"<p>page</p>" * 3
    base32 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    chunked = b"3\r\nabc\r\n0\r\n\r\n"
    as_sent = base64.b32encode(hashlib.sha1(chunked).digest()).decode()
    one = [record("warcinfo", "i", b"software: x"), record("request", "q", b"GET / HTTP/1.1\r\n\r\n"),
           record("response", "r", http + body, f"WARC-Payload-Digest: sha1:{base32}", "WARC-Page-ID: 1"),
           record("metadata", "m", b"a: b")]
    two = [record("resource", "s", b"plain, no headers", "WARC-Page-ID: 2"),
           record("revisit", "v", b"", "WARC-Refers-To: <r>", "WARC-Page-ID: 3"),
           record("response", "c", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked,
                  f"WARC-Payload-Digest: sha1:{as_sent}", "WARC-Page-ID: 4"),
           record("response", "w", http + body, "WARC-Payload-Digest: sha1:AAAA", "WARC-Page-ID: 5"),
           record("response", "x", http + body, "WARC-Payload-Digest: other:AAAA", "WARC-Page-ID: 6")]
    good = record("resource", "g", b"good", "WARC-Page-ID: 7")
    path = new_path(spark, "ordinary")
    folder = pathlib.Path(path.removeprefix("file:"))
    (folder / "below").mkdir(parents=True)
    packed = [gzip.compress(r) for r in two]
    (folder / "a.warc").write_bytes(b"".join(one))
    (folder / "below" / "b.warc.gz").write_bytes(b"".join(packed))
    (folder / "cut.warc").write_bytes(good + one[2][:-20])
    (folder / "cut.warc.gz").write_bytes(gzip.compress(good) + packed[2][:-12])
    (folder / "bad.warc.gz").write_bytes(gzip.compress(good) + b"not packed")
    (folder / "_notes").write_bytes(b"hidden")
    archive = warc.read_archive(spark, path)
    found = warc.resolve(archive).orderBy("page_id").collect()
    whole = {r["page_id"]: (r["record_type"], r["payload_bytes"], r["refers_to"], r["error"]) for r in found if r["page_id"]}
    assert whole == {1: ("response", len(body), None, None), 2: ("resource", 17, None, None), 3: ("revisit", len(body), 1, None),
                     4: ("response", 3, None, None), 5: ("response", len(body), None, "digest differs"),
                     6: ("response", len(body), None, None), 7: ("resource", 4, None, None)}
    assert sum(r["page_id"] == 7 for r in found) == 3
    broken = sorted(r["error"] for r in found if r["page_id"] is None)
    assert [(e.split(" of file:")[0], e.rsplit("/", 1)[1]) for e in broken] == [
        (f"broken gzip member after byte {len(good)}", "bad.warc.gz"),
        (broken[1].split(" of file:")[0], "cut.warc.gz"),
        (f"record is cut off before byte {broken[2].split('before byte ')[1].split()[0]}", "cut.warc")]
    assert broken[1].startswith("gzip member is cut off")
    assert {r["record_type"] for r in archive.collect()} >= {"warcinfo", "request", "metadata"}
    assert warc.read_records(spark, path, "*.warc").where("error IS NULL").count() == len(one) + 1

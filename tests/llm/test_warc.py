import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from concord.llm import warc
from concord.session import fresh_path, table


def brute(rows, least=0):
    last = {}
    for page, html in rows:
        if len(html) >= least:
            last[html] = max(last.get(html, page), page)
    return sorted((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if last.get(h, p) != p else "response", last[h] if last.get(h, p) != p else None) for p, h in rows)


def test_round_trip(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    extra = spark.createDataFrame([(900, "u", None), (901, None, ""), (902, "a\nb", "<p>é</p>"), (903, "c", "<p>é</p>"), (904, "d", "\r\n\r\n" * 3000), (905, "d", "<p>é</p>")], "page_id long, url string, html string")
    both = pages.unionByName(extra)
    want = brute([(r.page_id, (r.html or "").encode()) for r in both.collect()])
    got = sorted(tuple(r) for r in warc.round_trip(both).collect())
    assert got == want
    assert sum(r[3] == "revisit" for r in want) >= 3


def test_least_bytes_and_payloads(spark):
    pages = spark.createDataFrame([(1, "u", "tiny"), (2, "v", "tiny"), (3, "w", "large enough"), (4, "x", "large enough")], "page_id long, url string, html string")
    path = fresh_path(spark, "warc")
    warc.write_archives(pages, path, least_bytes=6)
    rows = {r.page_id: (r.record_type, r.payload and bytes(r.payload), r.refers_to, r.uri) for r in warc.read_archives(spark, path).collect()}
    assert rows == {1: ("response", b"tiny", None, "u"), 2: ("response", b"tiny", None, "v"), 3: ("revisit", None, 4, "w"), 4: ("response", b"large enough", None, "x")}
    some = warc.read_archives(spark, path, "none").where((F.col("record_type") == "revisit") & F.col("page_id").isin(3, 4) & (F.col("payload_bytes") > 2))
    assert [(r.page_id, r.payload) for r in some.collect()] == [(3, None)]
    assert warc.round_trip(pages.limit(0)).count() == 0


MARK = bytes(range(16))


def bodies(n):
    return [(f"page {k} " * (k % 50)).encode() for k in range(n)]


def record(k, html):
    return warc.record_bytes(k, f"http://e/{k}", html, warc.digest_of(html), None, False)


def ours(pages, first=0):
    return b"".join(warc.gzip_member(record(first + k, h), MARK) for k, h in enumerate(pages))


def theirs(pages, first=0):
    return b"".join(gzip.compress(record(first + k, h)) for k, h in enumerate(pages))


def read(spark, folder, split, payload="keep", where="true"):
    rows = warc.read_archives(spark, str(folder), payload, split).where(where)
    return sorted((r.page_id, r.payload and bytes(r.payload)) for r in rows.collect())


@pytest.mark.parametrize("split", [1 << 26, 20_000, 5000, 2000, 900])
@pytest.mark.parametrize("kind", ["ours", "theirs", "plain", "ours then theirs", "theirs then ours", "an archive within a payload"])
def test_every_member_is_read_once(spark, tmp_path, kind, split):
    pages = bodies(200)
    if kind == "plain":
        (tmp_path / "x.warc").write_bytes(b"".join(record(k, h) for k, h in enumerate(pages)))
    else:
        if kind == "an archive within a payload":
            pages[7] = pages[150] = gzip.compress(random.Random(1).randbytes(3000)) + ours(bodies(40)).replace(MARK, MARK[::-1])
        data = {"ours": ours(pages), "theirs": theirs(pages), "ours then theirs": ours(pages[:90]) + theirs(pages[90:], 90), "theirs then ours": theirs(pages[:90]) + ours(pages[90:], 90)}.get(kind) or ours(pages)
        (tmp_path / "x.warc.gz").write_bytes(data)
    assert read(spark, tmp_path, split) == [(k, h) for k, h in enumerate(pages)]
    assert read(spark, tmp_path, split, "none", "page_id = 3") == [(3, None)]


def test_other_writers_headers(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    records = [
        b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n",
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    got = sorted((r.record_type, bytes(r.payload), r.page_id, r.payload_bytes, r.payload_digest) for r in warc.read_archives(spark, str(tmp_path)).collect())
    assert got == sorted([("response", b"hello", None, 5, None), ("warcinfo", b"a: b", None, 4, None)] * 2)
    assert all(r.payload_bytes is None for r in warc.read_archives(spark, str(tmp_path), "none").collect())


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_rows_that_repeat_an_id(spark, broadcast_rows):
    rows = [(5, "a", "same"), (5, "b", "same"), (5, "a", "same"), (3, "c", "same"), (5, "a", "other"), (None, "n", "nameless"), (None, "n", "nameless"), (7, "t", "third"), (6, "t", "third")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fresh_path(spark, "warc")
    warc.write_archives(pages, path, broadcast_rows=broadcast_rows)
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect()]
    want = [(5, 4, "response", None), (5, 4, "revisit", 5), (5, 4, "revisit", 5), (3, 4, "revisit", 5), (5, 5, "response", None), (None, 8, "response", None), (None, 8, "revisit", None), (7, 5, "response", None), (6, 5, "revisit", 7)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_filters_are_taken(spark):
    from pyspark.sql.datasource import EqualTo, GreaterThan

    reader = warc.WarcReader("x", "none", 1)
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 1)]))
    assert len(left) == 1 and reader.wanted == {"record_type": {"revisit"}}

"""WARC archives as a PySpark data source, written and read.

Writing: pages become one record each in gzip-per-record archives
(``pages-*.warc.gz``). Of the records with equal payloads of at least a given
size, one with the largest page id is a response with the payload; the others
are revisit records that refer to it and hold no payload. A task writes its file
under a temporary name; the commit gives the files of successful attempts their
final names, so lost executors leave nothing that a reader sees.

Reading: ``*.warc.gz`` and plain ``*.warc`` files, of this writer or any other.
Every gzip member of ours starts with an extra field that holds its compressed
size (subfield "sl") and a mark drawn for its archive (subfield "id"). So a reader
inflates only the first bytes of a member for its headers, decides by the
pushed-down record-type and header predicates, and seeks past the member if the
payload is not wanted; and a large archive is read in ranges. A range runs from
the first member with the archive's mark at or after its start to the first one at
or after its end, so every member is read exactly once, also unmarked ones that
were appended. A file whose first member has no mark, and a plain file, is one
range; a plain file's payloads are sought past by their Content-Length. Payloads
are decoded only for the columns asked for (option "payload").

Defined results: a null html is an empty payload; rows with a null page id are
written with an empty id and read back as null, and the largest id of equal
payloads is null only if all are; repeated rows give a record each, and of rows
that repeat the response's page id one is the response and the others revisit it;
an empty table gives an empty archive folder and no rows. Records of other
writers keep their headers: page_id and refers_to are null where the record id is
none of ours, payload_bytes is null unless stated or read, and a payload is
checked only against a SHA-1 in base32.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from concord.llm.common import small_batches
from concord.session import fresh_path, written

RECORD_SCHEMA = "page_id long, record_type string, uri string, refers_to long, payload_bytes long, payload_digest string, payload binary"
#: Bytes of an archive that one read task takes.
SPLIT_BYTES = 64 << 20
#: Repeated digests that are broadcast at most; about 100 bytes each.
BROADCAST_DIGESTS = 200_000
_HEAD = 4096
_ROWS, _BATCH_BYTES = 512, 8 << 20
_SHA1 = re.compile("[A-Z2-7]{32}")
#: Read predicates and the header they look at (fixed values of the record layout below).
_HEADER_OF = {"record_type": "warc-type", "uri": "warc-target-uri", "payload_digest": "warc-payload-digest", "page_id": "warc-record-id", "refers_to": "warc-refers-to"}
_GZIP = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def gzip_member(record: bytes, mark: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra fields hold its own size and the record's ("sl") and the archive's mark ("id")."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 10 + 2 + 12 + 4 + len(mark) + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(record) & 0xFFFFFFFF) + b"id" + struct.pack("<H", len(mark)) + mark
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def record_bytes(page_id: int | None, uri: str | None, html: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that only names it."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    block = head if revisit else head + html
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Target-URI: {(uri or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(html)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_headers(head: bytes) -> dict[str, str]:
    """Headers by their lower-cased names."""
    lines = head.split(b"\r\n")
    pairs = (line.partition(b":") for line in lines[1:] if line)
    return {name.decode("latin-1").strip().lower(): value.strip().decode("utf-8", "replace") for name, _, value in pairs}


@dataclass
class _Written(WriterCommitMessage):
    name: str


class WarcWriter(DataSourceArrowWriter):
    """Rows of (page_id, uri, html, digest, refers_to, revisit) to archive files."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        archive = uuid.uuid4()
        name = f"pages-{archive.hex}"
        with store.open_output_stream(f"{root}/.{name}.tmp") as out:
            for batch in batches:
                for values in zip(*batch.columns, strict=True):
                    page_id, uri, html, digest, refers_to, revisit = (v.as_py() for v in values)
                    digest = base64.b32encode(bytes.fromhex(digest)).decode()
                    out.write(gzip_member(record_bytes(page_id, uri, html, digest, refers_to, revisit), archive.bytes))
        return _Written(name)

    def commit(self, messages: list[_Written | None]) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m is not None:
                store.move(f"{root}/.{m.name}.tmp", f"{root}/{m.name}.warc.gz")

    def abort(self, messages: list[_Written | None]) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m is not None:
                store.delete_file(f"{root}/.{m.name}.tmp")


@dataclass
class _Range(InputPartition):
    file: str
    start: int
    end: int
    #: The archive's mark; None if the file is read as one range.
    mark: bytes | None


class WarcReader(DataSourceReader):
    """Records of the archives in a folder; headers first, payloads only where asked for."""

    def __init__(self, path: str, payload: str, split_bytes: int) -> None:
        self.path, self.payload, self.split_bytes = path, payload, split_bytes
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in _HEADER_OF and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            else:
                yield f

    def partitions(self) -> list[_Range]:
        store, root = _store(self.path)
        files = [f for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.path.endswith((".warc.gz", ".warc")) and not f.base_name.startswith(".")]
        out: list[_Range] = []
        for f in sorted(files, key=lambda f: f.path):
            mark = None
            if f.path.endswith(".gz") and f.size > self.split_bytes:
                with store.open_input_file(f.path) as source:
                    mark = _member(source.read_at(min(_HEAD, f.size), 0)).mark
            step = f.size if mark is None else self.split_bytes
            out += [_Range(f.path, at, min(at + step, f.size), mark) for at in range(0, f.size, max(step, 1))]
        return out

    def _matches(self, headers: dict[str, str]) -> bool:
        for name, values in self.wanted.items():
            value: object = headers.get(_HEADER_OF[name])
            if name in ("page_id", "refers_to"):
                value = _page_of(value)
            elif name == "payload_digest":
                value = (value or "").removeprefix("sha1:")
            if value not in values:
                return False
        return True

    def read(self, partition: _Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archives
            return
        store, _ = _store(self.path)
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        held: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

        with store.open_input_file(partition.file) as source:
            found = records(source, partition.start, partition.end, partition.mark, self._matches, self.payload) if partition.file.endswith(".gz") else plain_records(source, self._matches, self.payload)
            for headers, payload in found:
                length, digest = headers.get("warc-payload-length"), headers.get("warc-payload-digest", "").removeprefix("sha1:")
                if payload is not None:
                    if _SHA1.fullmatch(digest) and digest_of(payload) != digest:
                        raise ValueError(f"{partition.file}: a payload does not have its digest {digest}")
                    length = len(payload)
                body = payload if self.payload == "keep" else None
                held.append((_page_of(headers.get("warc-record-id")), headers.get("warc-type"), headers.get("warc-target-uri"), _page_of(headers.get("warc-refers-to")), None if length is None else int(length), digest or None, body))
                size += len(body or b"")
                if len(held) >= _ROWS or size > _BATCH_BYTES:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()


@dataclass
class _Member:
    """What a gzip member's extra field says."""

    size: int | None = None
    mark: bytes | None = None


def _member(head: bytes) -> _Member:
    found = _Member()
    if len(head) < 12 or head[:3] != b"\x1f\x8b\x08" or not head[3] & 4:
        return found
    extra_size = struct.unpack_from("<H", head, 10)[0]
    extra, at = head[12 : 12 + extra_size], 0
    while at + 4 <= len(extra):
        n = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"sl" and n >= 4:
            found.size = struct.unpack_from("<I", extra, at + 4)[0]
        elif extra[at : at + 2] == b"id":
            found.mark = bytes(extra[at + 4 : at + 4 + n])
        at += 4 + n
    return found


def _first_member(source, start: int, size: int, mark: bytes | None) -> int:
    """Where the first member with the archive's mark at or after ``start`` begins; the file's size if there is none."""
    if start == 0 or start >= size or mark is None:
        return 0 if start == 0 else size
    at = start
    while at < size:
        window = source.read_at(min((1 << 20) + _HEAD, size - at), at)
        k = window.find(_GZIP)
        while k >= 0:
            if _member(window[k : k + 64]).mark == mark:
                return at + k
            k = window.find(_GZIP, k + 1)
        if at + len(window) >= size:
            break
        at += len(window) - 64  # a member's head may lie across the border
    return size


def _payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """An HTTP message's body; any other block is the payload itself."""
    if headers.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _has_payload(headers: dict[str, str], payload: str) -> bool:
    return payload != "none" and headers.get("warc-type") != "revisit"


def records(source, start: int, end: int, mark: bytes | None, matches, payload: str) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload or None) of the wanted records of the members of a range."""
    size = source.size()
    at, stop = _first_member(source, start, size, mark), _first_member(source, end, size, mark)
    while at < stop:
        window = source.read_at(min(_HEAD, size - at), at)
        stated = _member(window).size
        inflater = zlib.decompressobj(31)
        text = inflater.decompress(window, _HEAD)
        used = at + len(window)
        while b"\r\n\r\n" not in text and not inflater.eof and (used < size or inflater.unconsumed_tail):
            more = inflater.unconsumed_tail or source.read_at(min(_HEAD, size - used), used)
            used += 0 if inflater.unconsumed_tail else len(more)
            text += inflater.decompress(more, _HEAD)
        head, _, rest = text.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        wanted = bool(headers) and matches(headers)
        full = wanted and _has_payload(headers, payload)
        if full or stated is None:  # inflate to the end, for the payload or to find the next member
            pieces = [rest]
            while not inflater.eof:
                more = inflater.unconsumed_tail
                if not more:
                    if used >= size:
                        raise ValueError("an archive ends within a record")
                    want = at + stated - used if stated else 1 << 16
                    more = source.read_at(max(1, min(want, size - used)), used)
                    used += len(more)
                piece = inflater.decompress(more)
                if full:
                    pieces.append(piece)
            following = used - len(inflater.unused_data)
        else:
            following = at + stated
        if wanted:
            yield headers, _payload_of(headers, b"".join(pieces)[: int(headers["content-length"])]) if full else None
        at = following


def plain_records(source, matches, payload: str) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload or None) of the wanted records of a file that is not compressed."""
    size, at = source.size(), 0
    while at < size:
        text = b""
        while b"\r\n\r\n" not in text and at + len(text) < size:
            text += source.read_at(min(_HEAD, size - at - len(text)), at + len(text))
        head, found, _ = text.partition(b"\r\n\r\n")
        if not found:
            if text.strip():
                raise ValueError("an archive ends within a record")
            return
        headers = parse_headers(head.lstrip())
        body, length = at + len(head) + 4, int(headers.get("content-length", 0))
        if headers and matches(headers):
            yield headers, _payload_of(headers, source.read_at(length, body)) if _has_payload(headers, payload) else None
        at = body + length
        while at < size and (gap := source.read_at(min(4, size - at), at)) and gap[:1] in b"\r\n":
            at += len(gap) - len(gap.lstrip(b"\r\n"))


class WarcSource(DataSource):
    """Format "warc". Options: path; payload ("keep", "check": read and verified but not returned, "none"); split_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "keep"), int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _chosen(keys: DataFrame, *row: str) -> DataFrame:
    """Per digest that several rows have: response (the largest page id), its rows (ties) and the first of them."""
    first = [F.min(c).alias(c) for c in row]
    each = keys.groupBy("digest", "page_id").agg(F.count("*").alias("rows"), *first)
    largest = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", F.col("rows").alias("ties"), *row)).alias("x")
    return each.groupBy("digest").agg(F.sum("rows").alias("n"), largest).where("n > 1").select("digest", F.col("x.page_id").alias("response"), "x.ties", *(F.col(f"x.{c}").alias(f"first{c}") for c in row))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, broadcast_rows: int = BROADCAST_DIGESTS) -> None:
    """Write page_id, url, html as archives; equal payloads of at least ``least_bytes`` bytes become revisits.

    Only ids and digests are shuffled to find equal payloads. The repeated digests
    are broadcast if they are at most ``broadcast_rows``, else joined by a shuffle of
    the pages.
    """
    spark = pages.sparkSession
    register(spark)
    small_batches(spark)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("uri"), F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    digest = F.when(F.octet_length("html") >= least_bytes, F.sha1("html"))
    keys = rows.select("page_id", digest.alias("digest")).where("digest is not null")
    twice = written(_chosen(keys), "repeated")
    n, tied = twice.agg(F.count("*"), F.max("ties")).first()
    own = F.col("page_id").eqNullSafe(F.col("response"))
    if tied is not None and tied > 1:  # rows that repeat the response's id: number them, in writing, to choose one
        rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        twice = written(_chosen(rows.select("page_id", "_row", digest.alias("digest")).where("digest is not null"), "_row"), "repeated")
        own = F.col("_row") == F.col("first_row")
    joined = rows.withColumn("digest", F.sha1("html")).withColumn("_key", digest).join(F.broadcast(twice.withColumnRenamed("digest", "_key")) if n <= broadcast_rows else twice.withColumnRenamed("digest", "_key"), "_key", "left")
    marked = joined.withColumn("revisit", F.col("ties").isNotNull() & ~own).withColumn("refers_to", F.when(F.col("revisit"), F.col("response")))
    marked.select("page_id", "uri", "html", "digest", "refers_to", "revisit").write.format("warc").mode("append").option("path", path).save()


def read_archives(spark: SparkSession, path: str, payload: str = "keep", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", payload).option("split_bytes", str(split_bytes)).load()


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back; payloads of responses are read and verified."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(pages.sparkSession, path, "check").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

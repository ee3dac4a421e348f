"""Legacy archive conversion: pages to ARC files, ARC records to WARC records, WARC files read back.

ARC files come in two versions whose record lines name other fields; the converter reads the version
block of each file, splits each record line by that version and takes as many bytes as the
line declares. A WARC record gets a synthesised identifier (a UUID of URL, date, page and digest), its date in ISO form,
its type and SHA-1 digests. Of equal payloads of at least ``REVISIT_BYTES`` bytes the record with the
largest page id is a response, and the others are revisits that carry its identifier, address and date instead of the payload.

Spark's text writer writes the archives: a row is a record, the separator is the format's own, and each
partition opens with its version block or warcinfo record. Records travel compressed where they are shuffled, and
files are read as a stream, so a Python worker holds one record at a time. All files lie in the shared folder of the session. A file
holds one partition of its input, and Spark reads files of less than 2 GB: compressed partitions stay far below while input splits have their
usual 128 MB; a larger file is an error, not a loss.

Defined results: null html is an empty payload; a null id makes a record without page id, which may revisit but is never
referred to (without any id in a group all are responses); null URLs become a placeholder URI; repeated rows are each a
record; a very long page is one record; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import as_bytes, prepare

REVISIT_BYTES = 1000
#: Pages carry no time of capture; the archives state this one.
ARCHIVED = "20200101000000"
ADDRESS = "0.0.0.0"

#: The record line of each ARC version, as its version block states it.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


def _batches(rows: Iterator[tuple], names: list[str], kinds: list, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number of bytes; the last column is the large one."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1] or b"") + 64
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


class Stream:
    """Reads a plain or gzip-compressed file's bytes piece by piece."""

    def __init__(self, content: bytes, step: int = 1 << 20):
        self._source = self._inflate(content, step) if content[:2] == b"\x1f\x8b" else iter([content])
        self._have, self._at = b"", 0  # a piece, and how far it is read

    @staticmethod
    def _inflate(content: bytes, step: int) -> Iterator[bytes]:
        rest = content
        while rest:  # a member after another
            member = zlib.decompressobj(wbits=31)
            while rest and not member.eof:
                yield member.decompress(rest, step)
                rest = member.unused_data if member.eof else member.unconsumed_tail
            yield member.flush()

    def _next(self) -> bool:
        self._have, self._at = next(self._source, b""), 0
        while not self._have:  # a member may end without bytes of its own
            piece = next(self._source, None)
            if piece is None:
                return False
            self._have = piece
        return True

    def line(self) -> bytes | None:
        """Up to and without the next line feed; None at the end."""
        parts = []
        while True:
            end = self._have.find(b"\n", self._at)
            if end >= 0:
                parts.append(self._have[self._at:end])
                self._at = end + 1
                return b"".join(parts)
            parts.append(self._have[self._at:])
            if not self._next():
                return b"".join(parts) or None

    def take(self, n: int) -> bytes:
        parts, got = [], 0
        while got < n:
            piece = self._have[self._at:self._at + n - got]
            self._at += len(piece)
            got += len(piece)
            parts.append(piece)
            if got < n and not self._next():
                raise ValueError(f"an archive record ends {n - got} bytes early")
        return parts[0] if len(parts) == 1 else b"".join(parts)


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "urn:x-unknown"


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 sensorium\n{ARC_FIELDS[version]}\n".encode()
    extra = "" if version == 1 else " 200 - - 0 " + name
    return f"filedesc://{name} {ADDRESS} {ARCHIVED} text/plain{extra} {len(body)}\n".encode() + body


def arc_record(version: int, name: str, url: str | None, page_id: str | None, payload: bytes) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"X-Page-Id: {page_id}\r\n".encode() if page_id is not None else b"") + b"\r\n"
    extra = "" if version == 1 else f" 200 {hashlib.sha1(payload).hexdigest()} - 0 {name}"
    return f"{_uri(url)} {ADDRESS} {ARCHIVED} text/html{extra} {len(http) + len(payload)}\n".encode() + http + payload


def read_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields of the record line, declared bytes) of each record of an ARC file, of either version."""
    s = Stream(content)
    head = s.line()
    if head is None:
        return
    block = s.take(int(head.rsplit(b" ", 1)[1])).split(b"\n")
    version = int(block[0].split(b" ")[0])
    names = ARC_FIELDS[version].split()
    if block[1].decode().split() != names:
        raise ValueError(f"unknown ARC {version} record line: {block[1]!r}")
    while (line := s.line()) is not None:
        if line.strip():
            fields = dict(zip(names, line.decode().split(" "), strict=True))
            yield fields, s.take(int(fields["Archive-length"]))


def _digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _record_id(uri: str, date: str, page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {page_id} {digest}')}>"


def _iso(date14: str) -> str:
    return f"{date14[:4]}-{date14[4:6]}-{date14[6:8]}T{date14[8:10]}:{date14[10:12]}:{date14[12:14]}Z"


def warc_record(kind: str, uri: str, ip: str, date: str, page_id: str | None, http: bytes, payload: bytes, refers_to: str | None,
                refers_uri: str | None = None, refers_date: str | None = None) -> bytes:
    """A response with the payload, or a revisit of the equal payload of the page ``refers_to``, captured at ``refers_uri`` on ``refers_date``."""
    digest = _digest(payload)
    block = http + (payload if kind == "response" else b"")
    fields = {"WARC-Type": kind, "WARC-Record-ID": _record_id(uri, date, page_id, digest), "WARC-Date": _iso(date), "WARC-Target-URI": uri, "WARC-IP-Address": ip,
              "WARC-Payload-Digest": digest, "WARC-Block-Digest": _digest(block), "Content-Type": "application/http; msgtype=response",
              "X-Page-Id": page_id, "X-Payload-Length": str(len(payload))}
    if kind == "revisit":
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page-Id": refers_to}
        if refers_uri is not None and refers_date is not None:
            fields |= {"WARC-Refers-To": _record_id(refers_uri, refers_date, refers_to, digest), "WARC-Refers-To-Target-URI": refers_uri,
                       "WARC-Refers-To-Date": _iso(refers_date)}
    fields["Content-Length"] = str(len(block))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n").encode() + block


def warc_info(name: str) -> bytes:
    body = b"software: sensorium\r\nformat: WARC File Format 1.1\r\n"
    return (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_record_id(name, ARCHIVED, None, '')}\r\nWARC-Date: {_iso(ARCHIVED)}\r\n"
            f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a WARC file."""
    s = Stream(content)
    while (line := s.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields = {}
        while line := (s.line() or b"").rstrip(b"\r"):
            k, _, v = line.decode().partition(": ")
            fields[k] = v
        yield fields, s.take(int(fields["Content-Length"]))


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def _write(rows: DataFrame, path: str, separator: str) -> None:
    """Binary rows as a gzip text table, byte for byte (a cast doesn't touch them), packed for speed."""
    rows.select(F.col("value").cast("string")).write.option("lineSep", separator).option("compression", "gzip") \
        .option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """``pages`` as ARC files, of version 1 in even and version 2 in odd partitions."""
    prepare(pages)
    picked = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[bytes]]:
            p = _partition()
            version, name, begun = 1 + p % 2, f"pages-{p:05d}.arc", False
            for b in batches:
                for page_id, url, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), as_bytes(b.column(2)), strict=True):
                    if not begun:
                        yield (arc_version_block(version, name),)
                        begun = True
                    yield (arc_record(version, name, url, page_id, payload),)
        return _batches(records(), ["value"], [pa.binary()])

    _write(picked.mapInArrow(run, "value binary"), path, "\n")


def convert_arc(spark, path: str) -> DataFrame:
    """The records of the ARC files in ``path``: page_id, uri, ip, date, sha1, sha256, http and packed (the zlib-compressed payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            for b in batches:
                for content in b.column(0):
                    for fields, body in read_arc(content.as_py()):
                        http, _, payload = body.partition(b"\r\n\r\n")
                        page_id = re.search(rb"^X-Page-Id: ([^\r\n]*)", http, re.M)
                        yield (page_id and page_id[1].decode(), fields["URL"], fields["IP-address"], fields["Archive-date"], hashlib.sha1(payload).hexdigest(),
                               hashlib.sha256(payload).hexdigest(), http + b"\r\n\r\n", zlib.compress(payload, 1))
        names = ["page_id", "uri", "ip", "date", "sha1", "sha256", "http", "packed"]
        return _batches(records(), names, [pa.string()] * 6 + [pa.binary()] * 2)

    return _files(spark, path).mapInArrow(run, "page_id string, uri string, ip string, date string, sha1 string, sha256 string, http binary, packed binary")


def write_warc(records: DataFrame, originals: DataFrame, path: str) -> None:
    """Converted ``records`` as WARC files; ``originals`` names per (sha1, sha256) the page that others refer to (refers_to), its address
    as in the pages (refers_url) and its capture date (refers_date, 14 digits)."""
    joined = records.join(originals, ["sha1", "sha256"], "left") \
        .select("page_id", "uri", "ip", "date", "refers_to", "refers_url", "refers_date", "http", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple[bytes]]:
            begun = False
            for b in batches:
                for page_id, uri, ip, date, first, first_url, first_date, http, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if not begun:
                        yield (warc_info(f"pages-{_partition():05d}.warc"),)
                        begun = True
                    kind = "response" if first is None or first == page_id else "revisit"
                    yield (warc_record(kind, uri, ip, date, page_id, http, zlib.decompress(packed), first, _uri(first_url), first_date),)
        return _batches(out(), ["value"], [pa.binary()])

    _write(joined.mapInArrow(run, "value binary"), path, "\r\n\r\n")


def read_warc_files(spark, path: str) -> DataFrame:
    """Responses and revisits of the WARC files in ``path``; each digest is checked against its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for b in batches:
                for content in b.column(0):
                    for f, block in read_warc(content.as_py()):
                        if f["WARC-Type"] not in ("response", "revisit"):
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        if f["WARC-Block-Digest"] != _digest(block) or (f["WARC-Type"] == "response" and (
                                f["WARC-Payload-Digest"] != _digest(payload) or len(payload) != int(f["X-Payload-Length"]))):
                            raise ValueError(f"digest of {f['WARC-Record-ID']} differs from its bytes")
                        digest = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        yield (f.get("X-Page-Id"), int(f["X-Payload-Length"]), f["WARC-Type"], f.get("X-Refers-To-Page-Id"), f["WARC-Target-URI"],
                               f["WARC-Record-ID"], f["WARC-Date"], digest)
        names = ["page_id", "payload_bytes", "record_type", "refers_to", "uri", "record_id", "date", "payload_digest"]
        return _batches(out(), names, [pa.string(), pa.int64()] + [pa.string()] * 6)

    return _files(spark, path).mapInArrow(run, "page_id string, payload_bytes long, record_type string, refers_to string, uri string, record_id string, date string, "
                                               "payload_digest string")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page, as read back from the WARC files: id, payload_bytes, payload_digest, record_type, refers_to, uri, record_id, date."""
    spark = prepare(pages)
    kind = pages.select(F.col(id_col).alias("id")).schema["id"].dataType
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    large = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("p")).filter(F.octet_length("p") >= REVISIT_BYTES)
    originals = large.select("id", "url", F.sha1("p").alias("sha1"), F.sha2("p", 256).alias("sha256")).groupBy("sha1", "sha256") \
        .agg(F.max(F.struct("id", "url")).alias("top"), F.count("*").alias("n")).filter("n > 1 and top.id is not null") \
        .select("sha1", "sha256", F.col("top.id").cast("string").alias("refers_to"), F.col("top.url").alias("refers_url"), F.lit(ARCHIVED).alias("refers_date"))
    write_warc(convert_arc(spark, arc), originals, warc)
    back = read_warc_files(spark, warc)
    return back.select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"), "uri", "record_id", "date")

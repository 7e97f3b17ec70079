"""Legacy ARC archives converted to WARC."""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from typing import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .tables import map_arrow, pieces, stored

#: Bytes of one archive, about; a record is not cut.
ARCHIVE_BYTES = 8 << 20
#: Packed bytes that are given to gzip at a time.
STEP_BYTES = 16 << 10
#: Payloads below this are never written as revisits.
REVISIT_BYTES = 100
GZIP_LEVEL = 4
# Fields of a record's header line in the two versions of the format.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ],
}
# Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"


# -- ARC ---------------------------------------------------------------------


def arc_line(version: int, url: str, date: str, kind: str, length: int, offset: int, name: str, ip="0.0.0.0") -> bytes:
    """A header line. White space in a URL is percent-encoded; no URL is '-'."""
    url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "-")
    middle = f" 200 - - {offset} {name}" if version == 2 else ""
    return f"{url} {ip} {date} {kind}{middle} {length}\n".encode()


def arc_head(version: int, name: str, date: str) -> bytes:
    """The version block that an archive begins with."""
    body = f"{version} 0 corpus\n{' '.join(FIELDS[version])}\n".encode()
    return arc_line(version, f"filedesc://{name}", date, "text/plain", len(body), 0, name) + body + b"\n"


def gzip_members(content: bytes) -> Iterator[bytes]:
    """What the gzip members of a file hold, one by one. Packed bytes are given
    out in small steps: what a member leaves over is copied, and must not be the
    rest of the file."""
    packed, at = memoryview(content), 0
    while at < len(packed):
        member, data = zlib.decompressobj(wbits=31), []
        while not member.eof:
            if at >= len(packed):
                raise ValueError("the archive is cut off")
            data.append(member.decompress(packed[at : at + STEP_BYTES]))
            at = min(at + STEP_BYTES, len(packed))
        at -= len(member.unused_data)
        yield b"".join(data)


def arc_records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each record after the version block, of a plain
    archive or of one whose records are gzip members, as they mostly are kept.

    The version block says which fields a header line has. They are split off
    from the right, since old archives have URLs with spaces in them. A block is
    as long as declared; what is shorter, or has no line before it, is an error.
    """
    if content[:2] == b"\x1f\x8b":
        content = b"".join(gzip_members(content))
    names, at = None, 0
    while at < len(content):
        if content[at : at + 1] in b"\r\n":
            at += 1
            continue
        stop = content.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"no header line at {at}")
        line = content[at:stop].decode("utf-8", "replace").rstrip("\r")
        first = names is None
        if first:
            names = FIELDS[_version(content, line, stop + 1)]
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not a header line at {at}: {line[:100]!r}")
        length = int(values[-1])
        block = content[stop + 1 : stop + 1 + length]
        if len(block) != length:
            raise ValueError(f"block at {at} has {len(block)} of {length} bytes")
        at = stop + 1 + length
        if not first:
            yield dict(zip(names, values)), block


def _version(content: bytes, line: str, body: int) -> int:
    if not line.startswith("filedesc:"):
        raise ValueError("an archive has to begin with its version block")
    version = int(content[body : content.find(b" ", body)])
    if version not in FIELDS:
        raise ValueError(f"unknown version {version}")
    return version


# -- WARC --------------------------------------------------------------------


def warc_date(arc_date: str) -> str:
    """A 14-digit date in WARC's form. Shorter dates are the beginning of their
    time; what is no date is the beginning of 1970."""
    digits = arc_date if re.fullmatch(r"\d{4,14}", arc_date) else "1970"
    d = digits + "00000101000000"[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head, with its empty line, and payload of an HTTP response; other blocks
    are all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    marks = (b"\r\n\r\n", b"\n\n")
    ends = [at + len(mark) for mark in marks if (at := block.find(mark)) >= 0]
    end = min(ends, default=len(block))
    return block[:end], block[end:]


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def warc_record(fields: dict[str, str | None], block: bytes) -> bytes:
    """A record as one gzip member."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    head = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode()
    return gzip.compress(head + block + b"\r\n\r\n", GZIP_LEVEL, mtime=0)


def warc_records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each record of a gzipped archive."""
    for data in gzip_members(content):
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:50]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


# -- Spark -------------------------------------------------------------------

RECORDS = (
    "key bigint, record_id string, target_uri string, warc_date string, ip string, warc_type string,"
    " content_type string, payload_bytes bigint, payload_digest string"
)


def to_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", key_header: str = "X-Page-Id",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """name, content: the pages as ARC archives, of version 1 and 2 by turns.
    Each page is an HTTP response with its key in a header; null payload is
    empty, null URL '-', and a null key has no header."""
    rows = pages.select(pages[key].cast("bigint").alias("key"), pages[url].alias("url"), pages[payload].alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"name": [name], "content": [b"".join(parts)]})

        for piece in pieces(batches, "text", archive_bytes, 1 << 20):
            for k, u, t in zip(*(piece.column(c).to_pylist() for c in ("key", "url", "text"))):
                if not parts:
                    name, version = f"{part:05d}-{n:05d}.arc", 1 + (part + n) % 2
                    parts = [arc_head(version, name, "19700101000000")]
                    size = len(parts[0])
                own = "" if k is None else f"{key_header}: {k}\r\n"
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}\r\n{t or ''}".encode()
                line = arc_line(version, u, "19700101000000", "text/html", len(block), size, name)
                parts += [line, block, b"\n"]
                size += len(line) + len(block) + 1
                if size >= archive_bytes:
                    yield archive()
                    n, parts = n + 1, []
        if parts:
            yield archive()

    return map_arrow(rows, pack, "name string, content binary")


def convert(archives: DataFrame, key_header: str = "X-Page-Id", blocks: bool = True) -> DataFrame:
    """One WARC record per ARC record: RECORDS, and with ``blocks`` also head and
    payload. ``key`` is the number in the HTTP header ``key_header``, else null.

    The record id is made of target, date, payload digest and key, so a record
    has the same id in every run (and records that repeat share one). The type is
    response for HTTP, resource for anything else; digests are SHA-256, hex."""
    schema = RECORDS + (", head binary, payload binary" if blocks else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [_converted(*record, key_header, blocks) for record in arc_records(content.as_py())]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA if blocks else _LIGHT)

    return map_arrow(archives.select("content"), read, schema)


_LIGHT = pa.schema(
    [("key", pa.int64())]
    + [(c, pa.string()) for c in ("record_id", "target_uri", "warc_date", "ip", "warc_type", "content_type")]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)
_SCHEMA = pa.schema([*_LIGHT, ("head", pa.binary()), ("payload", pa.binary())])


def _converted(fields: dict, block: bytes, key_header: str, blocks: bool) -> dict:
    head, payload = split_http(block)
    digest = hashlib.sha256(payload).hexdigest()
    key = _number(http_field(head, key_header))
    uri = None if fields["URL"] == "-" else fields["URL"]
    date = warc_date(fields["Archive-date"])
    row = {
        "key": key,
        "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {digest} {key}')}",
        "target_uri": uri,
        "warc_date": date,
        "ip": fields["IP-address"],
        "warc_type": "response" if head else "resource",
        "content_type": HTTP_TYPE if head else fields["Content-type"],
        "payload_bytes": len(payload),
        "payload_digest": digest,
    }
    return row | {"head": head, "payload": payload} if blocks else row


def revisits(records: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """record_id, refers_to (a record id), refers_uri, refers_date of the
    records that become revisits: payloads of ``min_bytes`` or more that another
    record with a smaller key has too. Null keys come last; records that share
    the smallest key all stay what they are."""
    light = records.select("key", "record_id", "target_uri", "warc_date", "payload_digest", "payload_bytes")
    large = light.where(F.col("payload_bytes") >= min_bytes)
    first = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "record_id", "target_uri", "warc_date"))
    firsts = large.groupBy(F.col("payload_digest").alias("of")).agg(first.alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1")
    found = large.join(firsts, large["payload_digest"] == firsts["of"])
    found = found.where(~F.col("key").eqNullSafe(F.col("first.key")))
    return found.select(
        "record_id",
        F.col("first.record_id").alias("refers_to"),
        F.col("first.target_uri").alias("refers_uri"),
        F.col("first.warc_date").alias("refers_date"),
    ).distinct()


def to_warc(archives: DataFrame, key_header: str = "X-Page-Id", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """name, content: the ARC archives as gzipped WARC archives, repeated
    payloads as revisits. Which records these are is found in a first pass that
    carries no payloads; records and revisits then meet by record id."""
    roles = revisits(convert(archives, key_header, blocks=False)).withColumnRenamed("record_id", "of")
    records = convert(archives, key_header)
    joined = records.join(roles, records["record_id"] == roles["of"], "left").drop("of")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"name": [f"{part:05d}-{n:05d}.warc.gz"], "content": [b"".join(parts)]})

        for piece in pieces(batches, "payload", archive_bytes, 1024):
            for row in piece.to_pylist():
                parts.append(_written(row))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield archive()
                    n, parts, size = n + 1, [], 0
        if parts:
            yield archive()

    return map_arrow(joined, write, "name string, content binary")


def _written(row: dict) -> bytes:
    revisit = row["refers_to"] is not None
    block = row["head"] if revisit else row["head"] + row["payload"]
    fields = {
        "WARC-Type": "revisit" if revisit else row["warc_type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": row["warc_date"],
        "WARC-Target-URI": row["target_uri"],
        "WARC-IP-Address": row["ip"],
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Payload-Length": str(row["payload_bytes"]),  # an extension field: a revisit has no payload
        "Content-Type": row["content_type"],
    }
    if revisit:
        fields |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": f"<{row['refers_to']}>",
            "WARC-Refers-To-Target-URI": row["refers_uri"],
            "WARC-Refers-To-Date": row["refers_date"],
        }
    return warc_record(fields, block)


READ = "key bigint, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_id string"


def read_warc(archives: DataFrame, key_header: str = "X-Page-Id") -> DataFrame:
    """READ for every record of WARC archives. A payload that doesn't fit its
    SHA-256 digest is an error. Records without such a digest get that of their
    payload; revisits without one, or without a payload length, have null, as has
    a record whose key is no number."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [_read(*record, key_header) for record in warc_records(content.as_py())]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    return map_arrow(archives.select("content"), read, READ)


_READ = pa.schema(
    [("key", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("refers_id", pa.string())]
)


def _read(fields: dict, block: bytes, key_header: str) -> dict:
    head, payload = split_http(block)
    kind, _, declared = fields.get("WARC-Payload-Digest", "").partition(":")
    declared = declared if kind == "sha256" else None
    revisit = fields.get("WARC-Type") == "revisit"
    if not revisit:
        digest = hashlib.sha256(payload).hexdigest()
        if declared not in (None, digest):
            raise ValueError(f"{fields['WARC-Record-ID']} doesn't fit its digest")
        declared = digest
    length = fields.get("WARC-Payload-Length")
    return {
        "key": _number(http_field(head, key_header)),
        "record_id": fields.get("WARC-Record-ID", "")[1:-1],
        "record_type": fields.get("WARC-Type"),
        "payload_bytes": (int(length) if length else None) if revisit else len(payload),
        "payload_digest": declared,
        "refers_id": fields.get("WARC-Refers-To", "")[1:-1] if revisit else None,
    }


def _number(text: str | None) -> int | None:
    """A number that a long holds, else null."""
    number = int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def converted(archives: DataFrame, key_header: str = "X-Page-Id") -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to (the key of
    the record that a revisit refers to), read back from WARC archives written
    to the shared folder."""
    records = stored(read_warc(stored(to_warc(archives, key_header), "warc", "none"), key_header), "records")
    targets = records.where("record_type <> 'revisit'").select(
        F.col("record_id").alias("of"), F.col("key").alias("refers_to")
    )
    named = records.join(targets.distinct(), F.col("refers_id") == F.col("of"), "left")
    return named.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to")

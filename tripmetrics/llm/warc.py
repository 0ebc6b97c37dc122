"""Operator 9: WARC archives as seekable Zstandard bundles.

Each task writes its records into archives of its own: records are grouped into
independent Zstandard frames and a seek table (a skippable frame with the
sizes and checksums of all frames) ends the file.  The index maps each record
to its archive, its frame and its offset inside the frame, so that one record is
read by decoding one frame.

File names are unique by task attempt.  The index of the attempts that counted
is materialised in the shared checkpoint folder, so a task that is run again
after a lost executor leaves at most an archive that nothing refers to.

Of records with equal payloads the one with the smallest id is a response and
the others are revisits of it, without payload (null ids count as the
largest; rows that tie for the smallest id are all responses).  Payloads
shorter than ``min_bytes`` are always responses.  A null payload is an empty
one.  A null URL is left out of the record; control characters in URLs are
percent-encoded.  Columns besides id, URL and payload are ignored.

Archives are written through ``pyarrow.fs``: local and shared folders,
``hdfs://`` and object stores that it supports.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut, ensure_checkpoint_dir, id_long

# fixed values of the seekable format
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_CHECKSUMS = 0x80

FRAME_BYTES = 1 << 20
ARCHIVE_BYTES = 256 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, archive string, frame int, offset long, length long"


def record_id(page_id) -> str:
    return "<urn:x-page:%s>" % ("none" if page_id is None else page_id)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url)


def format_record(page_id, url: str | None, payload: bytes, kind: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head and drops the payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + payload if kind == "response" else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Header fields, the HTTP head's payload length, and the payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["payload_bytes"] = int(re.search(rb"Content-Length: (\d+)", http)[1])
    fields["payload"] = payload
    return fields


class SeekableWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, out, frame_bytes: int) -> None:
        self._out, self._limit = out, frame_bytes
        self._zip = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self._parts: list[bytes] = []
        self._held = 0
        self._table: list[tuple[int, int, int]] = []
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the frame) of the record."""
        if self._held and self._held + len(record) > self._limit:
            self._flush()
        at = len(self._table), self._held
        self._parts.append(record)
        self._held += len(record)
        return at

    def _flush(self) -> None:
        raw = b"".join(self._parts)
        packed = self._zip.compress(raw)
        self._out.write(packed)
        self._table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.written += len(packed)
        self._parts, self._held = [], 0

    def close(self) -> None:
        if self._held:
            self._flush()
        body = b"".join(struct.pack("<III", *x) for x in self._table)
        body += struct.pack("<IBI", len(self._table), _CHECKSUMS, _SEEKABLE)
        self._out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self._out.close()


class SeekableReader:
    """Frames of an archive by number, found through its seek table."""

    def __init__(self, source) -> None:
        self._in = source
        end = source.size()
        n, flags, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != _SEEKABLE or flags != _CHECKSUMS:
            raise ValueError("no seek table")
        table = source.read_at(12 * n, end - 9 - 12 * n)
        self.frames, at = [], 0
        for packed, raw, check in struct.iter_unpack("<III", table):
            self.frames.append((at, packed, raw, check))
            at += packed
        self._unzip = zstandard.ZstdDecompressor()
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            at, packed, size, check = self.frames[k]
            raw = self._unzip.decompress(self._in.read_at(packed, at), max_output_size=size)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} is damaged")
            self._last = k, raw
        return self._last[1]


def _open(uri: str):
    """The file system of a URI (or local path), and the path in it."""
    path = re.sub("^file:/(?!/)", "/", uri)
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def read_record(archive: str, frame: int, offset: int, length: int) -> bytes:
    """One record, by decoding one frame."""
    fs, path = _open(archive)
    with fs.open_input_file(path) as f:
        return SeekableReader(f).frame(frame)[offset : offset + length]


def _writer(folder: str, date: str, frame_bytes: int, archive_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, uri = None, ""
        for pdf in batches:
            rows = []
            for page_id, url, html, kind, refers in zip(
                pdf["page_id"], pdf["url"], pdf["html"], pdf["record_type"], pdf["refers_to"], strict=True
            ):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out, uri = SeekableWriter(fs.open_output_stream(f"{base}/{name}", compression=None), frame_bytes), f"{folder}/{name}"
                payload = (html or "").encode("utf-8", "surrogatepass")
                record = format_record(page_id, url, payload, kind, refers, date)
                frame, offset = out.add(record)
                rows.append((record_id(page_id), uri, frame, offset, len(record)))
                if out.written >= archive_bytes:
                    out.close()
                    out = None
            yield pd.DataFrame(rows, columns=["record_id", "archive", "frame", "offset", "length"])
        if out is not None:
            out.close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write ``pages(page_id, url, html)`` under ``folder`` and return the index
    ``(record_id, archive, frame, offset, length)``, one row per page."""
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).withColumn("sha1", F.when(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes, F.sha1(F.coalesce("html", F.lit("")))))
    first = (
        own.where("sha1 is not null")
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("c"))
        .where("c > 1 and first_id is not null")
        .select("sha1", "first_id")
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    typed = own.join(first, "sha1", "left").select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        # a revisit needs the payload's length and digest, which its record gets from the text
        "html",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id").cast("string")).alias("refers_to"),
    )
    return cut(typed.mapInPandas(_writer(folder, date, frame_bytes, archive_bytes), INDEX))


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def page(text: str):
        found = text.removeprefix("<urn:x-page:").removesuffix(">")
        return None if found == "none" else found

    for pdf in batches:
        rows = []
        for archive, part in pdf.groupby("archive", sort=False):
            fs, path = _open(archive)
            with fs.open_input_file(path) as f:
                reader = SeekableReader(f)
                for want, frame, offset, length in zip(
                    part["record_id"], part["frame"], part["offset"], part["length"], strict=True
                ):
                    got = parse_record(reader.frame(frame)[offset : offset + length])
                    if got["WARC-Record-ID"] != want:
                        raise ValueError(f"{want}: the index points at {got['WARC-Record-ID']}")
                    digest = got["WARC-Payload-Digest"].removeprefix("sha1:")
                    if got["WARC-Type"] == "response" and payload_digest(got["payload"]) != digest:
                        raise ValueError(f"{want}: the payload is damaged")
                    refers = got.get("WARC-Refers-To")
                    rows.append(
                        (
                            page(want),
                            got.get("WARC-Target-URI"),
                            got["payload_bytes"],
                            digest,
                            got["WARC-Type"],
                            None if refers is None else page(refers),
                        )
                    )
        yield pd.DataFrame(
            rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        )


def read_archives(index: DataFrame) -> DataFrame:
    """Read every indexed record back, each checked against its digest:
    ``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)``."""
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    return id_long(index.mapInPandas(_reader, schema), "page_id", "refers_to")


def archive_folder(spark) -> str:
    """A new folder for archives under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"

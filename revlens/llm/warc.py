"""WARC archives with revisits resolved by payload digest.

1. Every page becomes a record; its payload digest (base32 SHA-1) and length
   are computed where the page is read.
2. Headers (digest, page id) are shuffled: a partial minimum for each digest finds
   the original response; the headers are joined to it by digest, which leaves the revisits.
3. Fresh archives are written: originals as ``response`` records with their
   payload, all others as ``revisit`` records that refer to the original and
   carry no payload.
4. ``read_warc`` parses the archives back, record by record.

Archives are gzip-compressed WARC/1.1 files of a bounded number of records,
written and read by Spark's text files (a record ends with two line ends, which
is the writer's line separator), so they can lie in any store that Spark reaches.
A gzip file is read by one task from its beginning, as a stream.

Defined results: null html is an empty payload; a null url gives a record without a target.
Rows with the same page_id and the same payload are the same record: all of them are the
response.  A page without an id comes last among its equals, and refers to
nothing when all of them lack one.  Empty input gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, scratch, stored

VERSION = "WARC/1.1"
END = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
#: Revisits (an id, a digest and an id each) up to this number are broadcast.
BROADCAST_REVISITS = 500_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = re.compile(r"^<urn:page:(-?\d+)>$")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digests(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads = [(x or "").encode() for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(map(len, payloads), pa.int64()),
                 pa.array(map(payload_digest, payloads), pa.string())],
                ["page_id", "url", "html", "payload_bytes", "payload_digest"])

    return (pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                         F.col(f"`{url_col}`").cast("string").alias("url"),
                         F.col(f"`{html_col}`").cast("string").alias("html"))
            .transform(arrow_map, run, "page_id long, url string, html string, payload_bytes long, payload_digest string"))


def resolve_revisits(headers: DataFrame) -> DataFrame:
    """(payload_digest, page_id) rows to one original response for each digest.

    The shuffle carries a digest and an id for each task and digest; a payload that a third
    of all pages share is combined before it.
    """
    return headers.groupBy("payload_digest").agg(F.min("page_id").alias("original"))


def revisits(headers: DataFrame, originals: DataFrame) -> DataFrame:
    """(page_id, payload_digest, original) of the pages that are not the original of their payload."""
    return (headers.join(originals, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("original")))
            .select("page_id", "payload_digest", "original").distinct())


def resolved(records: DataFrame, again: DataFrame) -> DataFrame:
    """Records with record_type and refers_to.  Few enough revisits are broadcast, so that payloads stay where
    they were read; more are joined by a shuffle."""
    again = again.select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"),
                         F.col("original").alias("refers_to"), F.lit(True).alias("_again"))
    if again.count() <= BROADCAST_REVISITS:
        again = F.broadcast(again)
    on = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    return (records.join(again, on, "left")
            .withColumn("record_type", F.when(F.col("_again"), "revisit").otherwise("response"))
            .drop("_page", "_digest", "_again"))


def _line(name: str, value) -> str:
    return "" if value is None else f"{name}: {value}\r\n"


def record(page_id, url, html, payload_bytes, digest, kind, refers_to, date: str) -> bytes:
    """One record without its final two line ends."""
    payload = (html or "").encode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
            ).encode()
    block = http + (payload if kind == "response" else b"")
    target = None if url is None else re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url)
    head = (f"{VERSION}\r\nWARC-Type: {kind}\r\n" + _line("WARC-Record-ID", f"<urn:page:{page_id}>")
            + _line("WARC-Date", date) + _line("WARC-Target-URI", target)
            + _line("WARC-Payload-Digest", f"sha1:{digest}") + _line("X-Payload-Length", payload_bytes)
            + _line("WARC-Block-Digest", f"sha1:{payload_digest(block)}")
            + ("" if kind == "response" else _line("WARC-Profile", PROFILE)
               + _line("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"))
            + _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", len(block)))
    return head.encode() + b"\r\n" + block


def write_warc(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z",
               records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write resolved records (page_id, url, html, payload_bytes, payload_digest, record_type, refers_to)."""
    cols = ["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = zip(*(c.to_pylist() for c in b.slice(at, 256).columns))
                yield pa.RecordBatch.from_arrays([pa.array([record(*r, date) for r in rows], pa.binary())], ["value"])

    (records.select(*cols).transform(arrow_map, run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
     .text(path))


class Parser:
    """Records out of the pieces of an archive between line feeds, in order."""

    def __init__(self):
        self.kept: list[bytes] = []
        self.size = 0
        self.need = 0
        self.head: list[bytes] = []
        self.fields: dict[str, str] | None = None

    def feed(self, piece: bytes):
        """A finished (fields, block) or None.  ``piece`` ended with a line feed."""
        if self.fields is None:
            if piece.rstrip(b"\r"):
                self.head.append(piece)
            elif self.head:
                if not self.head[0].startswith(b"WARC/"):
                    raise ValueError("not a WARC record")
                pairs = (x.decode().rstrip("\r").partition(":") for x in self.head[1:])
                self.fields = {k.strip().lower(): v.strip() for k, _, v in pairs}
                self.need, self.head = int(self.fields["content-length"]), []
            return None
        self.kept.append(piece)
        self.size += len(piece) + 1
        if self.size < self.need + 4:
            return None
        data = b"\n".join([*self.kept, b""])
        if data[self.need:] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where its length says")
        out = self.fields, data[:self.need]
        self.kept, self.size, self.fields = [], 0, None
        return out

    def end(self) -> None:
        if self.fields is not None or self.head:
            raise ValueError("an archive ends within a record")


def _page(value: str | None) -> int | None:
    m = ID.match(value or "")
    return int(m[1]) if m else None


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to
    (and payload: of a response; a revisit has none).  Block digests and, for responses, payload digests are
    checked."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    names += ["payload"] if with_payload else []
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def row(fields: dict, block: bytes) -> tuple:
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if "sha1:" + payload_digest(block) != fields["warc-block-digest"]:
            raise ValueError("a WARC block is damaged")
        payload = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
        if payload is not None and payload_digest(payload) != digest:
            raise ValueError("a WARC payload is damaged")
        out = (_page(fields["warc-record-id"]), fields.get("warc-target-uri"), int(fields["x-payload-length"]), digest,
               fields["warc-type"], _page(fields.get("warc-refers-to")))
        return (*out, payload) if with_payload else out

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file, rows = Parser(), None, []
        for b in batches:
            for piece, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name != file:
                    parser.end()
                    parser, file = Parser(), name
                if (done := parser.feed(piece)) is not None:
                    rows.append(row(*done))
                    if len(rows) >= 256:
                        yield made(rows)
                        rows = []
        parser.end()
        if rows:
            yield made(rows)

    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long" + (", payload binary" if with_payload else ""))
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
            .transform(arrow_map, run, schema))


def deduplicate_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                         html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Pages to archives in which every payload stands once."""
    records = digests(pages, id_col, url_col, html_col)
    headers = stored(records.select("payload_digest", "page_id"), "headers")
    again = stored(revisits(headers, resolve_revisits(headers)), "revisits")
    write_warc(resolved(records, again), path, date)


def warc_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write deduplicated archives into the shared folder and read them back."""
    path = scratch(pages.sparkSession, "warc")
    deduplicate_archives(pages, path, **options)
    return read_warc(pages.sparkSession, path)

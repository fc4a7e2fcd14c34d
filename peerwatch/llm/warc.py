"""Operator 10: WARC archives: a writer, and a Python data source to read them.

Writing is a Spark text write whose line separator is the end of a record, so it works on every file system that Spark
reaches and is as safe against lost tasks as any Spark write.  Equal payloads are stored once: the record with the
largest page id holds it (``response``), all others refer to it (``revisit``).

Reading plans whole files, packed up to ``BIN_BYTES``, as partitions.  The headers of a record are parsed first; if they do
not pass the predicates that Spark pushed down (equality, IN and IS [NOT] NULL on header columns), or if the payload
is not wanted (option ``payload``), its bytes are skipped in pieces and never decoded.

Scale: payloads are shuffled once, by digest; Spark splits a hot digest in the join (the other side has one row for
each).  Digests are SHA-256 and length together, so different payloads do not meet.

Defined results: null html counts as empty; a null ``page_id`` never holds a payload that another row has, and its
records are written as page ``none``; rows equal in id and payload are both ``response``; a null url is written as empty; other
columns are not touched.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
)

from peerwatch.llm.common import table
from peerwatch.session import work_folder

#: Payloads below this many bytes are always stored.
LEAST_BYTES = 0
BIN_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, content_type string, "
    "content_length long, payload_digest string, refers_to string, payload_bytes long, payload binary"
)
#: Column: header; a fixed list of the format (the last one is an extension field).
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "content_type": "content-type",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


def base32_sha1(raw: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits are four letters."""
    hexed = F.sha1(raw)
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for group in range(8):
        value = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def _page(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, *, least_bytes: int = LEAST_BYTES) -> None:
    """WARC files (gzip) with one record for each row of page_id, url, html."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"sha": F.sha2("html", 256), "size": F.octet_length("html")})
    holder = rows.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(F.max("page_id").alias("holder"))
    rows = rows.join(holder, ["sha", "size"], "left")
    first = F.col("holder").isNull() | F.col("holder").eqNullSafe(F.col("page_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END)
    )
    block = F.when(first, F.concat(http, F.col("html"))).otherwise(http)
    rows = rows.select("page_id", "url", "size", "holder", first.alias("first"), block.alias("block"), base32_sha1(F.col("html")).alias("digest"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("first"), "response").otherwise("revisit")),
        line("WARC-Record-ID", _page(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("X-Payload-Bytes", F.col("size").cast("string")),
        F.when(F.col("first"), F.lit("")).otherwise(
            F.concat(
                line("WARC-Refers-To", _page(F.col("holder"))),
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
            )
        ),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
        F.col("block"),
    )
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


class _Files(InputPartition):
    def __init__(self, paths):
        super().__init__(tuple(paths))


class _Stream(io.RawIOBase):
    """Bytes of a file, of all its gzip members if it is compressed."""

    def __init__(self, source, zipped: bool):
        self.source, self.zipped = source, zipped
        self.inflate, self.rest = (zlib.decompressobj(31) if zipped else None), b""

    def readable(self):
        return True

    def readinto(self, buffer):
        room = len(buffer)
        while True:
            if not self.zipped:
                got = self.source.read(room)
                buffer[: len(got)] = got
                return len(got)
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
                if not self.rest and not (more := self.source.read(1 << 16)):
                    return 0
                self.rest = self.rest or more
                self.inflate = zlib.decompressobj(31)
            raw = self.rest or self.inflate.unconsumed_tail or self.source.read(1 << 16)
            self.rest = b""
            got = self.inflate.decompress(raw, room)
            if got:
                buffer[: len(got)] = got
                return len(got)
            if not raw:
                return 0


def records(stream, wanted, payload: bool) -> Iterator[dict]:
    """Records of one archive.  ``wanted`` looks at the header columns before anything of the block is read."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:60]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        left = int(headers.get("content-length", 0))
        row = {column: headers.get(header) for column, header in HEADERS.items()}
        row["content_length"] = left
        row["payload_bytes"] = int(headers["x-payload-bytes"]) if "x-payload-bytes" in headers else None
        keep = wanted(row)
        row["payload"] = None
        if keep and payload and row["record_type"] != "revisit":
            block = stream.read(left)
            if (row["content_type"] or "").startswith("application/http"):
                block = block.partition(b"\r\n\r\n")[2]
            row["payload"] = block
        else:
            while left > 0 and (skipped := len(stream.read(min(left, 1 << 16)))):
                left -= skipped
        if keep:
            yield row


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In, IsNull, IsNotNull)):
                self.tests.append((type(f).__name__, column, getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row) -> bool:
        for kind, column, value in self.tests:
            have = row[column]
            if not {"EqualTo": have == value and have is not None, "In": kind == "In" and have in (value or ()), "IsNull": have is None, "IsNotNull": have is not None}[kind]:
                return False
        return True

    def partitions(self):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.path) if ":/" in self.path else (fs.LocalFileSystem(), self.path)
        info = system.get_file_info(path)
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        files = [f for f in files if f.is_file and f.base_name[0] not in "._"]
        bins, now, size = [], [], 0
        for f in sorted(files, key=lambda f: f.path):
            if now and size + f.size > BIN_BYTES:
                bins.append(now)
                now, size = [], 0
            now.append(f.path)
            size += f.size
        return [_Files(b) for b in [*bins, now] if b] or [_Files(())]

    def read(self, partition):
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.path)[0] if ":/" in self.path else fs.LocalFileSystem()
        for path in partition.value:
            with system.open_input_stream(path, compression=None) as source:
                stream = io.BufferedReader(_Stream(source, path.endswith(".gz")), 1 << 16)
                rows, size = [], 0
                for row in records(stream, self.wanted, self.payload):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)


_TYPES = [pa.field(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (c.split() for c in SCHEMA.split(", "))]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(_TYPES))


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; option ``payload`` false leaves payloads out."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)


def read_archive(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """The records of all archives below the path.  Turns on filter push-down for Python sources in the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{work_folder(spark)}-warc"
    write_archive(table(spark, folder, "pages"), path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    kept = read_archive(spark, path).where(F.col("record_type") == "response").select(
        page(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    again = read_archive(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        page(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        F.substring("payload_digest", 6, 32).alias("payload_digest"),
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )
    return kept.unionByName(again)


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS holder FROM p)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to
FROM g
"""

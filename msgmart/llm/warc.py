"""WARC archives with revisit records.

1. Headers of all pages (digests, length, id; no payload) are grouped by digest. The smallest id of
   a group is the original, all others revisit it. Digests with many pages are joined apart, so no
   task gets a group.
2. Pages that revisit another get a revisit record, all others a response record, each with fresh
   headers. Payloads are shuffled once at most, for this join; a file is closed after as many records
   as have about `archive_mb` of payload.
3. Spark's text writer writes the archives. A record ends with two line breaks, which is the
   writer's line separator here; its committer drops what lost or repeated tasks have written.
4. Reading parses whole archives, gzipped or not, in batches of records.

Payloads are equal if their SHA-1, SHA-256 and lengths are. Those shorter than `least` bytes are
never revisited. Null html is an empty payload, a null url an empty target. Rows of one id are
records of their own; of equal payloads with equal ids one, chosen by its row number, is the
response. A null id is larger than all others. An empty table gives no records. Other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgmart.llm.scratch import Scratch
from msgmart.llm.skew import join_groups

#: Fixed values of the WARC format.
END, VERSION = "\r\n\r\n", "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Bytes after which a reader hands on the records it has.
READ = 8_000_000


def base32(sha1_hex: Column) -> Column:
    """The 40 hex digits of a SHA-1 as 32 base-32 digits: every 5 hex digits are 4 of these."""
    digits = []
    for k in range(8):
        part = F.conv(F.substring(sha1_hex, 5 * k + 1, 5), 16, 10).cast("int")
        digits += [F.substring(F.lit(BASE32), F.shiftright(part, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*digits)


def resolve(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """The rows of `pages` (uid, page_id, url, payload, sha1, bytes) with original_uid and refers_to, null for responses."""
    headers = pages.where(F.col("bytes") >= least).select("uid", "page_id", "sha1", F.sha2("payload", 256).alias("sha2"), "bytes")
    keys = ["sha1", "sha2", "bytes"]
    headers = scratch.keep(headers, "headers")
    order = F.struct(F.col("page_id").isNull().alias("a"), "page_id", "uid")
    originals = headers.groupBy(*keys).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    originals = scratch.keep(originals.select(*keys, "members", F.col("first.uid").alias("original_uid"), F.col("first.page_id").alias("refers_to")), "originals")
    revisits = join_groups(headers, originals, keys, "members", headers.count()).where("uid != original_uid").select("uid", "original_uid", "refers_to")
    return pages.join(revisits, "uid", "left")


def _field(name: str, value) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))


def record(date: str) -> Column:
    """The record of a row of `resolve`, without the line breaks that end it."""
    kind = F.when(F.col("original_uid").isNull(), "response").otherwise("revisit")
    name = lambda uid: F.concat(F.lit("<urn:uuid:"), _uuid(uid), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END)).cast("binary")
    block = F.when(F.col("original_uid").isNull(), F.concat(http, F.col("payload"))).otherwise(http)
    line = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"[\r\n]", " ")
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", name(F.col("uid"))),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", line(F.col("url"))),
        F.when(F.col("page_id").isNotNull(), _field("X-Page-ID", F.col("page_id").cast("string"))).otherwise(""),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _field("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(kind == "revisit", F.concat(_field("WARC-Profile", PROFILE), _field("WARC-Refers-To", name(F.col("original_uid"))))).otherwise(""),
        F.when((kind == "revisit") & F.col("refers_to").isNotNull(), _field("X-Refers-To-Page", F.col("refers_to").cast("string"))).otherwise(""),
        _field("Content-Type", "application/http; msgtype=response"),
        _field("Content-Length", F.length(block).cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(head.cast("binary"), block).cast("string")


def _uuid(uid: Column) -> Column:
    x = F.md5(uid.cast("string").cast("binary"))
    return F.concat_ws("-", F.substring(x, 1, 8), F.substring(x, 9, 4), F.concat(F.lit("4"), F.substring(x, 14, 3)), F.concat(F.lit("8"), F.substring(x, 18, 3)), F.substring(x, 21, 12))


def write(pages: DataFrame, path: str, scratch: Scratch, least: int = 0, archive_mb: int = 32, date: str = "2020-01-01T00:00:00Z") -> None:
    """Writes the archives of `pages` (page_id, url, html) below `path`."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = scratch.keep(rows.select("*", F.sha1("payload").alias("sha1"), F.length("payload").cast("long").alias("bytes")), "pages")
    mean = rows.select(F.mean("bytes")).first()[0] or 1
    records = max(1, int((archive_mb << 20) / max(1, mean)))
    resolved = resolve(rows, scratch, least).select(record(date).alias("value"))
    resolved.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)
    scratch.drop("headers", "originals", "pages")


class _Records:
    """The records of an archive, which is decompressed and parsed as it is read."""

    def __init__(self, content: bytes):
        self.content, self.at = memoryview(content), 0
        self.inflate = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        self.held = bytearray()

    def more(self) -> bool:
        """Takes in the next part; false at the end."""
        if self.at >= len(self.content):
            return False
        part = bytes(self.content[self.at : self.at + (1 << 20)])
        self.at += len(part)
        while part:
            if self.inflate is None:
                self.held += part
                return True
            self.held += self.inflate.decompress(part)
            part = self.inflate.unused_data
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
        return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        end = END.encode()
        while True:
            while (split := self.held.find(end)) < 0:
                if not self.more():
                    if self.held:
                        raise ValueError("an archive ends within a record")
                    return
            first, *lines = self.held[:split].decode().split("\r\n")
            if first != VERSION:
                raise ValueError(f"not a record: {first[:40]!r}")
            fields = dict(x.split(": ", 1) for x in lines)
            whole = split + 4 + int(fields["Content-Length"]) + 4
            while len(self.held) < whole:
                if not self.more():
                    raise ValueError("an archive ends within a record")
            yield fields, bytes(self.held[split + 4 : whole - 4])
            del self.held[:whole]


SCHEMA = "page_id long, record_type string, refers_to long, target string, payload_digest string, payload_bytes long, record_id string, refers_to_record string, payload binary"


def _parse(payloads: bool):
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in _Records(content.as_buffer().to_pybytes()):
                    body = block[block.index(END.encode()) + 4 :]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and (base64.b32encode(hashlib.sha1(body).digest()).decode() != digest or len(body) != int(fields["X-Payload-Length"])):
                        raise ValueError(f"a payload does not have its digest: {fields['WARC-Record-ID']}")
                    rows.append((number(fields.get("X-Page-ID")), kind, number(fields.get("X-Refers-To-Page")), fields["WARC-Target-URI"], digest, int(fields["X-Payload-Length"]), fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), body if payloads and kind == "response" else None))
                    held += len(body) if payloads else 200
                    if held > READ:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    return run


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the archives below `path`; a response's digest and length are verified. `payloads`: also return these."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_parse(payloads), SCHEMA)

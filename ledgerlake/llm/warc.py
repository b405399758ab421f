"""WARC archives with revisit records instead of repeated payloads.

Payload digests are shuffled as headers (digest, length, page id), never with their payloads: those
of at least ``min_bytes`` that occur more than once get the smallest page id as their
original. The list of these digests is looked up behind a size check (beyond the bound pages are
joined to it by digest); the other records of a listed digest become revisits. Archives are
written by Spark's own writer (one record after another, gzip), so that a lost task
is written again and any shared file system works; every record gets fresh headers.
Reading parses each archive record by record, checks response digests against the
payload, and joins revisits to their original's header by digest.

Edges: a null or empty html is an empty payload, always a response; null urls are
empty, line breaks in urls are removed; rows that repeat the original's id and payload are
responses too; a row with a null id revisits the smallest known id, and is a
response where its group has none; ids of any type are escaped in record ids, where null has a name of
its own; an empty table writes an archive without records
and reads as empty; columns other than ``page_id``, ``url`` and ``html`` don't matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import ship_package, written
from ledgerlake.operators.joins import lookup_side

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"

MIN_BYTES = 100
RECORDS_PER_ARCHIVE, ARCHIVE_BYTES = 20_000, 64 << 20
NO_ID = "<urn:null>"


def _record_id(page_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("<urn:page:"), F.url_encode(page_id.cast("string")), F.lit(">")), F.lit(NO_ID))


def payload_headers(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]+", "").alias("uri"),
                        html.alias("payload"), F.octet_length(html).cast("long").alias("bytes"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))


def records(pages: DataFrame, min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z",
            headers: DataFrame | None = None) -> DataFrame:
    """One string per page: a response with its payload, or a revisit without."""
    rows = payload_headers(pages)
    headers = rows.select("page_id", "bytes", "digest") if headers is None else headers
    originals = written(headers.where(F.col("bytes") >= min_bytes).groupBy("digest")
                        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1 and original is not null").drop("n"), "warc-originals")
    rows = rows.join(lookup_side(originals), "digest", "left")
    revisit = F.col("original").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("original")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block_bytes = F.octet_length("http") + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"), line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                          line("WARC-Refers-To", _record_id(F.col("original"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block_bytes.cast("string")), F.lit("\r\n"))
    rows = rows.withColumn("revisit", revisit).withColumn("http", http)
    return rows.select(F.concat(head, "http", F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload"))).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> str:
    headers = written(payload_headers(pages).select("page_id", "bytes", "digest"), "warc-headers")
    mean = headers.agg(F.avg("bytes")).first()[0] or 0
    per_archive = max(1, min(RECORDS_PER_ARCHIVE, int(ARCHIVE_BYTES / max(mean, 1))))  # an archive is read whole by a task
    (records(pages, min_bytes, headers=headers).write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", per_archive).text(path))
    return path


class _Stream:
    """Bytes of a gzip file, inflated as they are asked for."""

    def __init__(self, packed: bytes):
        self.packed, self.at = memoryview(packed), 0
        self.inflate, self.have = zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        while self.at < len(self.packed):
            data = self.inflate.decompress(self.packed[self.at:self.at + 65536])
            self.at += 65536
            while self.inflate.eof and self.inflate.unused_data:  # the next member
                rest = self.inflate.unused_data
                self.inflate = zlib.decompressobj(31)
                data += self.inflate.decompress(rest)
            if data:
                self.have += data
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (end := self.have.find(mark, seen)) < 0:
            seen = max(0, len(self.have) - len(mark))
            if not self._more():
                if self.have:
                    raise ValueError("truncated archive")
                return None
        return self.take(end + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self._more():
                raise ValueError("truncated archive")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def parse(packed: bytes) -> Iterator[dict]:
    """Headers of one archive's records, with the payload of responses."""
    stream = _Stream(packed)
    while (head := stream.until(RECORD_END.encode())) is not None:
        lines = head.decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = dict(x.split(": ", 1) for x in lines[1:] if x)
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(4) != RECORD_END.encode():
            raise ValueError("a record does not end where its length says")
        _, _, payload = block.partition(b"\r\n\r\n")
        yield fields | {"payload": payload}


_FIELDS = "page string, record_type string, payload_bytes long, payload_digest string, refers string, uri string"


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below ``path``."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import warc
        names = ["page", "record_type", "payload_bytes", "payload_digest", "refers", "uri"]
        for b in batches:
            for content in b.column("content"):
                rows = []
                for r in warc.parse(content.as_py()):
                    digest = r["WARC-Payload-Digest"].removeprefix("sha256:")
                    if r["WARC-Type"] == "response" and hashlib.sha256(r["payload"]).hexdigest() != digest:
                        raise ValueError(f"payload of {r['WARC-Record-ID']} does not match its digest")
                    rows.append((r["WARC-Record-ID"], r["WARC-Type"], len(r["payload"]), digest, r.get("WARC-Refers-To"),
                                 r["WARC-Target-URI"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, _FIELDS)


def resolve_revisits(headers: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits
    joined to the header of their original response by payload digest."""
    page = lambda c: F.url_decode(F.regexp_extract(c, r"^<urn:page:(.*)>$", 1))
    known = lambda c: F.when(F.col(c) != NO_ID, page(c)).cast(id_type)
    responses = headers.where("record_type = 'response'").select(
        known("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(id_type).alias("refers_to"))
    originals = (headers.where("record_type = 'response'").groupBy("payload_digest")
                 .agg(F.max("payload_bytes").alias("original_bytes")))
    revisits = (headers.where("record_type = 'revisit'").drop("payload_bytes").join(originals, "payload_digest", "left")
                .select(known("page").alias("page_id"), F.col("original_bytes").alias("payload_bytes"), "payload_digest",
                        "record_type", known("refers").alias("refers_to")))
    return responses.unionByName(revisits)


def archive_pages(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archives of all pages below ``path``, read them back, resolve."""
    write_archives(pages, path, min_bytes)
    return resolve_revisits(read_headers(pages.sparkSession, path), pages.schema["page_id"].dataType.simpleString())

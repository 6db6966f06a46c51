"""WARC archives: written and read by Spark, transactions assembled through concurrent-to identifiers.

Each page becomes a request, a response or revisit, and a metadata record. Request and metadata name the
capture's record in WARC-Concurrent-To; the page id travels in the metadata record, so a row is whole only
after assembly. Of equal payloads of at least ``min_bytes`` bytes, the page of the largest id (then url) is
the response; the others are revisits without a payload that refer to it.

Files are written by Spark's text writer, a record a line and CRLF CRLF as the separator, gzip over each
file; they are bounded by ``records_per_file``. The reader takes whole files as rows and streams through
the uncompressed records one by one, trusting Content-Length, never separators inside payloads.

Null html is an empty payload; null urls are empty; a null page id ranks last. Pages repeated as a whole
are stored once with a count and come back as often: the first as its type says, the others as revisits
of it when the payload is large enough. Empty tables give empty archives. Requests and metadata without
a capture yield no row; of several metadata records of a capture the least record id counts.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskspark.llm.common import joined_by_key, schema_of, stored

CRLF = "\r\n"
MIN_BYTES = 1000
RECORD = (
    "record_id string, record_type string, target_uri string, warc_date string, concurrent_to string, refers_to string, "
    "header_digest string, http_head string, payload binary, payload_bytes long, payload_digest string, fields map<string,string>"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def urn(kind: str, *parts: Column) -> Column:
    """A name-based record id."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """Record text; headers with a null value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    size = F.octet_length(block).cast("string")
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), F.concat_ws(CRLF, *lines, F.concat(F.lit("Content-Length: "), size)), F.lit(CRLF * 2), block)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = MIN_BYTES, records_per_file: int = 3_000) -> None:
    clean = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[\r\n]", "")  # noqa: E731  a header is one line
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), clean(F.col(url_col)).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        F.sha1(F.coalesce(F.col(html_col), F.lit("")).cast("binary")).alias("digest"),
    )
    narrow = stored(rows.select("id", "url", "digest", F.octet_length("html").alias("bytes")).groupBy("id", "url", "digest", "bytes").agg(F.count("*").alias("copies")), "warc-pages")
    shared = stored(
        narrow.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max(F.struct(F.col("id"), F.col("url"))).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url")), "warc-shared")
    repeated = stored(narrow.where("copies > 1").select("id", "url", "digest", "copies"), "warc-repeated")
    if not repeated.isEmpty():
        on = [rows[c].eqNullSafe(repeated[c]) for c in ("id", "url", "digest")]
        rows = rows.dropDuplicates(["id", "url", "digest"]).join(repeated, on, "left").select(*[rows[c] for c in rows.columns], "copies")
    else:
        rows = rows.withColumn("copies", F.lit(None).cast("long"))
    rows = joined_by_key(rows, shared, ["digest"])
    revisit = F.col("first_url").isNotNull() & ~(F.col("first_id").eqNullSafe(F.col("id")) & (F.col("first_url") == F.col("url")))
    me = urn("capture", F.col("id"), F.col("url"), F.col("digest"))
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("html").cast("string"), F.lit(CRLF * 2))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", date)]
    request = record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", urn("request", F.col("id"), F.col("url"), F.col("digest"))), *common,
         ("WARC-Concurrent-To", me), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{CRLF * 2}")))
    capture = record(
        [("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", me), *common,
         ("WARC-Refers-To", F.when(revisit, urn("capture", F.col("first_id"), F.col("first_url"), F.col("digest")))),
         ("WARC-Profile", F.when(revisit, PROFILE)), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.when(revisit, http).otherwise(F.concat(http, F.col("html"))))
    metadata = record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", urn("metadata", F.col("id"), F.col("url"), F.col("digest"))), *common,
         ("WARC-Concurrent-To", me), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat_ws("", F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit(CRLF)), F.concat(F.lit("copies: "), F.col("copies").cast("string"), F.lit(CRLF))))
    (
        rows.select(F.explode(F.array(request, capture, metadata)).alias("value"))
        .write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).mode("overwrite").text(path)
    )


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the archive ends within a record")
        yield headers, block


def parsed(headers: dict[str, str], block: bytes) -> tuple:
    kind, head, payload, fields = headers.get("warc-type"), None, None, None
    if kind in ("response", "request", "revisit"):
        top, _, payload = block.partition(b"\r\n\r\n")
        head = top.decode("utf-8", "replace")
    elif kind == "metadata":
        lines = (x.partition(":") for x in block.decode("utf-8", "replace").splitlines() if ":" in x)
        fields = [(a.strip(), b.strip()) for a, _, b in lines]
    whole = payload if kind == "response" else None
    return (
        headers.get("warc-record-id"), kind, headers.get("warc-target-uri"), headers.get("warc-date"), headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"), headers.get("warc-payload-digest"), head, whole, None if whole is None else len(whole),
        None if whole is None else hashlib.sha1(whole).hexdigest(), fields,
    )


def read_archive(spark: SparkSession, path: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """A row per record of the archives below ``path``, gzipped by file or by record, or plain."""
    arrow = to_arrow_schema(schema_of(RECORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            for content in batch.column(0):
                raw = io.BytesIO(content.as_buffer())
                stream = gzip.GzipFile(fileobj=raw) if raw.getvalue()[:2] == b"\x1f\x8b" else raw
                rows, size = [], 0
                for headers, block in records(io.BufferedReader(stream, 1 << 16) if stream is not raw else raw):
                    rows.append(parsed(headers, block))
                    size += len(block)
                    if size > batch_bytes:
                        yield made(rows)
                        rows, size = [], 0
                if rows:
                    yield made(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def transactions(found: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, capture, request, metadata, referred (of a revisit)."""
    body = [c for c in found.columns if c not in ("record_id", "concurrent_to")]
    capture = found.where("record_type in ('response', 'revisit')").select("record_id", F.struct(*body).alias("capture"))

    def beside(kind: str) -> DataFrame:
        of = found.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        return of.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.min(F.struct("record_id", "target_uri", "warc_date", "http_head", F.map_entries("fields").alias("fields"))).alias(kind))

    return capture.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left")


def captures(found: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per archived page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    field = lambda name: F.get(F.filter("metadata.fields", lambda e: e["key"] == name), F.lit(0))["value"].cast("long")
    rows = stored(transactions(found).select(
        "record_id", field("page-id").alias("page_id"), F.coalesce(field("copies"), F.lit(1)).alias("copies"), "capture.record_type",
        F.col("capture.refers_to").alias("refers_id"), "capture.payload_bytes", "capture.payload_digest"), "warc-captures")
    answers = rows.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("of_page"), F.col("payload_bytes").alias("of_bytes"), F.col("payload_digest").alias("of_digest"))
    revisit = rows.where("record_type = 'revisit'").join(answers, "refers_id", "left").select(
        "page_id", "copies", F.col("of_bytes").alias("payload_bytes"), F.col("of_digest").alias("payload_digest"), "record_type", F.col("of_page").alias("refers_to"))
    response = rows.where("record_type = 'response'").select("page_id", "copies", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    out = response.union(revisit).select("*", F.posexplode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth", "_"))
    again = (F.col("nth") > 0) & (F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes)
    return out.select(
        "page_id", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise(F.col("record_type")).alias("record_type"),
        F.when(again, F.col("page_id")).otherwise(F.col("refers_to")).alias("refers_to"))

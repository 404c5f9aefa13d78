"""WARC archives: write a capture per page, read records back, assemble transactions."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.session import new_folder, stored

#: Payloads from this size on are written once; later equal ones become revisits.
MIN_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
RECORD = ("record_type string, record_id string, concurrent_to string, refers_to string, target_uri string, media_type string, "
          "fields map<string,string>, http_head string, payload binary, payload_bytes long, payload_digest string")


def _head(kind: str, record_id, media_type: str, block, *headers) -> Column:
    """A record's header and block. The record ends with two line breaks, which the writer puts between records."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">")),
             F.lit(f"WARC-Date: {DATE}"), *headers, F.lit(f"Content-Type: {media_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def capture_key(page: str, digest: str) -> Column:
    """What tells the captures of a page apart: its id (``none`` for null) and its payload."""
    return F.concat(F.coalesce(F.col(page).cast("string"), F.lit("none")), F.lit(":"), F.col(digest))


def record_id(capture, kind: str) -> Column:
    return F.concat(F.lit("urn:capture:"), capture.cast("string"), F.lit(f":{kind}"))


def first_captures(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``page_id, digest, first_id`` of each page whose payload of ``min_bytes`` or more equals that of a smaller id.

    A null id is larger than all others. The digest belongs to the key: one id may stand for several payloads.

    Only digests and ids are shuffled, and grouped by partial minima, so a payload that a third of the pages share
    is one row per task.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    sums = stored(pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("bytes")).where(
        F.col("bytes") >= min_bytes), "digests")
    first = sums.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    return sums.join(first, "digest").where(
        "first_id IS NOT NULL AND (page_id IS NULL OR page_id > first_id)").select("page_id", "digest", "first_id").distinct()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT) -> None:
    """Write a request, a response or revisit, and a metadata record per row of ``page_id, url, html``.

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads of ``min_bytes`` or more that with the
    smallest id is the response; the others refer to it and leave the payload out. Gzipped WARC 1.1 files,
    written by Spark's text writer, which puts the two line breaks after each record.
    """
    page = pages.select(F.col("page_id").alias("page"), F.col("url").alias("uri"), F.coalesce("html", F.lit("")).alias("body")).withColumn(
        "sum", F.sha2("body", 256))
    first = stored(first_captures(pages, min_bytes), "revisits")
    rows = page.join(first, page["page"].eqNullSafe(first["page_id"]) & (page["sum"] == first["digest"]), "left").withColumn(
        "capture", capture_key("page", "sum"))
    origin = capture_key("first_id", "sum")
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("sum"))
    # Control characters and spaces may not stand in a header; a null url leaves the header out.
    safe = F.regexp_replace("uri", r"[\x00-\x20\x7F]+", "%20")
    target = F.concat(F.lit("WARC-Target-URI: "), safe)
    capture = F.col("capture")
    beside = F.concat(F.lit("WARC-Concurrent-To: <"), record_id(capture, "response"), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
                    F.octet_length("body").cast("string"), F.lit(CRLF + CRLF))
    asked = F.concat(F.lit("GET "), F.coalesce(safe, F.lit("/")), F.lit(" HTTP/1.1" + CRLF + CRLF))
    noted = F.concat(F.lit("pageId: "), F.coalesce(F.col("page").cast("string"), F.lit("none")), F.lit(CRLF))
    request = _head("request", record_id(capture, "request"), "application/http;msgtype=request", asked, target, beside)
    response = _head("response", record_id(capture, "response"), "application/http;msgtype=response",
                     F.concat(http, F.col("body")), target, digest)
    revisit = _head("revisit", record_id(capture, "response"), "application/http;msgtype=response", http, target, digest,
                    F.lit(f"WARC-Profile: {PROFILE}"),
                    F.concat(F.lit("WARC-Refers-To: <"), record_id(origin, "response"), F.lit(">")))
    metadata = _head("metadata", record_id(capture, "metadata"), "application/warc-fields", noted, target, beside)
    answer = F.when(F.col("first_id").isNull(), response).otherwise(revisit)
    rows.select(F.explode(F.array(request, answer, metadata)).alias("value")).write.option("lineSep", CRLF + CRLF).option(
        "compression", "gzip").text(folder)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split(CRLF)
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if value}


def parse_records(content: bytes) -> Iterator[tuple]:
    """The records of a WARC file, gzipped or not, as tuples like ``RECORD``. Lengths are followed, never searched for."""
    source = gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    with source:
        while True:
            line = source.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            head = bytearray()
            while (line := source.readline()).strip():
                head += line
            fields = _headers(bytes(head))
            block = source.read(int(fields["content-length"]))
            bare = {key: re.sub(r"^<(.*)>$", r"\1", fields[key]) for key in fields}
            kind, http, payload, size = fields["warc-type"], None, block, len(block)
            if fields.get("content-type", "").startswith("application/http"):
                top, _, payload = block.partition(b"\r\n\r\n")
                http = top.decode("utf-8", "replace")
                size = len(payload)
                if kind == "revisit":
                    size, payload = int(_headers(top).get("content-length", 0)), None
            noted = fields.get("warc-payload-digest", "").removeprefix("sha256:")
            digest = noted if payload is None else hashlib.sha256(payload).hexdigest()
            if payload is not None and noted and noted != digest:
                raise ValueError(f"{fields['warc-record-id']} does not have its digest")
            yield (kind, bare["warc-record-id"], bare.get("warc-concurrent-to"), bare.get("warc-refers-to"),
                   fields.get("warc-target-uri"), fields.get("content-type"),
                   list((_headers(block) if fields.get("content-type") == "application/warc-fields" else {}).items()),
                   http, payload, size, digest)


KINDS = [pa.string()] * 6 + [pa.map_(pa.string(), pa.string()), pa.string(), pa.binary(), pa.int64(), pa.string()]
NAMES = ["record_type", "record_id", "concurrent_to", "refers_to", "target_uri", "media_type", "fields", "http_head", "payload",
         "payload_bytes", "payload_digest"]


def record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for row in parse_records(content.as_buffer().to_pybytes()):
                rows.append(row)
                size += row[9]
                if len(rows) >= 1_000 or size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), KINDS)], names=NAMES)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), KINDS)], names=NAMES)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the WARC files in a folder, one row each (see ``RECORD``). Digests are computed and compared.

    A file is read by one task, as gzip cannot be entered in the middle; archives come in files of a gigabyte at most.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("content").mapInArrow(record_batches, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, target_uri, request, response, metadata``.

    A response or revisit is the core; requests and metadata say by their concurrent-to id which one they belong to.
    Missing ones are null; of several the first by record id is taken. Ids are nearly unique, so no key is hot.
    What a query doesn't select of the nested rows isn't shuffled.
    """
    core = records.where(F.col("record_type").isin("response", "revisit"))

    def beside(kind: str) -> DataFrame:
        own = records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        return own.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min(F.struct("record_id", "media_type", "http_head", F.map_entries("fields").alias("fields"))).alias(kind))
    answer = F.struct("record_type", "record_id", "refers_to", "media_type", "http_head", "payload", "payload_bytes", "payload_digest")
    return core.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left").select(
        F.col("record_id").alias("capture_id"), "target_uri", "request", answer.alias("response"), "metadata")


def capture_number(identifier) -> Column:
    """The capture's own id in a record id made by :func:`record_id`."""
    return F.regexp_extract(identifier, r"^urn:capture:(-?\d+):", 1).try_cast("long")


def page_captures(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write archives of ``pages`` to a new shared folder, read them back, and return a row per page.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``; the page id is read from the metadata record. Other
    columns are ignored, urls may be null. An id may repeat: each of its payloads has its own records, and rows alike in id and
    payload are of one record id, a response each if theirs is the smallest id. A null id comes back as null and is
    larger than any other. An empty table gives none.
    """
    folder = new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, min_bytes)
    whole = transactions(read_records(pages.sparkSession, folder))
    noted = F.element_at(F.map_from_entries("metadata.fields"), "pageid").try_cast("long")
    return whole.select(
        noted.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.record_type").alias("record_type"),
        capture_number(F.col("response.refers_to")).alias("refers_to"))

"""Web archives: writing pages as WARC records and assembling captures from the records read back."""

from __future__ import annotations

import gzip
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuota.llm.common import ship, text_or_empty

# Records per archive file: three per page, some tens of megabytes before compression.
RECORDS_PER_FILE = 24_000
# Payloads of at least this many bytes are stored once; later equal ones become revisits.
REVISIT_BYTES = 1000
CAPTURED = "2024-01-01T00:00:00Z"

_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = ("record_id string, record_type string, concurrent_to string, target_uri string, captured string, "
           "header_digest string, profile string, http_bytes bigint, page string, refers_to string, payload binary")


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit("")) for name, value in fields])


def _one_line(column: str) -> Column:
    """A header value: line ends would end it, so they are percent-encoded."""
    return F.replace(F.replace(F.col(column).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(kind: Column, id: Column, block: Column, content: str, *more: tuple[str, Column]) -> Column:
    head = _lines(("WARC-Type", kind), ("WARC-Record-ID", id), ("WARC-Date", F.lit(CAPTURED)), *more,
                  ("Content-Type", F.lit(content)), ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit(f"WARC/1.1{_END}"), head, F.lit(_END), block)


def write_archives(pages: DataFrame, path: str, *, id: str = "page_id", url: str = "url", html: str = "html",
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write each page as a transaction of three records: request, response (or revisit) and metadata.

    The first and last name the second in WARC-Concurrent-To. Among pages with equal payloads of `REVISIT_BYTES` or more
    the one with the largest id holds the payload; the others are revisits of the identical-payload-digest profile, with
    the HTTP headers and the digest but no payload. Spark's text sink writes the gzipped files: a record is a line whose
    end is the blank lines that end a record, so any file system and any lost executor is dealt with by Spark.

    Null html is the empty payload; a null url leaves the field out; a null id is left out and never chosen over another.
    Rows that share the largest id and the payload are all responses. Repeated rows are written each. Other columns are
    not written. An empty table gives an archive without records.
    """
    named = pages.select(F.col(id).alias("_page"), _one_line(url).alias("_url"), text_or_empty(html).alias("_body"))
    digested = named.withColumn("_digest", F.sha1("_body")).withColumn("_bytes", F.octet_length("_body"))
    large = digested.where(F.col("_bytes") >= REVISIT_BYTES).groupBy(F.col("_digest").alias("_of")).agg(
        F.max_by(F.struct("_page", "_url"), "_page").alias("_kept"), F.count("*").alias("_n")).where("_n > 1")
    rows = digested.join(large, F.col("_digest") == F.col("_of"), "left")
    rows = rows.withColumn("_revisit", F.col("_of").isNotNull() & ~F.coalesce(
        F.col("_page").eqNullSafe(F.col("_kept._page")), F.lit(True)))
    ids = ["_request_id", "_response_id", "_metadata_id"]
    for name in ids:
        rows = rows.withColumn(name, F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")))
    revisit = F.col("_revisit")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}"), _lines(
        ("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("_bytes").cast("string"))), F.lit(_END))
    target = ("WARC-Target-URI", F.col("_url"))
    tied = ("WARC-Concurrent-To", F.col("_response_id"))
    request = _record(F.lit("request"), F.col("_request_id"), F.concat(F.lit("GET "), F.coalesce("_url", F.lit("/")),
                      F.lit(f" HTTP/1.1{_END}{_END}")), "application/http;msgtype=request", target, tied)
    answer = _record(F.when(revisit, "revisit").otherwise("response"), F.col("_response_id"),
                     F.when(revisit, http).otherwise(F.concat(http, F.col("_body"))), "application/http;msgtype=response",
                     target, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
                     ("WARC-Profile", F.when(revisit, _PROFILE)),
                     ("WARC-Refers-To-Target-URI", F.when(revisit, F.col("_kept._url"))))
    metadata = _record(F.lit("metadata"), F.col("_metadata_id"), _lines(
        ("page", F.col("_page").cast("string")),
        ("refers-to-page", F.when(revisit, F.col("_kept._page").cast("string")))), "application/warc-fields", target, tied)
    (rows.select(F.explode(F.array(request, answer, metadata)).alias("value")).write
     .option("lineSep", _END * 2).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(file):
    """(headers, block) of each record of an open archive. Field names are lower-cased."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers = _fields(file)
        yield headers, file.read(int(headers["content-length"]))


def _fields(file) -> dict[str, str]:
    found = {}
    while (line := file.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _row(headers: dict[str, str], block: bytes) -> tuple:
    kind, body, size, fields = headers.get("warc-type"), None, None, {}
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        http = _fields(io.BytesIO(head.partition(b"\r\n")[2]))
        size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
    elif kind == "metadata":
        fields = _fields(io.BytesIO(block))
    return (headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
            headers.get("warc-date"), headers.get("warc-payload-digest"), headers.get("warc-profile"), size,
            fields.get("page"), fields.get("refers-to-page"), body if kind == "response" else None)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the gzipped archives below `path`. A file is inflated record by record."""
    def parse(batches):
        kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
        names = [field.split()[0] for field in _RECORD.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, held = [], 0
                for headers, block in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))):
                    rows.append(_row(headers, block))
                    held += len(block)
                    if held > 1 << 23 or len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(parse, _RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: `response` (or revisit) with its `request` and `metadata`, joined by what these name in
    WARC-Concurrent-To.

    A response without request or metadata has nulls there; of several that name the same response the one with the
    smallest record id counts. Requests and metadata of no response give no row. Payload digests and sizes are taken
    from the payload where the record has one, else from the revisit's headers, before the joins, so that a payload is
    only shuffled if it is asked for.
    """
    digest = F.when(F.col("payload").isNotNull(), F.sha1("payload")).otherwise(
        F.lower(F.regexp_replace("header_digest", "^sha1:", "")))
    size = F.coalesce(F.octet_length("payload").cast("long"), F.col("http_bytes"))
    answers = records.where("record_type in ('response', 'revisit')").select(
        F.col("record_id").alias("_key"), "record_type", "target_uri", "captured", digest.alias("digest"),
        size.alias("bytes"), "profile", "payload")

    def side(kind: str, *fields: str) -> DataFrame:
        own = F.struct("record_id", *fields)
        return (records.where(F.col("record_type") == kind).where("concurrent_to is not null")
                .groupBy(F.col("concurrent_to").alias("_key")).agg(F.min(own).alias(kind)))

    joined = (answers.join(side("request", "target_uri"), "_key", "left")
              .join(side("metadata", "page", "refers_to"), "_key", "left"))
    return joined.select(F.struct(F.col("_key").alias("record_id"), "record_type", "target_uri", "captured", "digest",
                                  "bytes", "profile", "payload").alias("response"), "request", "metadata")

"""Web archives: writing captures as WARC records, reading them back, and
assembling the records of a transaction.

A capture is three records: the request and the metadata name the response (or
revisit) in WARC-Concurrent-To. Files are written by Spark's text writer: a
record is one value, and the blank lines that end it are the line separator, so
any file system that Spark writes to will do. A file is compressed as a whole;
reading also takes plain files and files compressed record by record.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm.common import with_rows
from wickwork.session import materialise, scratch_path

CRLF = "\r\n"
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
# A file is read by one task as a whole.
FILE_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_END = b"\r\n\r\n"

RECORD_SCHEMA = (
    "file string, offset long, warc_type string, record_id string, concurrent_to array<string>, "
    "target_uri string, date string, refers_to string, payload_digest string, "
    "payload_bytes long, body string, payload binary"
)


def _id(kind: str, key: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind), key))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], body: Column) -> Column:
    """A record without the separator that ends it; headers without a value are left out."""
    lines = [F.lit("WARC/1.1" + CRLF)]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    length = F.octet_length(body).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), length, F.lit(CRLF + CRLF), body)


def _line(value: Column) -> Column:
    """``value`` as one header line."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1F\x7F]", " ")


def captures(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(key, page, url, html, digest, n, first): one row for each page.

    ``first`` is the page whose record holds the payload: the largest page of
    those with an equal payload of at least REVISIT_BYTES. A group of equal
    payloads is one row where it is counted.
    """
    own = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = with_rows(own, "row").select(
        F.concat_ws("-", F.hex("row.file"), "row.at").alias("key"),
        "page",
        _line(F.col("url")).alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"),
        F.octet_length(html).cast("long").alias("n"),
    )
    order = F.struct(F.col("page").isNotNull().alias("known"), "page", "key")
    groups = (
        rows.where(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest", "n")
        .agg(F.max(order).alias("first"), F.count("*").alias("members"))
        .where("members > 1")
        .select("digest", "n", F.col("first.key").alias("first"), F.col("first.page").alias("first_page"))
    )
    return rows.join(groups, ["digest", "n"], "left")


def write_archives(pages: DataFrame, path: str, id_col="page_id", url_col="url", html_col="html") -> None:
    """Writes a request, a response or revisit, and a metadata record for each page.

    The page's id, if it has one, is kept in its metadata record.
    """
    rows = captures(pages, id_col, url_col, html_col)
    revisit = F.col("first").isNotNull() & (F.col("first") != F.col("key"))
    own = _id("response", F.col("key"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("n").cast("string"),
        F.lit(CRLF + CRLF),
    )
    response = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", own),
            ("WARC-Date", F.lit(DATE)),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.when(revisit, _id("response", F.col("first")))),
            ("WARC-Profile", F.when(revisit, PROFILE)),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html"))),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _id("request", F.col("key"))),
            ("WARC-Date", F.lit(DATE)),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Concurrent-To", own),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.regexp_replace("url", " ", "%20"), F.lit(f" HTTP/1.1{CRLF}{CRLF}")),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _id("metadata", F.col("key"))),
            ("WARC-Date", F.lit(DATE)),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Concurrent-To", own),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page").cast("string"), F.lit(CRLF)), F.lit("")),
    )
    # The three records of a capture are one value, so that they share a file.
    end = F.lit(CRLF + CRLF)
    value = F.concat(request, end, response, end, metadata)
    mean = pages.agg(F.avg(F.octet_length(html_col))).first()[0] or 0
    per_file = max(1, int(FILE_BYTES / (mean + 1500)))
    (
        rows.select(value.alias("value"))
        .write.option("lineSep", CRLF + CRLF)
        .option("maxRecordsPerFile", per_file)
        .option("compression", "gzip")
        .text(path)
    )


def _headers(block: bytes) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for line in block.split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found.setdefault(name.strip().lower(), []).append(value.strip())
    return found


def plain_bytes(content: bytes) -> bytes:
    return gzip.decompress(content) if content.startswith(b"\x1f\x8b") else content


def parse_records(content: bytes):
    """(offset, headers, body) of each record of an archive without its compression.

    Reading goes on by Content-Length. Where no record begins, the rest of the
    file is an error, not a silent end.
    """
    at = 0
    while at < len(content):
        end = content.find(HEADER_END, at)
        if not content.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        headers = _headers(content[at:end])
        body = end + 4
        stop = body + int(headers["content-length"][0])
        if stop > len(content):
            raise ValueError(f"the record at byte {at} is cut off")
        yield at, headers, content[body:stop]
        at = stop
        while content.startswith(b"\r\n", at):
            at += 2


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives in ``path``, as RECORD_SCHEMA.

    The payload of an HTTP message is what follows its header; length and digest
    are computed from it, for revisits the digest is the stated one. Payloads
    themselves are returned only if asked for.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parsed(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for at, head, body in parse_records(plain_bytes(content.as_py())):
                    one = lambda k, head=head: head.get(k, [None])[0]
                    kind, payload, digest = one("warc-type"), None, None
                    if kind in ("response", "revisit"):
                        payload = body[body.find(HEADER_END) + 4 :]
                        digest = hashlib.sha1(payload).hexdigest()
                        if kind == "revisit":
                            digest = (one("warc-payload-digest") or "").removeprefix("sha1:")
                    text = body.decode("utf-8", "replace") if kind in ("metadata", "request") else None
                    rows.append(
                        {
                            "file": name, "offset": at, "warc_type": kind, "record_id": one("warc-record-id"),
                            "concurrent_to": head.get("warc-concurrent-to", []), "target_uri": one("warc-target-uri"),
                            "date": one("warc-date"), "refers_to": one("warc-refers-to"), "payload_digest": digest,
                            "payload_bytes": None if payload is None else len(payload), "body": text,
                            "payload": payload if payloads else None,
                        }
                    )
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)

    return files.mapInArrow(parsed, RECORD_SCHEMA)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in RECORD_SCHEMA.split(", ")])


RECORD_ARROW = _arrow_schema()


def transactions(records: DataFrame) -> DataFrame:
    """One row for each capture: structs ``response``, ``request`` and ``metadata``.

    A request or metadata record belongs to the response or revisit with which
    it is concurrent, whichever of the two names the other; of several the one
    with the smallest id counts. Parts that are not there are null; requests and
    metadata without a capture are left out.
    """
    fields = ["record_id", *(c for c in records.columns if c not in ("record_id", "concurrent_to"))]
    capture = F.col("warc_type").isin("response", "revisit")
    heads = records.where(capture)
    rest = records.where(F.col("warc_type").isin("request", "metadata"))
    whole = heads.select(F.col("record_id").alias("capture"), F.struct(*fields).alias("response"))
    for kind in ("request", "metadata"):
        part = rest.where(F.col("warc_type") == kind)
        names = part.select(F.explode("concurrent_to").alias("capture"), F.struct(*fields).alias(kind))
        named = heads.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("record_id"))
        back = part.join(named, "record_id").select("capture", F.struct(*fields).alias(kind))
        own = names.union(back).groupBy("capture").agg(F.min(kind).alias(kind))
        whole = whole.join(own, "capture", "left")
    return whole


def resolve_revisits(found: DataFrame) -> DataFrame:
    """``found`` with the struct ``original``: the response that a revisit refers to,
    for a response itself, so that rows without a reference are not all one key."""
    originals = found.where(F.col("response.warc_type") == "response").select(
        F.col("capture").alias("refers"),
        F.struct(
            F.col("response.payload_bytes").alias("payload_bytes"), page_of(F.col("metadata.body")).alias("page")
        ).alias("original"),
    )
    refers = F.coalesce("response.refers_to", "capture")
    return found.withColumn("refers", refers).join(originals, "refers", "left").drop("refers")


def page_of(body: Column) -> Column:
    return F.regexp_extract(body, r"(?m)^page-id: (-?\d+)\s*$", 1).try_cast("long")


def archive_pages(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to), one row for every
    page, by writing archives to the shared folder and reading them back.

    Of equal payloads of at least 1000 bytes the one with the largest id is the
    response and the others, other rows with that id included, revisit it;
    missing ids come before all others. A missing html is an empty payload, a
    missing url an empty one. Ids are integers. Other columns are not read.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    records = materialise(read_records(spark, path, payloads=False), "warc-records")
    found = resolve_revisits(transactions(records))
    size = F.coalesce("original.payload_bytes", "response.payload_bytes")
    return found.select(
        page_of(F.col("metadata.body")).alias(id_col),
        size.alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"),
        F.when(F.col("response.warc_type") == "revisit", F.col("original.page")).alias("refers_to"),
    )

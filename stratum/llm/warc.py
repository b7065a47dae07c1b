"""Conversion of legacy ARC archives to WARC.

``write_arc`` stores pages as ARC files (version 1 or 2), ``convert`` parses
ARC files by their version-specific header lines and declared lengths and
writes the equivalent WARC files - identifiers, timestamps, record types and
digests are synthesised, since ARC has none - and ``read_warc`` reads WARC
files back, again by declared lengths.

Archives are written by Spark's text writer, whose line separator is the
format's record separator, and read with the ``binaryFile`` source, so they may
lie in any store that Spark reaches.  Every partition makes an archive: larger
inputs make more archives, not larger ones.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import read, shared_folder, written

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 100
CAPTURED = "20240101000000"
IP = "0.0.0.0"

# Fixed values of the formats.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

#: A header line by version: a url may hold spaces, a type its parameters.
ARC_LINES = {
    "1": re.compile(r"(.+?) (\S+) (\d{4,17}) ([^ ;]+(?:; ?[^ ;]+)*) (\d+)"),
    "2": re.compile(r"(.+?) (\S+) (\d{4,17}) ([^ ;]+(?:; ?[^ ;]+)*) (\S+) (\S+) (\S+) (\S+) (\S+) (\d+)"),
}
#: Kinds of WARC records that are captures; others describe files, requests or captures.
CAPTURES = frozenset(["response", "revisit", "resource"])

PARSED = "kind string, url string, captured string, content_type string, page_id bigint, head binary, payload binary"
READ_BACK = (
    "record_id string, record_type string, target_uri string, captured string, "
    "page_id bigint, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
)


def _header_url(col: str):
    """The url as one header field: no white space, never empty."""
    bare = F.regexp_replace(F.coalesce(F.col(col), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    return F.when(bare == "", F.lit("unknown:")).otherwise(bare)


def write_arc(pages: DataFrame, path: str, version: str = "1") -> None:
    """Store ``page_id, url, html`` as gzip-compressed ARC files of one version.

    A null html is an empty payload, a null or empty url is ``unknown:``, and
    a null page_id leaves out the header that carries it.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        _header_url("url").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    )
    identity = F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    content = F.concat(
        F.lit(HTTP_HEAD),
        F.lit("Content-Length: "),
        F.octet_length("html").cast("string"),
        F.lit("\r\n"),
        identity,
        F.lit("\r\n"),
        F.col("html"),
    )
    extra = F.lit("") if version == "1" else F.lit(" 200 - - 0 -")
    record = F.concat(
        F.col("url"),
        F.lit(f" {IP} {CAPTURED} text/html"),
        extra,
        F.lit(" "),
        F.octet_length(content).cast("string"),
        F.lit("\n"),
        content,
    )
    about = f"{version} 0 stratum\n{ARC_FIELDS[version]}\n"
    opening = f"filedesc://archive.arc {IP} {CAPTURED} text/plain{'' if version == '1' else ' 200 - - 0 -'} {len(about)}\n{about}"
    # The row number inside a partition is in the low bits: its first record opens the archive.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    rows.select(F.concat(F.when(first, F.lit(opening + "\n")).otherwise(F.lit("")), record).alias("value")).write.option(
        "lineSep", "\n"
    ).option("compression", "gzip").text(path)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")


def _opened(content: bytes) -> io.BufferedReader:
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)


def arc_files(stream) -> Iterator[tuple[list[str], list[str], bytes]]:
    """Field names, header fields and content of each record, the ``filedesc`` ones too.

    A ``filedesc`` record opens an archive and names the version, which fixes
    the fields of the header lines after it.  Lengths are the last field in
    both versions.
    """
    version = "1"
    while line := stream.readline():
        if not line.strip():
            continue
        header = line.decode("utf-8", "replace").rstrip("\r\n")
        fields = header.split(" ")
        if len(fields) < 5 or not fields[-1].isdigit():
            raise ValueError(f"not an ARC record header: {line[:200]!r}")
        content = stream.read(int(fields[-1]))
        if len(content) < int(fields[-1]):
            raise ValueError(f"archive ends inside the record of {fields[0][:200]}")
        if fields[0].startswith("filedesc:"):
            version = content.split(b" ", 1)[0].decode("utf-8", "replace")
            if version not in ARC_LINES:
                raise ValueError(f"ARC version {version[:20]!r} is not known")
            yield ARC_FIELDS["1"].split(), [*fields[:4], fields[-1]], content
            continue
        found = ARC_LINES[version].fullmatch(header)
        if not found:
            raise ValueError(f"not a header of ARC version {version}: {line[:200]!r}")
        yield ARC_FIELDS[version].split(), list(found.groups()), content


def arc_records(stream) -> Iterator[tuple[list[str], list[str], bytes]]:
    """``arc_files`` without the records that only open an archive."""
    return (r for r in arc_files(stream) if not r[1][0].startswith("filedesc:"))


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Header with its blank line, and payload, of an HTTP message; without a blank line all is header."""
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[: end.end()], block[end.end() :]) if end else (block, b"")


def http_fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; lines that are none are passed over."""
    lines = (x.partition(b":") for x in head.splitlines()[1:])
    return {k.decode("utf-8", "replace").strip().lower(): v.decode("utf-8", "replace").strip() for k, colon, v in lines if colon}


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d{1,18}|-?[1-8]\d{18}", text) else None


def parse_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files below ``path``.

    HTTP messages are responses, cut into header and payload.  Whatever else
    was captured (``dns:``, ``ftp:``) is a resource, all payload, and the
    record that opens an archive is its warcinfo.
    """

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for names, fields, body in arc_files(_opened(content.as_py())):
                    of = dict(zip(names, fields, strict=True))
                    url = re.sub(r"[\x00-\x20\x7f]", "%20", of["URL"])
                    head, payload, kind = b"", body, "resource"
                    if url.startswith("filedesc:"):
                        kind = "warcinfo"
                    elif body.startswith(b"HTTP/"):
                        (head, payload), kind = http_parts(body), "response"
                    page = _number(http_fields(head).get("x-page-id"))
                    rows.append((kind, url, of["Archive-date"], of["Content-type"], page, head, payload))
                    held += len(payload)
                    if held > 8_000_000:
                        yield _batch(rows, PARSED_ARROW)
                        rows, held = [], 0
                yield _batch(rows, PARSED_ARROW)

    return _archives(spark, path).mapInArrow(parse, PARSED)


PARSED_ARROW = pa.schema(
    [("kind", pa.string()), ("url", pa.string()), ("captured", pa.string()), ("content_type", pa.string())]
    + [("page_id", pa.int64()), ("head", pa.binary()), ("payload", pa.binary())]
)
READ_ARROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("captured", pa.string())]
    + [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    + [("payload", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _uuid_urn(*cols):
    """A record id that depends on the record alone, so a retried task writes the same."""
    h = F.md5(F.concat_ws("\n", *cols))
    return F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
        F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"),
    )


def _stamp(col: str):
    """An ARC date as a WARC one; what a shorter date leaves out is its first month, day or second."""
    at = F.concat(F.col(col), F.substr(F.lit("00000101000000"), F.length(col) + 1))
    part = lambda start, n: F.substring(at, start, n)
    date = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2))
    return F.concat(date, F.lit("T"), F.concat_ws(":", part(9, 2), part(11, 2), part(13, 2)), F.lit("Z"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write the ARC records below ``arc_path`` as WARC files.

    Of records with equal payloads of at least ``revisit_bytes`` bytes the one
    with the smallest page_id is a response and the others are revisits of it;
    repeats of that very page_id, records without a page_id and smaller ones
    are responses.  Captures that are no HTTP messages become resources, the
    records that open an archive warcinfo.  The map of first pages has one row
    a repeated payload and is found from digests alone, which are written once;
    payloads are shuffled once, by page.
    """
    records = parse_arc(spark, arc_path)
    digest = F.sha2("payload", 256)
    responses = records.filter("kind = 'response' AND page_id IS NOT NULL")
    digests = written(
        responses.select("page_id", "url", "captured", digest.alias("digest"), F.octet_length("payload").alias("n")).filter(
            F.col("n") >= revisit_bytes
        ),
        "digests",
    )
    firsts = (
        digests.groupBy("digest")
        .agg(F.min(F.struct("page_id", "url", "captured")).alias("first"), F.max("page_id").alias("last"))
        .filter(F.col("last") > F.col("first.page_id"))
        .select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("first_url"), F.col("first.captured").alias("first_at"))
    )
    # Explicitly by page: a payload that a third of the pages share is no hot key.
    seen = digests.select("page_id", "digest").join(firsts, "digest").filter(F.col("page_id") > F.col("refers_to")).distinct()
    full = records.withColumn("digest", digest).withColumnRenamed("page_id", "page")
    joined = full.join(
        seen.withColumnsRenamed({"digest": "same", "page_id": "later"}),
        (F.col("page") == F.col("later")) & (F.col("digest") == F.col("same")),
        "left",
    )
    revisit = F.col("refers_to").isNotNull()
    page = F.coalesce(F.col("page").cast("string"), F.lit("-"))
    block = F.concat(F.col("head").cast("string"), F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.col("kind"))),
        line("WARC-Record-ID", _uuid_urn(F.col("url"), F.col("captured"), page, F.col("digest"))),
        line("WARC-Date", _stamp("captured")),
        F.when(F.col("kind") == "warcinfo", F.lit("")).otherwise(line("WARC-Target-URI", F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"),
                line("WARC-Refers-To", _uuid_urn(F.col("first_url"), F.col("first_at"), F.col("refers_to").cast("string"), F.col("digest"))),
                line("WARC-Refers-To-Target-URI", F.col("first_url")),
                line("WARC-Refers-To-Date", _stamp("first_at")),
                line("X-Refers-To-Page-Id", F.col("refers_to").cast("string")),
                line("X-Payload-Bytes", F.octet_length("payload").cast("string")),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.when(F.col("kind") == "response", F.lit("application/http; msgtype=response")).otherwise(F.col("content_type"))),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    joined.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path)


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, by declared lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("archive ends inside a record")
        yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files below ``path``.

    Only captures have rows: responses, revisits and resources.  A record's
    size and digest are taken from the bytes that were read and must agree with
    its digest header, if that is a SHA-256; a revisit states both in its
    headers, or they are null.  ``payload`` is null for revisits.
    """

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in warc_records(_opened(content.as_py())):
                    kind = headers["warc-type"]
                    if kind not in CAPTURES:
                        continue
                    is_http = headers.get("content-type", "").startswith("application/http") or kind == "revisit"
                    head, payload = http_parts(block) if is_http else (b"", block)
                    http = http_fields(head)
                    page = _number(http.get("x-page-id"))
                    declared = re.fullmatch(r"sha-?256:([0-9a-f]{64})", headers.get("warc-payload-digest", "").lower())
                    if kind == "revisit":
                        n, payload = _number(headers.get("x-payload-bytes", http.get("content-length"))), None
                        digest = declared and declared[1]
                    else:
                        n, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        if declared and digest != declared[1]:
                            raise ValueError(f"payload of {headers.get('warc-record-id')} is not what its digest says")
                    to = headers.get("x-refers-to-page-id")
                    rows.append(
                        (headers.get("warc-record-id"), kind, headers.get("warc-target-uri"), headers.get("warc-date"))
                        + (page, n, digest, _number(to), payload)
                    )
                    held += len(payload or b"")
                    if held > 8_000_000:
                        yield _batch(rows, READ_ARROW)
                        rows, held = [], 0
                yield _batch(rows, READ_ARROW)

    return _archives(spark, path).mapInArrow(parse, READ_BACK)


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all pages through ARC archives into WARC archives and back."""
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    folder = shared_folder(spark, "archives")
    write_arc(pages, f"{folder}/arc", "2")
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    return read_warc(spark, f"{folder}/warc").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def warc_sql() -> str:
    return f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
firsts AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN firsts USING (d)"""

"""Web archive derivatives: linked metadata and plain-text conversion records.

A response record becomes two derivatives. ``metadata`` carries the source's headers and
measurements as ``name: value`` lines; ``conversion`` carries the page's plain text.
Both name the response in WARC-Refers-To (with its URI and date) and carry block digests;
the payload digest of the response is kept. Everything is one row-wise projection, so the
job has no shuffle; digests are in lower-case hex, labelled ``sha256:`` or ``sha1:``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Comments and the elements whose content is never text.
#: One that never closes hides the rest of the page.
HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script\s*>|\z)|style\b.*?(?:</style\s*>|\z)|noscript\b.*?(?:</noscript\s*>|\z)|template\b.*?(?:</template\s*>|\z)|svg\b.*?(?:</svg\s*>|\z))"
BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
BREAK = r"(?i)</?(p|div|h[1-6]|li|ul|ol|tr|table|br|hr|section|article|header|footer|nav|main|aside|blockquote|pre|title|form|dl|dt|dd)\b[^>]*>"
TAG = r"(?s)<[A-Za-z/!?][^>]*>"
#: Named character references that are decoded; the ampersand comes last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def plain_text(html: Column) -> Column:
    """Text of a page: hidden elements and comments go, block tags end a line.

    Runs of blanks become one space, empty lines go. Null gives the empty text.
    """
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    text = F.regexp_replace(text, BLANKS, " ")
    text = F.regexp_replace(F.regexp_replace(text, BREAK, "\n"), TAG, "")
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    text = F.regexp_replace(text, r" *\n[ \n]*", "\n")
    return F.btrim(F.regexp_replace(text, r"  +", " "), F.lit(" \n"))


def _digest(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(value.cast("binary"), 256))


def _record_id(*parts: Column) -> Column:
    """A name-based identifier: the same record gets the same id in every run."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def responses(
    pages: DataFrame, date: Column | str = "2024-01-01T00:00:00Z", status: Column | str = "200 OK"
) -> DataFrame:
    """Response records of crawled pages (page_id, url, html): headers, payload and digests.

    A null url gives an empty target, null html an empty payload. ``date`` and ``status`` are
    columns of the capture time and the HTTP status, or what stands for them in a table without.
    Other columns are ignored; repeated pages give repeated records.
    """
    date, status = (F.lit(x) if isinstance(x, str) else x for x in (date, status))
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    return pages.select(
        "page_id",
        _record_id(F.lit("response"), F.col("page_id").cast("string"), url).alias("record_id"),
        url.alias("target_uri"),
        date.alias("date"),
        F.concat(F.lit("HTTP/1.1 "), status).alias("status_line"),
        F.concat(
            F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
            F.octet_length(html).cast("string"),
        ).alias("http_headers"),
        html.alias("payload"),
        _digest(html).alias("payload_digest"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response record.

    Columns: page_id, record_type, record_id, refers_to, refers_to_target_uri, date,
    content_type, content_length, block, block_digest, source_payload_digest,
    concurrent_to. Repeated responses give repeated derivatives.
    """
    text = plain_text(F.col("payload"))
    records = records.withColumn("_text", text)
    meta = F.concat(
        F.lit("sourceStatus: "), "status_line", F.lit(CRLF),
        F.regexp_replace(F.concat(F.lit("source"), F.regexp_replace("http_headers", CRLF, f"{CRLF}source")), "source([A-Za-z])", "source-$1"), F.lit(CRLF),
        F.lit("sourcePayloadDigest: "), "payload_digest", F.lit(CRLF),
        F.lit("conversionCharacters: "), F.length("_text").cast("string"), F.lit(CRLF),
    )
    both = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("mime"), meta.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain; charset=utf-8").alias("mime"), F.col("_text").alias("block")),
    )
    rows = records.select("page_id", "record_id", "target_uri", "date", "payload_digest", F.explode(both).alias("d"))
    other = F.when(F.col("d.kind") == "metadata", "conversion").otherwise("metadata")
    return rows.select(
        "page_id",
        F.col("d.kind").alias("record_type"),
        _record_id(F.col("d.kind"), "record_id").alias("record_id"),
        F.col("record_id").alias("refers_to"),
        F.col("target_uri").alias("refers_to_target_uri"),
        "date",
        F.col("d.mime").alias("content_type"),
        F.octet_length("d.block").cast("long").alias("content_length"),
        F.col("d.block").alias("block"),
        _digest(F.col("d.block")).alias("block_digest"),
        F.col("payload_digest").alias("source_payload_digest"),
        _record_id(other, "record_id").alias("concurrent_to"),
    )


def record_text(rows: DataFrame) -> DataFrame:
    """One column ``value`` with each derivative as a serialised record, but for the last line end."""
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Date: "), "date"),
        F.concat(F.lit("WARC-Target-URI: "), "refers_to_target_uri"),
        F.concat(F.lit("WARC-Refers-To: "), "refers_to"),
        F.concat(F.lit("WARC-Refers-To-Target-URI: "), "refers_to_target_uri"),
        F.concat(F.lit("WARC-Refers-To-Date: "), "date"),
        F.concat(F.lit("WARC-Concurrent-To: "), "concurrent_to"),
        F.concat(F.lit("WARC-Block-Digest: "), "block_digest"),
        F.concat(F.lit("Content-Type: "), "content_type"),
        F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string")),
    )
    return rows.select(F.concat(head, F.lit(CRLF * 2), "block", F.lit(CRLF)).alias("value"))


def write_warc(rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write derivatives as archive files, one for each task."""
    record_text(rows).write.option("lineSep", CRLF).option("compression", compression).mode("errorifexists").text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    while (begin := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", begin)
        if end < 0:
            return
        lines = data[begin:end].decode("utf-8", "replace").split(CRLF)[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers.get("content-length", "0") or 0)
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archive files below ``path``: type, id, uri, refers_to and block.

    A file is one row, so files should have the usual size of about 1 GB at most.
    """
    import gzip

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["path"], frame["content"]):
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else bytes(data)
                names = ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-block-digest")
                found = [(name, *(h.get(x) for x in names), b) for h, b in parse_records(data)]
                yield pd.DataFrame(found, columns=["file", "record_type", "record_id", "target_uri", "refers_to", "block_digest", "block"])

    schema = "file string, record_type string, record_id string, target_uri string, refers_to string, block_digest string, block binary"
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, schema)

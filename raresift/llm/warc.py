"""WARC derivatives: metadata and plain-text conversion records of response records.

Everything is column expressions: a derivative needs only its own response,
so there is no shuffle.  Record ids are derived from their content, so a task
that runs again gives the same ids, and a conversion and its metadata name
the response (and each other) without a lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Capture time of pages that come without one.
DATE = "2024-01-01T00:00:00Z"
HTML_TYPE = "text/html; charset=utf-8"

# The elements that break a line of text, and the entities decoded.
BLOCK_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

#: (pattern, replacement) in order; then the ends are trimmed.
HIDDEN = [r"(?s)<!--.*?-->", r"(?is)<script[^>]*>.*?</script[^>]*>", r"(?is)<style[^>]*>.*?</style[^>]*>"]
TEXT_RULES = [
    *[(pattern, "") for pattern in HIDDEN],
    (rf"(?i)</?(?:{BLOCK_TAGS})(?:[\s/][^>]*)?>", "\n"),
    (r"<[^>]*>", ""),
]
SPACE_RULES = [(r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n")]


def plain_text(html: Column) -> Column:
    """The visible text: blocks on lines of their own, other tags gone, entities decoded, space collapsed."""
    for pattern, to in TEXT_RULES:
        html = F.regexp_replace(html, pattern, to)
    for entity, char in ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(char))
    for pattern, to in SPACE_RULES:
        html = F.regexp_replace(html, pattern, to)
    return F.trim(html, F.lit(" \n"))


def record_id(*parts: Column) -> Column:
    """A urn:uuid made of the hash of the parts."""
    mark = F.sha2(F.concat_ws("\n", *parts), 256)
    cuts = [F.substring(mark, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses_of_pages(pages: DataFrame) -> DataFrame:
    """Response records of raw pages (page_id, url, html): one per row.

    A null html is an empty payload; a null url stays null, and the records
    have no target line.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: {HTML_TYPE}\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n")
    )
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("target_uri"),
        html.alias("payload"),
        headers.alias("http_headers"),
    )
    return rows.select(
        "page_id",
        record_id(
            F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("target_uri", F.lit("")), F.col("payload")
        ).alias("record_id"),
        "target_uri",
        F.lit(DATE).alias("warc_date"),
        "http_headers",
        "payload",
    )


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records for each response: metadata and conversion.

    Columns: page_id, warc_type, record_id, refers_to, target_uri, warc_date,
    content_type, content_length, block_digest, source_digest, block.
    ``refers_to`` is the response's id, ``source_digest`` the digest of its
    payload.  The metadata block holds warc-fields: the response's HTTP
    headers, payload digest and length, title, language and outlinks, and the
    id of the conversion.  Repeated rows give repeated records with equal
    ids; columns beyond the six of a response are left out.
    """
    html = F.col("payload")
    found = responses.select(
        "page_id", "target_uri", "warc_date", "http_headers", F.col("record_id").alias("refers_to"),
        digest(html).alias("source_digest"),
        F.octet_length(html).cast("string").alias("source_length"),
        F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)</title", 1)).alias("title"),
        F.regexp_extract(html, r'(?i)<html[^>]*\slang="([^"]*)"', 1).alias("language"),
        F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1)).alias("links"),
        plain_text(html).alias("text"),
    )
    found = found.withColumn("conversion_id", record_id(F.lit("conversion"), F.col("refers_to")))
    fields = F.concat(
        F.lit("source-payload-digest: "), F.col("source_digest"),
        F.lit("\r\nsource-payload-length: "), F.col("source_length"),
        F.lit("\r\nconversion: "), F.col("conversion_id"),
        F.lit("\r\ntitle: "), F.col("title"),
        F.lit("\r\nlanguage: "), F.col("language"),
        F.lit("\r\n"), F.regexp_replace("http_headers", r"([^\r\n]+)", "source-header: $1"),
        F.concat_ws("", F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n")))),
    )
    found = found.withColumn("fields", fields)

    def record(kind: str, content_type: str, own_id: Column, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("warc_type"), own_id.alias("record_id"), F.lit(content_type).alias("content_type"),
            F.octet_length(block).cast("long").alias("content_length"), digest(block).alias("block_digest"), block.alias("block"),
        )

    both = F.array(
        record("metadata", "application/warc-fields", record_id(F.lit("metadata"), F.col("refers_to")), F.col("fields")),
        record("conversion", "text/plain", F.col("conversion_id"), F.col("text")),
    )
    out = found.select("page_id", "refers_to", "target_uri", "warc_date", "source_digest", F.explode(both).alias("r"))
    return out.select(
        "page_id", "r.warc_type", "r.record_id", "refers_to", "target_uri", "warc_date", "r.content_type", "r.content_length",
        "r.block_digest", "source_digest", "r.block",
    )


def serialized(records: DataFrame) -> Column:
    """A record as it stands in a WARC file, as one string."""
    target = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri"), F.lit("\r\n")), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("warc_type"),
        F.lit("\r\nWARC-Record-ID: "), F.col("record_id"),
        F.lit("\r\nWARC-Refers-To: "), F.col("refers_to"),
        F.lit("\r\n"), target,
        F.lit("WARC-Date: "), F.col("warc_date"),
        F.lit("\r\nWARC-Block-Digest: "), F.col("block_digest"),
        F.lit("\r\nContent-Type: "), F.col("content_type"),
        F.lit("\r\nContent-Length: "), F.col("content_length").cast("string"),
        F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r\n"),
    )


def write_warc(records: DataFrame, folder: str) -> None:
    """Write records as gzip-compressed WARC files, one a partition, in the folder."""
    # the two line ends after a record are the writer's separator
    whole = F.regexp_replace(serialized(records), r"\r\n\r\n\z", "")
    records.select(whole.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)

"""Content-addressed WARC archive: payload bytes once per digest, exact record headers apart, records by joins.

DataFrame functions only; the archive is two Parquet tables in a folder all executors share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 100
CRLF = "\r\n"


def records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One record per page row: page_id, url, payload, digest, record_type, refers_to.

    Columns page_id, url, html are read; others are ignored. The payload is the html in UTF-8
    (null: empty). Of rows with one payload of at least ``min_revisit_bytes`` those of the smallest
    page_id are responses (a repeated row is the same response again), the others revisits that
    refer to it; a null id is larger than any other. Shorter payloads are all responses. The
    smallest id of a digest is a partially aggregated minimum joined back, so one payload with a
    third of all rows is no group of its own.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("_first"))
        .withColumnRenamed("digest", "_digest")
    )
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    narrow = rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    return narrow.join(first, narrow.digest == first["_digest"], "left").select(
        "page_id",
        "url",
        "digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    )


def _id(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("none")), F.lit(">"))


def header() -> Column:
    """The exact header block of a record. Control characters and spaces of a URI are percent-encoded; a null URI has no line."""
    uri = F.regexp_replace("url", r"%", "%25")
    for code in (*range(0x00, 0x21), 0x7F):
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    has_controls = F.col("url").rlike(r"[\x00-\x20\x7F]")
    uri = F.when(has_controls, uri).otherwise(F.col("url"))
    revisit = F.col("record_type") == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _id("page_id")),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, line("WARC-Refers-To", _id("refers_to"))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Writes ``path``/payloads (digest, payload: once per digest) and ``path``/headers (digest, header: one per page row)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    stored = pages.select(payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    stored.dropDuplicates(["digest"]).select("digest", "payload").write.parquet(f"{path}/payloads")
    records(pages, min_revisit_bytes).select("digest", header().alias("header")).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive with what their headers say: page_id, url, record_type, refers_to, payload_digest,
    content_length, header, and the payload's digest and length as computed from the stored bytes.

    Fails on a payload whose bytes do not have the digest it is stored under, and on a header
    whose payload is missing.
    """
    headers = spark.read.parquet(f"{path}/headers")
    field = lambda name: F.regexp_extract("header", rf"\n{name}: ([^\r\n]*)", 1)
    number = lambda text: F.nullif(F.regexp_extract(text, r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")
    return headers.join(_verified(spark, path), "digest", "left").select(
        number(field("WARC-Record-ID")).alias("page_id"),
        F.nullif(field("WARC-Target-URI"), F.lit("")).alias("url"),
        field("WARC-Type").alias("record_type"),
        number(field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"^sha256:([0-9a-f]{64})$", 1).alias("payload_digest"),
        field("Content-Length").cast("long").alias("content_length"),
        F.coalesce("payload_bytes", F.raise_error(F.lit("a payload is missing"))).alias("payload_bytes"),
        "header",
        "digest",
    )


def _verified(spark: SparkSession, path: str) -> DataFrame:
    bad = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    stored = spark.read.parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.octet_length("payload").cast("long")).otherwise(bad.cast("long"))
    return stored.select("digest", checked.alias("payload_bytes"))


def record_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The original records: page_id, record (header block, payload of a response, two line ends), html (the full payload)."""
    stored = spark.read.parquet(f"{path}/payloads")
    parts = read_archive(spark, path).join(stored, "digest")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    end = F.lit((CRLF * 2).encode())
    return parts.select(
        "page_id", "url", "record_type", F.concat(F.col("header").cast("binary"), body, end).alias("record"), F.col("payload").cast("string").alias("html")
    )

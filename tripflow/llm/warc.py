"""A content-addressed web archive.

Payload bytes are stored once under their SHA-256, which is verified when they are read.
The exact header block of every record is stored on its own, and a record is
rebuilt by joining the two by digest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import column_or_null, shared_dir

#: Smaller payloads are always stored as responses of their own.
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"

HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: The base32 alphabet of RFC 4648.
RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Archive:
    """Where the two tables of an archive are."""

    headers: str
    payloads: str


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 hex digits, five of them to four base32 digits."""
    digest = F.sha1(data)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.upper(F.concat(*groups)), HEX32, RFC4648)


def warc_headers(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(header, sha256): the exact header block of one record per page.

    Of the pages with one payload of ``min_bytes`` or more, that with the smallest page_id
    (NULL last, then by url) is a response and the others are revisits of it.
    """
    # Repeated rows are counted and numbered, so that only one of them is the response.
    rows = pages.groupBy("page_id", "url", "sha256", "digest", "bytes").agg(F.count("*").alias("_n"))
    order = F.struct(
        F.col("page_id").isNull(), F.col("page_id"), F.col("url").isNull(), F.col("url")
    )
    first = rows.groupBy("sha256").agg(F.min(order).alias("_first"))
    placed = (
        rows.join(first, "sha256")
        .withColumn("_again", order != F.col("_first"))
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy"))
    )
    revisit = (F.col("bytes") >= min_bytes) & (F.col("_again") | (F.col("_copy") > 1))

    def urn(page_id: Column, copy: Column) -> Column:
        return F.concat(
            F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), copy.cast("string"), F.lit(">")
        )

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"), F.col("_copy"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", urn(F.col("_first.page_id"), F.lit(1))),
            ),
        ).otherwise(line("Content-Type", F.lit("text/html; charset=utf-8"))),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    return placed.select(header.alias("header"), "sha256")


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> Archive:
    """Write one WARC record per row of (page_id, url, html) below ``path``.

    NULL html is an empty payload and shares one digest with empty html; NULL ids and
    urls are written as ``none`` and nothing. An empty table makes an empty
    archive; other columns are not archived.
    """
    archive = Archive(f"{path}/headers", f"{path}/payloads")
    payload = F.encode(F.coalesce(column_or_null(pages, "html", "string"), F.lit("")), "UTF-8")
    data = pages.select(
        column_or_null(pages, "page_id", "long").alias("page_id"),
        column_or_null(pages, "url", "string").alias("url"),
        payload.alias("payload"),
    )
    stored = data.select(F.sha2("payload", 256).alias("sha256"), "payload")
    stored.dropDuplicates(["sha256"]).write.option("compression", "zstd").parquet(archive.payloads)
    described = data.select(
        "page_id",
        "url",
        F.sha2("payload", 256).alias("sha256"),
        sha1_base32(F.col("payload")).alias("digest"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    warc_headers(described, min_bytes).write.option("compression", "zstd").parquet(archive.headers)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """One row per record: its fields as read from the header, the stored payload, and the record's bytes.

    A stored payload whose bytes do not have the digest they are stored under, and a
    header whose payload is not stored, raise an error. ``record`` is the record as it
    stands in a WARC file; a revisit's block is empty.
    """
    headers = spark.read.schema("header string, sha256 string").parquet(archive.headers)
    payloads = spark.read.schema("sha256 string, payload binary").parquet(archive.payloads)
    verified = F.when(F.sha2("payload", 256) == F.col("sha256"), F.octet_length("payload").cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not have the digest "), F.col("sha256"))).cast("long")
    )
    payloads = payloads.select(
        "sha256", "payload", verified.alias("payload_bytes"), sha1_base32(F.col("payload")).alias("payload_digest")
    )

    def field(name: str, pattern: str) -> Column:
        found = F.regexp_extract("header", rf"\r\n{name}: {pattern}\r\n", 1)
        return F.when(found != "", found)

    kind = field("WARC-Type", r"(\w+)")
    joined = headers.join(payloads, "sha256", "left")
    claimed = field("WARC-Payload-Digest", r"sha1:(\w+)")
    record = F.concat(
        F.encode("header", "UTF-8"),
        F.when(kind == "revisit", F.unhex(F.lit(""))).otherwise(F.col("payload")),
        F.encode(F.lit("\r\n\r\n"), "UTF-8"),
    )
    return joined.select(
        F.when(field("WARC-Record-ID", r"<urn:page:(none|-?\d+):\d+>") != "none", field("WARC-Record-ID", r"<urn:page:(none|-?\d+):\d+>"))
        .cast("long")
        .alias("page_id"),
        field("WARC-Target-URI", r"([^\r\n]*)").alias("url"),
        "payload_bytes",
        F.when(claimed == F.col("payload_digest"), F.col("payload_digest"))
        .otherwise(F.raise_error(F.concat(F.lit("no payload for "), F.col("header"))).cast("string"))
        .alias("payload_digest"),
        kind.alias("record_type"),
        F.when(
            field("WARC-Refers-To", r"<urn:page:(none|-?\d+):\d+>") != "none",
            field("WARC-Refers-To", r"<urn:page:(none|-?\d+):\d+>"),
        )
        .cast("long")
        .alias("refers_to"),
        "payload",
        record.alias("record"),
    )


def archive_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tripflow/{name}"

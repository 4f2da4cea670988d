"""Content-addressed WARC archive: payloads once, record headers apart, records by a join.

``write_archive`` turns captures into WARC/1.1 records. The payload bytes go into a table keyed
by their SHA-256, each distinct payload once; the exact header bytes of every record go into a
second table with the digest they point to. ``read_archive`` rebuilds each record's bytes
(header, payload, end of record) by a join on the digest, and checks the stored payload against
the digest and length that its record states, so that a damaged payload fails the read instead of passing on.
``parse_records`` reads the fields back out of record bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_BYTES = 100
_EOL = "\r\n"
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column, payload_digest: Column, url: Column) -> Column:
    """A UUID-shaped id that is the same whenever the same capture is written."""
    h = F.sha2(F.concat_ws("\n", page_id.cast("string"), payload_digest, url), 256)
    return F.concat(
        F.lit("<urn:uuid:"), *[F.concat(F.substring(h, a, n), F.lit(end)) for a, n, end in ((1, 8, "-"), (9, 4, "-"), (13, 4, "-"), (17, 4, "-"), (21, 12, ">"))]
    )


def _one_line(value: Column) -> Column:
    """A header value can't hold line ends; they are percent-encoded."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def captures(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One row per page with its payload's digest and the record that stores it.

    Of the pages with one payload of at least ``min_bytes`` the smallest page_id is the response
    and the others revisit it; rows that repeat that page_id and payload are responses too. A null page_id
    comes after all others; without any other it is the response. Null html is an empty payload.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select(
        "page_id", "url", F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes")
    )
    # folded before the shuffle: a payload that a third of the pages share is one row per task
    firsts = (
        keyed.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"))
    )
    joined = keyed.join(firsts, F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        "page_id",
        "url",
        "payload_digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    )


def record_header(record: DataFrame) -> Column:
    """The header bytes of a record up to and with the empty line."""
    revisit = F.col("record_type") == "revisit"
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("payload_digest"), F.col("url"))),
        F.concat(F.lit("WARC-Date: "), F.lit(_DATE)),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Source-Page: "), page),
        F.when(revisit, F.concat(F.lit("WARC-Profile: "), F.lit(_PROFILE))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Page: "), F.col("refers_to").cast("string"))),
        F.when(revisit, F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    # concat_ws leaves out the null lines
    return F.encode(F.concat(F.concat_ws(_EOL, *lines), F.lit(_EOL + _EOL)), "UTF-8")


def write_archive(pages: DataFrame, path: str, min_bytes: int = REVISIT_BYTES) -> None:
    """Writes ``path/payloads`` (digest, payload) and ``path/headers`` (header, digest)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    stored = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    stored.dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{path}/payloads")
    records = captures(pages, min_bytes)
    records.select(record_header(records).alias("header"), F.col("payload_digest").alias("digest")).write.option(
        "compression", "zstd"
    ).parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload): every record of the archive; a record whose payload is missing or does not match raises.

    ``payload`` is the full payload, for revisit records that of the record they refer to.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").withColumnRenamed("digest", "_digest")
    verified = payloads.withColumn("_verified", F.sha2("payload", 256) == F.col("_digest"))
    joined = headers.join(verified, F.col("digest") == F.col("_digest"), "left")
    checked = F.when(F.col("_verified"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.col("digest"))).cast("binary")
    )
    return joined.select("header", checked.alias("payload"))


def record_bytes(header: Column, payload: Column) -> Column:
    """The bytes of the record as they stand in a WARC file; a revisit record has an empty block."""
    revisit = F.contains(header.cast("string"), F.lit("\r\nWARC-Type: revisit\r\n"))
    end = F.encode(F.lit(_EOL + _EOL), "UTF-8")
    return F.when(revisit, F.concat(header, end)).otherwise(F.concat(header, payload, end))


def parse_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record_bytes, record_sha256) of (header, payload).

    All but the last two come from the header text; the length and digest are compared with the payload.
    """
    header = F.decode("header", "UTF-8")
    field = lambda name: F.nullif(F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))
    length = F.coalesce(field("WARC-Payload-Length"), field("Content-Length")).cast("long")
    whole = record_bytes(F.col("header"), F.col("payload"))
    checked = F.when(length == F.octet_length("payload"), length).otherwise(F.raise_error(F.lit("payload length does not match")).cast("long"))
    return records.select(
        field("WARC-Source-Page").cast("long").alias("page_id"),
        checked.alias("payload_bytes"),
        F.regexp_extract(header, r"\r\nWARC-Payload-Digest: sha256:([0-9a-f]{64})\r\n", 1).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
        F.octet_length(whole).cast("long").alias("record_bytes"),
        F.sha2(whole, 256).alias("record_sha256"),
    )


ORACLE = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages
), r AS (
  SELECT page_id, url, d, n, html,
         CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p
), s AS (
  SELECT *, page_id <> first AS again, sha256(concat_ws(chr(10), page_id::VARCHAR, d, url)) AS h FROM r
), t AS (
  SELECT *, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: ', CASE WHEN again THEN 'revisit' ELSE 'response' END,
    chr(13), chr(10), 'WARC-Record-ID: <urn:uuid:', substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-',
    substr(h, 17, 4), '-', substr(h, 21, 12), '>', chr(13), chr(10), 'WARC-Date: 1970-01-01T00:00:00Z',
    chr(13), chr(10), 'WARC-Target-URI: ', replace(replace(url, chr(13), '%0D'), chr(10), '%0A'),
    chr(13), chr(10), 'WARC-Payload-Digest: sha256:', d, chr(13), chr(10), 'WARC-Source-Page: ', page_id, chr(13), chr(10),
    CASE WHEN again THEN concat('WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest', chr(13), chr(10),
      'WARC-Refers-To-Page: ', first, chr(13), chr(10), 'WARC-Payload-Length: ', n, chr(13), chr(10)) ELSE '' END,
    'Content-Type: text/html; charset=utf-8', chr(13), chr(10), 'Content-Length: ', CASE WHEN again THEN 0 ELSE n END,
    chr(13), chr(10), chr(13), chr(10), CASE WHEN again THEN '' ELSE html END, chr(13), chr(10), chr(13), chr(10)) AS record FROM s
)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to, strlen(record)::BIGINT AS record_bytes, sha256(record) AS record_sha256
FROM t
"""

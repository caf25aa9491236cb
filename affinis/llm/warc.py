"""A content-addressed WARC archive.

The archive is two tables: payloads, one row per distinct payload under its SHA-256 digest, and records, with every
record's exact header bytes and the digest of its payload. Digests are verified on the way in (a digest must stand for one
length and one SHA-1) and on the way out (a payload must have the digest it is stored under). A join of the two gives back
the original records, byte for byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm.common import written

# The base32 alphabet of RFC 4648, and the digits to base 32 that conv() writes.
BASE32, DIGITS32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: Column) -> Column:
    """The bare upper-case base32 SHA-1 of bytes."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def _record_id(page_id: Column) -> Column:
    """A record's identifier, from its page and payload: rows repeating both are one record said twice."""
    name = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("")), "sha256").cast("binary"))
    spans = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *spans), F.lit(">"))


def write_archive(pages: DataFrame, min_bytes: int = 0, id_col="page_id", url_col="url", html_col="html", date="2020-01-01T00:00:00Z") -> tuple[DataFrame, DataFrame]:
    """Writes the archive of a page table to the shared folder; returns its (records, payloads).

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is a response and the others
    revisit it; smaller ones are all responses. Of repeated rows with that page_id each is a response. A null html is an
    empty payload; a null page_id never is the largest unless all of its group are, and then all are responses; a null url is
    an empty one; control characters and spaces of a url are percent-encoded; an empty table gives an empty archive;
    further columns are ignored.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    light = written(
        source.select(
            "page_id", "url", F.length("payload").cast("long").alias("n"), sha1_base32(F.col("payload")).alias("sha1"), F.sha2("payload", 256).alias("sha256")
        ),
        "warc-light",
    )
    same = light.groupBy("sha256").agg(
        F.max("page_id").alias("first"), F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("sha1").alias("s0"), F.max("sha1").alias("s1")
    )
    verified = same.withColumn(
        "first", F.when((F.col("n0") == F.col("n1")) & (F.col("s0") == F.col("s1")), F.col("first")).otherwise(F.raise_error(F.lit("two payloads have one digest")))
    ).select("sha256", "first")
    # one page per digest carries the payload into the archive
    carried = source.join(verified.select(F.col("first").alias("page_id"), "sha256"), "page_id").where(F.sha2("payload", 256) == F.col("sha256"))
    unnamed = source.where("page_id is null").withColumn("sha256", F.sha2("payload", 256)).join(verified.where("first is null").select("sha256"), "sha256")
    if not light.where("page_id is not null").groupBy("page_id", "sha256").count().where("count > 1").isEmpty():
        carried = carried.dropDuplicates(["sha256"])  # only repeated rows need this exchange of payloads
    unnamed = unnamed.select("sha256", "payload").dropDuplicates(["sha256"])
    payloads = written(carried.select("sha256", "payload").union(unnamed), "warc-payloads")
    revisit = (F.col("n") >= min_bytes) & (F.col("page_id") != F.col("first"))
    revisit = F.coalesce(revisit, F.col("page_id").isNull() & F.col("first").isNotNull() & (F.col("n") >= min_bytes))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), " ", "%20")
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        url = F.regexp_replace(url, char, code)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit("\r\n\r\n"))
    kind = F.when(revisit, "revisit").otherwise("response")
    block = F.when(revisit, F.length(http)).otherwise(F.length(http) + F.col("n"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _record_id(F.col("first")), F.lit("\r\nWARC-Refers-To-Page: "), F.col("first"))).otherwise(""),
        F.coalesce(F.concat(F.lit("\r\nWARC-Page: "), F.col("page_id")), F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block, F.lit("\r\n\r\n"), http,
    )
    records = light.join(verified, "sha256").select(header.cast("binary").alias("header"), "sha256")
    return written(records, "warc-records"), payloads


def original_records(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """(record, payload): every record's bytes up to the next record, and its page's payload, rebuilt by a join."""
    text = F.decode("header", "UTF-8")
    body = F.when(text.startswith("WARC/1.1\r\nWARC-Type: revisit"), F.lit(b"")).otherwise(F.col("payload"))
    joined = records.join(payloads, "sha256")
    return joined.select(F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"), "payload")


def write_warc_files(records: DataFrame, payloads: DataFrame, path: str, compression: str = "none") -> None:
    """Writes the records as WARC files, one per task: the records one after the other, each closed by two line ends."""
    whole = original_records(records, payloads).select(F.expr("decode(substring(record, 1, length(record) - 4), 'UTF-8')"))
    whole.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def read_archive(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, digest and length taken anew from the stored bytes."""
    checked = payloads.select(
        "sha256",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha2("payload", 256) == F.col("sha256"), sha1_base32(F.col("payload"))).otherwise(F.raise_error(F.lit("a payload is damaged"))).alias("payload_digest"),
    )
    text = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))

    parsed = records.select(
        "sha256",
        field("WARC-Page").cast("long").alias("page_id"),
        F.regexp_extract(text, r"^WARC/1\.1\r\nWARC-Type: (\w+)\r\n", 1).alias("record_type"),
        field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
        field("WARC-Payload-Digest").alias("declared"),
    )
    joined = parsed.join(checked, "sha256")
    digest = F.when(F.col("declared") == F.concat(F.lit("sha1:"), F.col("payload_digest")), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record names another payload")))
    return joined.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")


def archive_pages(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes a page table's archive and reads it back, one row per page."""
    return read_archive(*write_archive(pages, min_bytes))

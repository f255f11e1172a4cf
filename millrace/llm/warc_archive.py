"""Content-addressed web archive: payload bytes once, exact record headers apart.

An archive is a folder with two Parquet tables.  ``payloads`` has each payload's bytes
once, under its SHA-256.  ``records`` has one row per WARC record: the exact header block
and the digest of the payload it stands for.  Reading joins them again by digest.

Digests are verified both ways: writing fails if two payloads of one digest differ in length
or in a second, independent hash; reading recomputes the SHA-256 of every stored payload.

Bytes are shuffled once, after a map-side combine that keeps one payload per digest and
task; which record is the response is settled on ids and digests alone.  A digest that holds
a third of all records is a single row in the aggregates, and a skewed side in the join, which
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The profile that names revisits with an identical payload, and line ends of headers.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _line(name: str, value: Column) -> Column:
    """A header line; none for NULL.  Line breaks in a value are percent-encoded."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def _record_id(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    least_bytes: int = 100,
) -> None:
    """Write one WARC record for every row of ``pages``.

    The payload is the column as UTF-8 bytes, NULL as none.  Of the records with equal
    payloads of at least ``least_bytes``, the one with the smallest id is a response and the
    others revisit it; shorter ones are responses.  Rows that repeat the smallest id are
    responses too; NULL ids come after all others.  A NULL url leaves out its header line.  No
    rows give two empty tables.
    """
    body = pages.select(
        F.col(id).alias("id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))

    check = F.struct(F.octet_length("payload").alias("n"), F.xxhash64("payload").alias("h"))
    payloads = (
        body.groupBy("digest")
        .agg(F.first("payload").alias("payload"), F.min(check).alias("low"), F.max(check).alias("high"))
        .select("digest", F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("different payloads share the digest "), "digest")).cast("binary")
        ).alias("payload"))
    )
    payloads.write.mode("overwrite").parquet(f"{folder}/payloads")

    heads = body.select("id", "url", "digest", F.octet_length("payload").cast("long").alias("n"))
    owners = heads.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("id").alias("owner"))
    owners = owners.withColumn("owned", F.lit(True))
    revisit = F.col("owned").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit(REVISIT_PROFILE)), _line("WARC-Refers-To", _record_id(F.col("owner")))
        )).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")),
    )
    records = heads.join(owners, "digest", "left").select(header.cast("binary").alias("header"), "digest")
    records.write.mode("overwrite").parquet(f"{folder}/records")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The stored payloads; a payload that doesn't match its digest ends the read."""
    stored = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    return stored.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload doesn't match its digest "), "digest")).cast("binary")
    ).alias("payload"))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record again: its exact header, the payload it stands for, and its bytes.

    Columns: header (binary), digest, payload (the full payload, also of revisits),
    record (the bytes of the WARC record; a revisit's block is empty).  A header whose
    payload is missing ends the read.
    """
    heads = spark.read.schema("header binary, digest string").parquet(f"{folder}/records")
    joined = heads.join(read_payloads(spark, folder).withColumn("found", F.lit(True)), "digest", "left")
    payload = F.when(F.col("found"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("no payload for the digest "), "digest")).cast("binary"))
    end = F.lit(CRLF).cast("binary")
    block = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("header", "digest", payload.alias("payload")).select(
        "*", F.concat("header", end, block, end, end).alias("record"))


def field(name: str) -> Column:
    """A field of the column ``header``; NULL if it has no such line."""
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def record_number(name: str) -> Column:
    """The number in a field that holds the id of a record."""
    return F.regexp_extract(field(name), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

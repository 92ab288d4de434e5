"""A content-addressed archive of WARC records.

The archive has two tables. ``payloads`` holds the bytes of each distinct payload once, under their SHA-256. ``records``
holds a row per record: the exact bytes of its headers, the digest of its payload, and whether its block carries the
payload. A record is put together again by joining the two, byte for byte; digests are verified when payloads are read.

Of the records with equal payloads of a given size or more, the one with the smallest key is the response, the others
are revisits that refer to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.arrow import columns, stored

# Payloads of fewer bytes are repeated as responses rather than revisited.
REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CAPTURED = "1970-01-01T00:00:00Z"


def _record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line breaks in values would end the line, so they become blanks."""
    flat = F.regexp_replace(value.cast("string"), "[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), flat, F.lit("\r\n")), F.lit(""))


def write_archive(
    df: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Write a WARC record for each row of ``df`` into the archive ``folder``.

    A null payload is empty. Rows with a null key count as larger than all others: they revisit, and are responses only
    if no row of their payload has a key. Rows that share the smallest key of a payload are all responses, rows that
    repeat a whole record stay records of their own. Other columns are ignored.
    """
    pages = columns(df, key=id_col, url=url, payload=payload).select(
        F.col("key").cast("bigint").alias("key"),
        "url",
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"").cast("binary")).alias("payload"),
    )
    hashed = pages.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("bigint"))

    # A payload's first key by a map-side fold: a digest with a third of all rows sends one row per task.
    # Written, it is joined by an exchange of its own, whose hot partitions Spark can split.
    firsts = stored(hashed.groupBy("digest").agg(F.min("key").alias("first")), "firsts")
    light = hashed.select("key", "url", "digest", "size")
    typed = light.join(firsts, "digest", "left").withColumn(
        "revisit", (F.col("size") >= revisit_bytes) & F.coalesce(F.col("key") != F.col("first"), F.col("first").isNotNull())
    )
    http = F.concat(F.lit(HTTP_HEAD), F.lit("Content-Length: "), F.col("size"), F.lit("\r\n\r\n"))
    block = F.octet_length(http) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("size"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(F.col("revisit"), F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        _line("WARC-Record-ID", _record_id(F.col("key"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(CAPTURED)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(_line("WARC-Refers-To", _record_id(F.col("first"))), _line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", block),
        F.lit("\r\n"),
        http,
    )
    records = typed.select("key", head.cast("binary").alias("head"), "digest", (~F.col("revisit")).alias("carries"))
    records.write.mode("overwrite").parquet(f"{folder}/records")
    # Equal digests are equal bytes, so any bearer will do: one per task and payload reaches the shuffle.
    hashed.select("digest", "payload").dropDuplicates(["digest"]).write.mode("overwrite").parquet(f"{folder}/payloads")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, payload) of the archive; a payload that does not have its digest stops the read."""
    rows = spark.read.parquet(f"{folder}/payloads")
    sound = F.sha2("payload", 256) == F.col("digest")
    return rows.select(
        "digest",
        F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("payload"),
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(key, head, digest, carries, payload) of every record, ``payload`` in full also for revisits."""
    records = spark.read.parquet(f"{folder}/records")
    return records.join(read_payloads(spark, folder), "digest")


def record_bytes() -> Column:
    """The bytes of a record of ``read_records`` as they stand in a WARC file."""
    return F.concat("head", F.when(F.col("carries"), F.col("payload")).otherwise(F.lit(b"").cast("binary")), F.lit(b"\r\n\r\n").cast("binary"))


def header(name: str, head: Column) -> Column:
    """Value of a WARC header line, null if absent."""
    found = F.regexp_extract(head.cast("string"), f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def parsed_records(spark: SparkSession, folder: str) -> DataFrame:
    """(key, record_type, target_uri, refers_to, payload_digest, payload_bytes) read from the records' own bytes.

    The digest and the size are those of the reconstructed payload.
    """
    rows = read_records(spark, folder)
    warc = F.substring_index(F.col("head").cast("string"), "\r\n\r\n", 1)
    read = rows.select(F.concat(warc, F.lit("\r\n")).alias("warc"), "payload")
    key = lambda text: F.regexp_extract(text, "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")
    return read.select(
        key(header("WARC-Record-ID", F.col("warc"))).alias("key"),
        header("WARC-Type", F.col("warc")).alias("record_type"),
        header("WARC-Target-URI", F.col("warc")).alias("target_uri"),
        key(header("WARC-Refers-To", F.col("warc"))).alias("refers_to"),
        F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )

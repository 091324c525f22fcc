"""Content-addressed web archive; DataFrame functions only.

Each page becomes a WARC record: header block, payload, end. The archive keeps them as two
tables: ``payloads`` holds the bytes of each different payload once, under their SHA-256, and
``headers`` the exact header block of every record with the SHA-256 it points to. The original
records come back through a join. Of pages with equal payloads the one with the largest id is
the response and the others revisit it, with an empty block, so a payload that a third of all pages share is stored
and read once, and the header side of the join is what skew handling may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import materialise

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
#: Record ids are UUIDs of version 8 (free form) that spell the page id in their last 16 digits.
ID_HEAD = "<urn:uuid:00000000-0000-8000-"
#: Those of pages without an id spell a hash of their address and payload instead.
HASH_HEAD = "<urn:uuid:00000000-0000-8001-"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits as eight groups of 20, four letters each."""
    digits = F.sha1(payload)
    groups = [F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 10).cast("int") for i in range(8)]
    letter = lambda group, shift: F.substring(
        F.lit(BASE32), F.shiftright(group, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)
    )
    return F.concat(*(letter(group, shift) for group in groups for shift in (15, 10, 5, 0)))


def record_id(number: Column, head: str = ID_HEAD) -> Column:
    digits = F.lower(F.lpad(F.hex(number), 16, "0"))
    return F.concat(F.lit(head), F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12), F.lit(">"))


def page_of(id_field: Column) -> Column:
    """The page id that a record id spells; two's complement for negative ones."""
    digits = F.regexp_replace(F.substring(id_field, len(ID_HEAD) + 1, 17), "-", "")
    high, low = (F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9))
    return F.when(F.startswith(id_field, F.lit(ID_HEAD)) & (F.length(digits) == 16), F.shiftleft(high, 32).bitwiseOR(low))


def _field(name: str, value: Column) -> Column:
    # A line end inside a value would end the field, so it is percent-encoded.
    clean = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise(F.lit(""))


def header_field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def as_records(pages: DataFrame) -> DataFrame:
    """``page_id``, ``sha256``, ``n_bytes``, ``sha1``, ``payload`` and ``url`` of every page. A null payload is empty."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).select(
        "page_id",
        "url",
        F.sha2("payload", 256).alias("sha256"),
        F.octet_length("payload").cast("long").alias("n_bytes"),
        base32_sha1(F.col("payload")).alias("sha1"),
        "payload",
    )


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str | None = None) -> None:
    """Write ``path/headers`` and ``path/payloads``.

    ``date`` (``YYYY-MM-DDThh:mm:ssZ``) is the records' ``WARC-Date``; by default it is the time of writing. Payloads
    under ``min_bytes`` are never revisited. Pages without an id stay responses; their record ids come from a
    hash of address and payload. Rows that repeat a page id and payload are records of their own; the one response may then stand
    for several rows. Fails if two payloads share a digest but not their length or SHA-1.
    """
    spark = pages.sparkSession
    records = as_records(pages)
    facts = materialise(records.select("page_id", "url", "sha256", "n_bytes", "sha1"), "facts")
    groups = facts.groupBy("sha256").agg(
        F.max("page_id").alias("response_id"), F.count_distinct("n_bytes", "sha1").alias("kinds")
    )
    groups = materialise(groups, "digests")
    if groups.where(F.col("kinds") > 1).limit(1).count():
        raise ValueError("two payloads share a SHA-256 but differ in length or SHA-1")
    revisits = (F.col("n_bytes") >= min_bytes) & (F.col("page_id") < F.col("response_id"))
    kind = F.when(revisits, F.lit("revisit")).otherwise(F.lit("response"))
    seconds = F.unix_seconds(F.current_timestamp())
    written = F.lit(date) if date else F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.coalesce(record_id(F.col("page_id")), record_id(F.xxhash64("url", "sha256"), HASH_HEAD))),
        _field("WARC-Date", written),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Refers-To", F.when(revisits, record_id(F.col("response_id")))),
        _field("WARC-Profile", F.when(revisits, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("Content-Type", F.when(~F.coalesce(revisits, F.lit(False)), F.lit("text/html"))),
        _field("Content-Length", F.when(revisits, 0).otherwise(F.col("n_bytes")).cast("string")),
        F.lit("\r\n"),
    )
    facts.join(groups.drop("kinds"), "sha256").select("page_id", header.alias("header"), "sha256").write.option(
        "compression", "zstd"
    ).parquet(f"{path}/headers")
    # One row of each digest gives the bytes; the partial minimum leaves one copy per task before the shuffle.
    records.groupBy("sha256").agg(F.min("payload").alias("payload")).write.option("compression", "zstd").parquet(
        f"{path}/payloads"
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: ``header``, ``payload``, ``verified``, and the header's fields as columns.

    A record's bytes are given by :func:`record_bytes`; ``payload`` is the whole one for a revisit too, whose block is
    empty. ``verified`` is true if the payload has the digest it is stored under, the SHA-1 of the header and,
    for a response, its length. A header whose payload is missing has a
    null payload and is not verified.
    """
    # The digests of a payload are taken where it is stored, once, not for every record that refers to it.
    stored = spark.read.parquet(f"{path}/payloads").select(
        "sha256",
        "payload",
        F.octet_length("payload").cast("long").alias("stored_bytes"),
        base32_sha1(F.col("payload")).alias("stored_sha1"),
        (F.sha2("payload", 256) == F.col("sha256")).alias("intact"),
    )
    header = F.col("header")
    digest = F.regexp_replace(header_field(header, "WARC-Payload-Digest"), "^sha1:", "")
    block = F.when(_is_revisit(header), 0).otherwise(F.col("stored_bytes"))
    fits = header_field(header, "Content-Length").cast("long") == block
    return (
        spark.read.parquet(f"{path}/headers")
        .select("header", "sha256")
        .join(stored, "sha256", "left")
        .select(
            page_of(header_field(header, "WARC-Record-ID")).alias("page_id"),
            header_field(header, "WARC-Target-URI").alias("url"),
            header_field(header, "WARC-Type").alias("record_type"),
            page_of(header_field(header, "WARC-Refers-To")).alias("refers_to"),
            F.col("stored_bytes").alias("payload_bytes"),
            F.col("stored_sha1").alias("payload_digest"),
            F.coalesce(
                F.col("intact") & (F.col("stored_sha1") == digest) & fits, F.lit(False)
            ).alias("verified"),
            header,
            "payload",
        )
    )


def _is_revisit(header: Column) -> Column:
    return header_field(header, "WARC-Type") == "revisit"


def record_bytes(header: Column, payload: Column) -> Column:
    """A record as it stands in a WARC file; that of a revisit has no block."""
    block = F.when(_is_revisit(header), F.lit("").cast("binary")).otherwise(payload)
    return F.concat(header.cast("binary"), block, F.lit(END).cast("binary"))

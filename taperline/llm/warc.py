"""WARC records in a content-addressed archive.

The archive is two tables in the shared folder. ``payloads`` holds the bytes of every different
payload once, under its SHA-256. ``headers`` holds one row per record: the exact header block and
the address of the payload. Original records come back by joining the two; on the way each payload
is hashed again, and one that no longer fits its address stops the job.

Of records with equal payloads of at least ``min_bytes`` the one with the largest page_id is the
response and the others are revisits of it; of rows that also share the page_id, one is the response.
Null html is an empty payload. A null page_id counts as smaller than any other, and refers_to is null
where the response has none. Ids of any type come back as that type; line breaks and percent signs of ids
that are text are percent-encoded inside the record. A null url is an empty one; carriage returns and line
feeds in it are percent-encoded, all other characters stay, as only CRLF ends a header line.
An empty table gives an empty archive. Other columns of the input are not archived.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import stored

CRLF = "\r\n"
#: The alphabets of numbers to base 32 and of RFC 4648.
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_RFC = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Archive:
    payloads: DataFrame  # digest, payload
    headers: DataFrame  # header, digest
    page_type: str = "bigint"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: each 5 hexadecimal digits are 4 of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), BASE32_DIGITS, BASE32_RFC)


def write_archive(pages: DataFrame, min_bytes: int = 0) -> Archive:
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    records = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest")
    )
    # Copies collapse on the map side, so a payload that many pages share moves once per task.
    payloads = stored(records.groupBy("digest").agg(F.any_value("payload").alias("payload")), "payloads")
    facts = stored(
        records.select(
            F.monotonically_increasing_id().alias("row"),
            "page_id",
            F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
            "digest",
            base32_sha1(F.col("payload")).alias("sha1"),
            F.octet_length("payload").cast("long").alias("bytes"),
        ),
        "records",
    )
    responses = (
        facts.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "row")).alias("response"))
    )
    # Many records may share a digest; the join's small rows are split by the adaptive planner.
    known = facts.join(responses, "digest", "left")
    revisit = F.coalesce(F.col("response.row") != F.col("row"), F.lit(False))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("response.page_id")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    ]
    header = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF))
    page_type = pages.schema["page_id"].dataType.simpleString()
    return Archive(payloads, stored(known.select(header.alias("header"), "digest"), "headers"), page_type)


#: What an id may not hold inside of a header line, and how it is written there; the percent sign comes first.
ESCAPES = (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"), (">", "%3E"))


def record_id(page_id: Column) -> Column:
    text = page_id.cast("string")
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return F.coalesce(F.concat(F.lit("<urn:page:"), text, F.lit(">")), F.lit("<urn:page>"))


def page_of(record: Column, page_type: str) -> Column:
    """The id in a record id; null where it has none."""
    text = F.when(record.startswith("<urn:page:"), F.substring(record, F.lit(11), F.length(record) - 11))
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text.cast(page_type)


def verified(payloads: DataFrame) -> DataFrame:
    """The payload table; fails where bytes and address disagree."""
    fits = F.sha2("payload", 256) == F.col("digest")
    return payloads.select(
        F.when(fits, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest"))).alias("digest"),
        "payload",
    )


def read_records(archive: Archive) -> DataFrame:
    """(record, digest): each original WARC record as bytes; a revisit has an empty block."""

    def record(block: Column) -> Column:
        return F.concat(F.encode(F.concat("header", F.lit(CRLF)), "UTF-8"), block, F.encode(F.lit(CRLF * 2), "UTF-8"))

    revisit = F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}")
    whole = archive.headers.filter(~revisit).join(verified(archive.payloads), "digest")
    empty = archive.headers.filter(revisit).select(record(F.encode(F.lit(""), "UTF-8")).alias("record"), "digest")
    return whole.select(record(F.col("payload")).alias("record"), "digest").unionByName(empty)


def parse_records(records: DataFrame, page_type: str = "bigint") -> DataFrame:
    """Header fields and block of WARC records given as bytes."""
    # Latin-1 keeps one character per byte, so positions of characters are those of bytes.
    at = F.locate(CRLF * 2, F.decode("record", "ISO-8859-1"))
    header = F.decode(F.substring(F.col("record"), F.lit(1), at + 1), "UTF-8")

    def field(name: str) -> Column:
        found = F.filter(F.split("header", CRLF), lambda line: line.startswith(f"{name}: "))
        return F.substring(F.try_element_at(found, F.lit(1)), len(name) + 3, 1 << 30)

    def page(name: str) -> Column:
        return page_of(field(name), page_type)

    block = F.substring(F.col("record"), F.col("at") + 4, field("Content-Length").cast("int"))
    return records.select("digest", "record", at.alias("at"), header.alias("header")).select(
        "digest",
        page("WARC-Record-ID").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        field("WARC-Payload-Digest").alias("payload_digest"),
        block.alias("block"),
    )


def revisit_digest(archive: Archive) -> DataFrame:
    """One row per record of the archive, as read back: sizes and digests are those of the stored bytes."""
    # The sizes and digests of revisits are those of the payload that their response holds.
    records = parse_records(read_records(archive), archive.page_type)
    held = verified(archive.payloads).select(
        "digest", F.octet_length("payload").cast("long").alias("held_bytes"), base32_sha1(F.col("payload")).alias("held_sha1")
    )
    own = records.select(
        "digest",
        "page_id",
        F.octet_length("block").cast("long").alias("own_bytes"),
        base32_sha1(F.col("block")).alias("own_sha1"),
        "record_type",
        "refers_to",
    )
    revisit = F.col("record_type") == "revisit"
    return own.join(held, "digest").select(
        "page_id",
        F.when(revisit, F.col("held_bytes")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("held_sha1")).otherwise(F.col("own_sha1")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )

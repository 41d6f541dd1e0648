"""Content-addressed WARC archive.

``archive`` writes two tables: ``headers`` holds the exact header bytes of every
WARC record with the address of its payload, ``payloads`` holds each payload's
bytes once under its address.  The address is the SHA-256 of the bytes; headers
also carry the customary base32 SHA-1.  ``read_records`` recomputes both digests
of every stored payload, fails on a difference, and joins headers with payloads
by address; ``reconstruct`` does the same and gives the original record bytes.

Of the records with equal payloads, of at least ``min_bytes`` bytes, the one with
the largest page_id is the response and the others are revisits that refer to it;
smaller payloads are all responses.

The duplicates are found on (page_id, digest) alone.  Payload bytes cross the
network once, dealt by page_id, so a payload that a third of all pages share does
not gather anywhere; joins by address meet it with one row on the payload side
and are split on the other side by the adaptive skew rule.

Defined results: NULL html is the empty payload; a NULL page_id counts as smaller
than any other and gives an empty record id; repeated rows with the largest
page_id are all responses of the one stored payload; a NULL url leaves out the
target header; no rows give an empty archive.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import Workspace

# RFC 4648 base32 alphabet and the revisit profile of the WARC standard.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Capture date of records whose table has none.
DATE = "1970-01-01T00:00:00Z"
_NO_ID = -(1 << 63)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits make four characters."""
    digest = F.sha1(payload)
    characters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(31) + 1
            characters.append(F.lit(_BASE32).substr(at, F.lit(1)))
    return F.concat(*characters)


def _address(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def _payload() -> Column:
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def _line(name: str, value: Column) -> Column:
    safe = F.regexp_replace(value, "[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(revisit: Column) -> Column:
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Refers-To", _urn(F.col("response_id"))),
                _line("WARC-Profile", F.lit(_PROFILE)),
            ),
        ).otherwise(F.lit("Content-Type: text/html; charset=utf-8\r\n")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )
    return F.encode(head, "UTF-8")


def archive(pages: DataFrame, space: Workspace, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Write headers (address, header) and payloads (address, payload); both read back."""
    digests = space.step(
        pages.select("page_id", "url", _payload().alias("payload")).select(
            F.col("page_id").cast("long").alias("page_id"),
            "url",
            _address(F.col("payload")).alias("address"),
            base32_sha1(F.col("payload")).alias("sha1"),
            F.octet_length("payload").cast("long").alias("size"),
        )
    )
    owners = space.step(
        digests.groupBy("address").agg(F.max("page_id").alias("response_id"))
    )
    revisit = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    headers = space.keep(
        digests.join(owners, "address").select("address", _header(revisit).alias("header"))
    )
    stored = (
        pages.select(
            F.coalesce(F.col("page_id").cast("long"), F.lit(_NO_ID)).alias("id"),
            _payload().alias("payload"),
        )
        .withColumn("address", _address(F.col("payload")))
        .join(
            owners.select("address", F.coalesce("response_id", F.lit(_NO_ID)).alias("id")),
            ["id", "address"],
        )
        .groupBy("id", "address")
        .agg(F.first("payload").alias("payload"))
        .select("address", "payload")
    )
    return headers, space.keep(stored)


def _verified(payloads: DataFrame) -> DataFrame:
    good = F.col("address") == _address(F.col("payload"))
    return payloads.select(
        F.when(good, F.col("address")).otherwise(
            F.raise_error(F.lit("a stored payload does not match its address"))
        ).alias("address"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("sha1"),
        "payload",
    )


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("text"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _page(name: str) -> Column:
    return F.regexp_extract(_field(name), "<urn:page:(-?[0-9]+)>", 1)


def _number(digits: Column) -> Column:
    return F.when(digits != "", digits).cast("long")


def read_records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row per record, parsed from its header bytes and joined with its verified payload."""
    stated = F.col("stated")
    return (
        headers.withColumn("text", F.decode("header", "UTF-8"))
        .select(
            "address",
            "header",
            _number(_page("WARC-Record-ID")).alias("page_id"),
            _field("WARC-Target-URI").alias("url"),
            _field("WARC-Type").alias("record_type"),
            _number(_page("WARC-Refers-To")).alias("refers_to"),
            F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("stated"),
        )
        .join(_verified(payloads), "address", "left")
        .withColumn(
            "payload_digest",
            F.when(stated == F.col("sha1"), stated).otherwise(
                F.raise_error(F.lit("a record's payload is missing or differs from its digest"))
            ),
        )
        .drop("stated", "sha1", "address")
    )


def reconstruct(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """page_id and the exact bytes of each WARC record."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return read_records(headers, payloads).select(
        "page_id", "payload_digest", F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record")
    )

"""Exact round trips through the archive."""

import base64
import hashlib

import pytest

from tallyroom.llm import warc
from tallyroom.llm.common import Workspace

PAGES = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "http://b/\r\nX: y", "\u00e9\r\n\r\nz"),
    (5, "http://c", None), (6, "http://c", ""), (7, "http://d", "seven"), (7, "http://d", "seven"), (2, "http://e", "seven"),
    (None, "http://f", "lone"), (8, "http://g", "y" * 300_000),
]


@pytest.fixture(scope="module")
def archived(spark):
    pages = spark.createDataFrame(
        [(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, address string, size int"
    )
    with Workspace(spark, "test-warc") as space:
        return warc.archive(pages, space)


def sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_records(archived):
    rows = sorted(
        (
            (r["page_id"] is not None, r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
            for r in warc.read_records(*archived).collect()
        ),
        key=str,
    )
    expected = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        owner = max((p for p, _, h in PAGES if (h or "").encode() == payload and p is not None), default=None)
        first = page == owner
        expected.append(
            (page is not None, page or 0, len(payload), sha1(payload), "response" if first else "revisit", None if first else owner)
        )
    assert rows == sorted(expected, key=str)


def test_each_payload_is_stored_once(archived):
    stored = [bytes(r["payload"]) for r in archived[1].collect()]
    assert sorted(stored) == sorted({(h or "").encode() for _, _, h in PAGES})


def test_reconstruction_is_exact(archived):
    headers = sorted(bytes(r["header"]) for r in archived[0].collect())
    records = sorted(bytes(r["record"]) for r in warc.reconstruct(*archived).collect())
    assert len(records) == len(PAGES)
    bodies = {f"sha1:{sha1((h or '').encode())}".encode(): (h or "").encode() for _, _, h in PAGES}
    rebuilt = []
    for header in headers:
        digest = header.split(b"WARC-Payload-Digest: ")[1].split(b"\r\n")[0]
        body = bodies[digest] if b"WARC-Type: response" in header else b""
        assert b"Content-Length: %d\r\n\r\n" % len(body) in header
        assert header.count(b"\r\n\r\n") == 1
        rebuilt.append(header + body + b"\r\n\r\n")
    assert records == sorted(rebuilt)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    with Workspace(spark, "test-warc") as space:
        rows = warc.read_records(*warc.archive(pages, space, min_bytes=3)).collect()
    assert {r["page_id"]: r["record_type"] for r in rows} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_a_changed_payload_is_noticed(spark, archived):
    headers, payloads = archived
    from pyspark.sql import functions as F

    bad = payloads.withColumn("payload", F.concat("payload", F.lit(b"!")))
    with pytest.raises(Exception, match="does not match its address"):
        warc.read_records(headers, bad).select("page_id", "payload_bytes", "payload_digest").collect()

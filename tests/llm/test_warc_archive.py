"""The archive gives back every record, stores payloads once and notices damage."""

import hashlib

import pytest

from millrace.llm.warc_archive import field, read_records, record_number, write_archive
from millrace.session import work_path

ROWS = [
    (5, "http://a/", "x" * 100), (3, "http://b/\r\nEvil: 1", "x" * 100), (4, None, "x" * 100), (3, "http://b/", "x" * 100),
    (7, "http://c/", "x" * 99), (8, "http://c/", "x" * 99), (9, "http://d/", None), (10, "http://d/", ""),
    (None, "http://e/", "x" * 100), (None, "http://f/", "y" * 200), (11, "http://g/", "é" * 50), (12, "http://g/", "é" * 50),
    (13, "http://h/", "z" * 3_000_000),
]


@pytest.fixture(scope="module")
def archive(spark):
    folder = work_path(spark, "archive")
    pages = spark.createDataFrame([(*r, "d", b"h") for r in ROWS], "page_id long, url string, html string, digest string, header binary")
    write_archive(pages, folder)
    return folder


def test_records(spark, archive):
    rows = read_records(spark, archive).select(
        record_number("WARC-Record-ID").alias("id"), field("WARC-Type").alias("type"),
        record_number("WARC-Refers-To").alias("to"), "header", "payload", "record").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0, r[3])
    want = []
    for id_, _, html in ROWS:
        body = (html or "").encode()
        owner = min([i for i, _, h in ROWS if (h or "").encode() == body and i is not None], default=None)
        again = len(body) >= 100 and id_ != owner
        want.append((id_, "revisit" if again else "response", owner if again else None, hashlib.sha256(body).hexdigest()))
    got = [(r["id"], r["type"], r["to"], hashlib.sha256(r["payload"]).hexdigest()) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    for r in rows:
        header = bytes(r["header"])
        assert header.startswith(b"WARC/1.1\r\n") and b"\r\nEvil" not in header
        block = b"" if r["type"] == "revisit" else bytes(r["payload"])
        assert bytes(r["record"]) == header + b"\r\n" + block + b"\r\n\r\n"
        assert f"Content-Length: {len(block)}\r\n".encode() in header


def test_payloads_are_stored_once(spark, archive):
    stored = spark.read.parquet(f"{archive}/payloads")
    assert stored.count() == len({(h or "") for _, _, h in ROWS})


def test_damage_ends_the_read(spark, archive):
    folder = work_path(spark, "archive")
    spark.read.parquet(f"{archive}/records").write.parquet(f"{folder}/records")
    spark.read.parquet(f"{archive}/payloads").selectExpr("digest", "cast('?' AS binary) AS payload").write.parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="doesn't match its digest"):
        read_records(spark, folder).selectExpr("max(octet_length(payload))").collect()
    spark.read.parquet(f"{archive}/payloads").limit(1).write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="no payload for the digest"):
        read_records(spark, folder).selectExpr("max(octet_length(payload))").collect()


def test_no_rows(spark):
    folder = work_path(spark, "archive")
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert read_records(spark, folder).count() == 0

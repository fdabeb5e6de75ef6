"""The archive: rules of revisits, exact records, damage."""

import gzip
import hashlib
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assay.llm import warc

LONG, LONGER = "<p>" + "x" * 100, "\r\n\r\nWARC/1.1\r\n\xe9 " + "y" * 200
ROWS = [(4, "http://a", LONG, 1), (2, "http://b", LONG, 1), (9, "http://c", LONG, 1),
        (3, None, "tiny", 1), (5, "u", "tiny", 1), (6, "line\r\nend", None, 1), (7, "e", "", 1),
        (8, "n", LONGER, 1), (1, "n", LONGER, 1), (None, "z", LONG, 1), (2, "http://b", LONG, 1),
        (10, "big", "z" * 3_000_000, 1), (11, "edge", "é" * 50, 1), (12, "edge", "é" * 50, 1)]
SCHEMA = "page_id long, url string, html string, digest int"


def test_records(spark):
    folder, records = warc.archive_pages(spark.createDataFrame(ROWS, SCHEMA))
    got = sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in records.collect()], key=repr)
    first = {LONG: 2, LONGER: 1, "z" * 3_000_000: 10, "é" * 50: 11}

    def row(page, html):
        data = (html or "").encode()
        again = page is not None and first.get(html, page) != page
        return (page, len(data), hashlib.sha256(data).hexdigest(),
                "revisit" if again else "response", first[html] if again else None)

    assert got == sorted([row(p, h) for p, _, h, _ in ROWS], key=repr)
    whole = warc.rebuild(spark, folder, warc.read_headers(spark, folder)).collect()
    assert sorted((str(r.page_id), bytes(r.payload).decode()) for r in whole) == sorted(
        (str(p), h or "") for p, _, h, _ in ROWS)
    header = next(r.header for r in whole if r.page_id == 9)
    assert header.split("\r\n")[:5] == ["WARC/1.1", "WARC-Type: revisit",
                                        "WARC-Record-ID: <urn:page:9>",
                                        f"WARC-Date: {warc.DATE}", "WARC-Target-URI: http://c"]
    assert "WARC-Refers-To: <urn:page:2>" in header and header.endswith("Content-Length: 0")
    assert "line%0D%0Aend" in next(r.header for r in whole if r.page_id == 6)


def test_payloads_are_stored_once(spark):
    rows = [(i, "u", LONG * 50, 1) for i in range(500)]
    folder, _ = warc.archive_pages(spark.createDataFrame(rows, SCHEMA))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(folder).glob("*.gz"))
    assert data.count((LONG * 50).encode()) == 1 and data.count(b"WARC-Type: revisit") == 499


def test_empty_and_damaged(spark):
    _, records = warc.archive_pages(spark.createDataFrame([], SCHEMA))
    assert records.count() == 0
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\n" \
           f"WARC-Payload-Digest: sha256:{'0' * 64}\r\nContent-Length: 1\r\n\r\n"
    with pytest.raises(ValueError, match="digest"):
        list(warc._records(io.BytesIO((head + "x\r\n\r\n").encode())))
    with pytest.raises(ValueError, match="Content-Length"):
        list(warc._records(io.BytesIO((head + "xy\r\n\r\n").encode())))
    with pytest.raises(ValueError, match="within a header"):
        list(warc._records(io.BytesIO(head[:40].encode())))


@pytest.mark.parametrize("least_hot", [1, 7, 256])
def test_revisits_are_put_together_from_their_payloads(spark, monkeypatch, least_hot):
    monkeypatch.setattr(warc, "LEAST_HOT", least_hot)
    rows = ROWS + [(100 + i, "hot", LONG, 1) for i in range(60)] + [(200, "hot", LONGER, 1)] * 9
    _, records = warc.archive_pages(spark.createDataFrame(rows, SCHEMA))
    got = records.collect()
    assert sorted((str(r.page_id), bytes(r.payload).decode()) for r in got) == sorted(
        (str(p), h or "") for p, _, h, _ in rows)
    assert all((r.payload_bytes, r.payload_digest) == (
        len(r.payload), hashlib.sha256(r.payload).hexdigest()) for r in got)
    assert sum(r.record_type == "revisit" for r in got) == 60 + 9 + 4


def test_a_missing_payload_is_an_error(spark):
    folder, _ = warc.archive_pages(spark.createDataFrame(ROWS, SCHEMA))
    headers = warc.read_headers(spark, folder)
    with pytest.raises(Exception, match="no response holds the payload"):
        warc.rebuild(spark, folder, headers.withColumn(
            "payload_digest", F.lit("0" * 64))).collect()


def test_a_hot_digest_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 300)
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        pages = spark.range(0, 4_000, 1, 8).select(
            F.col("id").alias("page_id"), F.format_string("http://host/%d", "id").alias("url"),
            F.when(F.col("id") % 2 == 0, F.lit(LONG)).otherwise(
                F.concat(F.lit("y" * 100), F.col("id").cast("string"))).alias("html"))
        folder, records = warc.archive_pages(pages)
        assert records.groupBy("record_type").count().orderBy("record_type").collect() == [
            ("response", 2_001), ("revisit", 1_999)]
    finally:
        for name in small:
            spark.conf.unset(name)
    counts = [gzip.decompress(p.read_bytes()).count(b"WARC-Type: ")
              for p in Path(folder).glob("*.gz")]
    tasks = {p.name.split("-")[1] for p in Path(folder).glob("*.gz")
             if b"WARC-Type: revisit" in gzip.decompress(p.read_bytes())}
    assert sum(counts) == 4_000 and max(counts) <= 300 \
        and len(tasks) > 1

import base64
import hashlib
import uuid

import pytest

from kinmatch.llm import warc
from kinmatch.session import shared_folder


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        response = len(payload) < least or first.get(html or "", page_id) == page_id
        out.append((page_id, len(payload), digest(payload), "response" if response else "revisit", None if response else first[html or ""]))
    return sorted(out, key=str)


def round_trip(spark, rows, least=0):
    folder = f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    warc.write(df.repartition(2), folder, least)
    return folder


@pytest.fixture(params=["128m", "700"])
def split_bytes(spark, request):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, "http://a/\r\nX: y", "<p>one</p>"), (3, None, None), (4, "u", ""), (5, "u", FAKE), (6, "u", FAKE * 40), (7, "u", "x" + FAKE * 3 + "é" * 900),
    (8, "u", "WARC/1.0\r\n"), (9, "u", "a\r\n\r\nWARC/1.0\r\n" * 60), (None, "u", "nobody"), (None, "u", "<p>one</p>"), (10, "u", "z" * 5000), (1, "http://a/", "<p>one</p>"), (-7, "u", FAKE),
]


def test_round_trip(spark, split_bytes):
    folder = round_trip(spark, ROWS)
    found = warc.read(spark, folder, with_payload=True)
    assert sorted((tuple(r) for r in warc.pages_of(found).collect()), key=str) == expected(ROWS)
    rows = found.collect()
    assert all(r.intact for r in rows if r.record_type == "response")
    assert all(r.payload.decode() in {h or "" for _, _, h in ROWS} for r in rows)
    assert all(digest(r.payload) == r.payload_digest for r in rows if r.record_type == "response")


def test_many_small_records_over_many_splits(spark, split_bytes):
    rows = [(i, "u", f"{i}" + FAKE * (i % 3)) for i in range(200)]
    found = warc.pages_of(warc.read(spark, round_trip(spark, rows)))
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)


def test_splits_stay_whole_under_skew_handling(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    rows = [(i, "u", f"{i}" + FAKE * (i % 5) + "é" * 300) for i in range(300)]
    folder = round_trip(spark, rows)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = warc.pages_of(warc.read(spark, folder))
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_least_bytes_and_empty(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    found = warc.pages_of(warc.read(spark, round_trip(spark, rows, 3)))
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows, 3)
    folder = round_trip(spark, [])
    assert warc.read(spark, folder).collect() == []


def test_whole_table(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in warc.pages_of(warc.read(spark, round_trip(spark, rows))).collect()), key=str) == expected(rows)

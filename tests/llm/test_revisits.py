from __future__ import annotations

import pytest

from trafficlens.llm import revisits

SCHEMA = (
    "record_id long, url string, ts long, type string, headers map<string,string>, payload string"
)


def resolved(spark, rows, **options):
    records = spark.createDataFrame(rows, SCHEMA)
    return {r["record_id"]: r for r in revisits.resolve(records, **options).collect()}


@pytest.mark.parametrize("bucket", [1, 7, 3600])
def test_latest_earlier_response(spark, bucket):
    rows = []
    for i in range(60):
        rows.append((3 * i, f"http://h/{i % 4}", i * i % 53, "response", {"etag": "t"}, f"p{i}"))
        rows.append((3 * i + 1, f"HTTP://H:80/{i % 4}#f", i * 5 % 53, "revisit", {"ETag": "t"}, None))
    found = resolved(spark, rows, bucket_seconds=bucket)
    for record_id, url, ts, kind, _, _ in rows:
        if kind != "revisit":
            continue
        earlier = [
            (t, i)
            for i, u, t, k, _, _ in rows
            if k == "response" and u[-1] == url[-3] and (t, i) < (ts, record_id)
        ]
        source = max(earlier)[1] if earlier else None
        assert found[record_id]["source_id"] == source
        assert found[record_id]["outcome"] == ("resolved" if earlier else "no_response")


def test_validators_and_headers(spark):
    stored = {"ETag": 'W/"a"', "Last-Modified": "x", "Content-Length": "9", "Date": "1"}
    rows = [
        (1, "http://h", 1, "response", stored, "body"),
        (2, "http://h/", 2, "revisit", {"etag": '"a"', "Date": "2", "Content-Length": "0"}, None),
        (3, "http://h/", 2, "revisit", {"ETag": '"b"', "Last-Modified": "x"}, None),
        (4, "http://h/", 2, "revisit", {"Last-Modified": "x"}, None),
        (5, "http://h/", 2, "revisit", {"Last-Modified": "y"}, None),
        (6, "http://h/", 2, "revisit", None, None),
        (7, None, 2, "revisit", {}, None),
        (8, "http://h/", None, "revisit", {}, None),
        (9, "http://h/", 1, "revisit", {}, None),
        (0, "http://h/", 1, "revisit", {}, None),
    ]
    found = resolved(spark, rows)
    assert {i: r["outcome"] for i, r in found.items()} == {
        2: "resolved",
        3: "mismatch",
        4: "resolved",
        5: "mismatch",
        6: "unverified",
        7: "no_response",
        8: "no_response",
        9: "unverified",
        0: "no_response",
    }
    assert found[2]["payload"] == "body" and found[2]["headers"] == {
        "etag": '"a"',
        "last-modified": "x",
        "content-length": "9",
        "date": "2",
    }
    assert found[3]["payload"] is None and found[3]["headers"]["etag"] == '"b"'
    assert found[6]["headers"]["date"] == "1"


def test_repeats_and_no_rows(spark):
    row = (1, "http://h", 1, "response", {"Etag": "a", "ETAG": "b"}, "body")
    visit = (2, "http://h", 2, "revisit", {"etag": "a"}, None)
    records = spark.createDataFrame([row, row, visit, visit], SCHEMA)
    found = revisits.resolve(records).collect()
    assert [r["payload"] for r in found] == ["body", "body"]
    assert found[0]["outcome"] == "resolved"
    assert revisits.resolve(records.limit(0)).collect() == []


def test_canonical_urls(spark):
    urls = {
        "HTTP://Host:80#x": "http://host/",
        "https://h:443?q": "https://h/?q",
        "http://h:443/A#b": "http://h:443/A",
        "no scheme#x": "no scheme",
        "": "",
    }
    table = spark.createDataFrame([(u,) for u in urls], "url string")
    found = table.select("url", revisits.canonical_url(table["url"]).alias("c")).collect()
    assert {r["url"]: r["c"] for r in found} == urls

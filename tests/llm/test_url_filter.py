from __future__ import annotations

import re

from trafficlens.llm import url_filter
from trafficlens.llm.queries import URL_RULES

ODD = [
    (-1, None),
    (-2, "nohost"),
    (-3, "HTTP://WWW.Example.ORG"),
    (-4, "x://a.com?q=1://b"),
    (-5, "http://É.com/de/x#a"),
    (-6, ""),
    (-7, "http://com/de/a/b/c/d/e/f/g"),
    (-8, "http://xcom/de/"),
    (-9, "http://a.example.org/en/1"),
    (-9, "http://a.example.org/en/1"),
    (None, "http://a.b/" + "long/" * 2000),
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def by_rule(host, path):
    best = (None, None)
    for name, start, verdict in URL_RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            best = max(best, (name + start, verdict), key=lambda x: len(x[0] or ""))
    return best


def test_hosts_paths_and_rules(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame(ODD, "page_id long, url string")
    both = pages.union(odd)
    urls = [tuple(r) for r in both.collect()]
    found = url_filter.judge(both, URL_RULES).collect()
    wanted = []
    for page_id, url in urls:
        host, path = split(url)
        wanted.append((page_id, host, path, *by_rule(host, path)))
    got = [
        (r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None)
        for r in found
    ]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert {r["verdict"] for r in found} <= {"allow", "block"}


def test_templates_learn_from_labelled_branches(spark):
    rules = [("shop.net", "/ads/1", "block"), ("shop.net", "/news/1", "allow")]
    rows = []
    for i in range(60):
        rows.append((len(rows), f"http://shop.net/ads/{i}"))
        rows.append((len(rows), f"http://shop.net/news/{i}.html"))
        rows.append((len(rows), f"http://shop.net/about/w{i}"))
        rows.append((len(rows), f"http://other.net/ads/{i}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = url_filter.judge(pages, rules).collect()
    assert {(r["host"], r["template"], r["verdict"]) for r in found} == {
        ("shop.net", "/ads/*", "block"),
        ("shop.net", "/news/*", "allow"),
        ("shop.net", "/about/*", "allow"),
        ("other.net", "/ads/*", "allow"),
    }


def test_templates_without_labels_are_allowed_by_rules_that_only_block(spark):
    rules = [("shop.net", "/ads/1", "block")]
    rows = []
    for i in range(60):
        rows.append((len(rows), f"http://shop.net/ads/{i}"))
        rows.append((len(rows), f"http://shop.net/about/w{i}"))
        rows.append((len(rows), f"http://other.net/ads/{i}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = url_filter.judge(pages, rules).collect()
    assert {(r["host"], r["template"], r["verdict"]) for r in found} == {
        ("shop.net", "/*/*", "block"),
        ("shop.net", "/about/*", "allow"),
        ("other.net", "/ads/*", "allow"),
    }


def test_rare_and_alike_branches_are_merged(spark):
    rules = [("a.net", "/", "allow")]
    rows = [(i, f"http://a.net/{'abc'[i % 3] if i < 60 else 'rare' + 'x' * i}/p") for i in range(64)]
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules)
    assert {r["template"] for r in found.collect()} == {"/*/*"}


def test_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, URL_RULES).collect() == []


def test_native_plan(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = url_filter.judge(pages, URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)

"""Periodic runs against a plain search over all periods, and the query's contract."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trafficlens.llm import samples
from trafficlens.llm.periodic_runs import SuffixTree, collapse_runs, next_smaller, runs_of
from trafficlens.llm.queries import QUERIES


def plain_runs(words):
    """Every stretch that agrees with itself q words before, if q is its least period."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            stop = i
            while stop < n and words[stop] == words[stop - q]:
                stop += 1
            run = words[i - q : stop]
            smaller = any(
                all(run[k] == run[k - r] for k in range(r, len(run))) for r in range(1, q)
            )
            if len(run) >= max(6, 4 * q) and not smaller:
                found.append((i - q, len(run), q))
            i = stop
    return sorted(found, key=lambda r: (r[0], r[2]))


pieces = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 7))


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=8))
def test_runs_equal_a_plain_search(parts):
    words = [w for unit, times in parts for w in unit * times]
    assert runs_of(np.array(words, np.int64)) == plain_runs(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=40))
def test_tree_against_plain_suffixes(text):
    tree = SuffixTree(text)
    n = len(text)
    for opposite in (False, True):
        suffixes = [[-x if opposite else x for x in text[i:]] for i in range(n)]
        order = sorted(range(n), key=lambda i: suffixes[i])
        assert sorted(range(n), key=tree.ranks(opposite).__getitem__) == order
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n + 1)]
    a, b = (np.array(side, np.int64) for side in zip(*pairs))

    def common(i, j):
        k = 0
        while j + k < n and text[i + k] == text[j + k]:
            k += 1
        return k

    assert tree.common(a, b).tolist() == [common(i, j) for i, j in pairs]


def test_next_smaller():
    assert next_smaller([2, 1, 3, 0]) == [1, 3, 3, 4]


CASES = [
    (1, "a a a a a a"),
    (2, "x  a b\ta b\na b a b y"),
    (3, None),
    (4, ""),
    (None, "b b b b b b b"),
    (1, "a a a a a a"),
    (5, "a b c " * 3),
    (6, " \n "),
    (7, "é é " * 6),
]


def test_cases(spark):
    """Ties of documents, nulls, spaces only, and white space beyond ASCII, which parts no words."""
    docs = spark.createDataFrame(
        [(d, t, {"k": 1}, "z") for d, t in CASES],
        "doc_id long, text string, `a.b` map<string,int>, runs string",
    )
    found = sorted(map(str, collapse_runs(docs).collect()))
    plain = []
    for doc_id, text in CASES:
        words = (text or "").encode().split()
        dropped = {i for s, n, p in plain_runs(words) for i in range(s + p, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()
        plain.append((doc_id, plain_runs(words), kept))
    assert sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in
                  collapse_runs(docs).collect()) == sorted((d or 0, r, k) for d, r, k in plain)
    assert len(found) == len(CASES)
    assert collapse_runs(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    text = "one two three " * 40_000 + "end"
    (row,) = collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(0, 120_000, 3)]
    assert row.collapsed == "one two three end"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    return (
        doc_id, len(runs), *best, milli,
        sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query(spark, tmp_path):
    """Short documents of the table, and nulls, by a plain version."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = spark.createDataFrame(
        [(-7, None), (-8, "")], "doc_id long, text string"
    )
    small = docs.filter("length(text) < 1500").select("doc_id", "text").unionByName(extra)
    small.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    plain = [expected(r.doc_id, r.text) for r in small.collect()]
    assert sorted(map(tuple, rows), key=str) == sorted(plain, key=str)
    assert sum(r.n_runs > 0 for r in rows) > 20


def test_adapter_keeps_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None)], "doc_id long, text string")
    assert sorted(map(str, samples.periodic_documents(docs).collect())) == sorted(
        map(str, docs.collect())
    )

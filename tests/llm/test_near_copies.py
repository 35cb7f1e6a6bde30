from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trafficlens.llm import simhash
from trafficlens.llm.arrow import word_blocks
from trafficlens.llm.components import components, group_roots


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not shingles:
        shingles = [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=2):
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for at, i in enumerate(ids):
        for j in ids[:at]:
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "One"),
    (5, "one"),
    (6, "É one"),
    (7, "a b c a b c a b c"),
    (8, "A\tB\x0bC  a b c a b c"),
    (9, "x" * 5000),
    (10, "word " * 3000),
]


def test_edge_texts(spark):
    found = simhash.near_copies(spark.createDataFrame(EDGE, "doc_id long, text string")).collect()
    prints = {i: plain_fingerprint(text) for i, text in EDGE}
    groups = plain_groups(prints)
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {
        i: f"{p:016x}" for i, p in prints.items()
    }
    assert {r["doc_id"]: r["component_id"] for r in found} == groups


def test_documents_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    found = simhash.near_copies(docs).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == prints
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_groups(prints)


def test_repeated_and_null_ids_keep_their_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(0))
    found = sorted(
        ((r["doc_id"], r["component_id"]) for r in simhash.near_copies(docs).collect()), key=str
    )
    assert found == [(5, 5), (5, 5), (None, 5), (None, None)]
    assert simhash.near_copies(docs.limit(0)).collect() == []


@pytest.mark.parametrize("segments, bucket", [(16, 2048), (16, 3), (8, 3), (4, 5)])
def test_links_of_a_dense_group(spark, segments, bucket):
    """Near fingerprints share keys; small buckets force every refinement."""
    rng = np.random.default_rng(4)
    prints = set()
    for base in rng.integers(0, 2**63, 4, dtype=np.uint64):
        for _ in range(40):
            prints.add(int(base) ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)))
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash.near_links(fps, segments=segments, bucket=bucket)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    brute = plain_groups({i: x for i, x in enumerate(np.array(signed).view(np.uint64).tolist())})
    mine: dict = {}
    for x in signed:
        mine.setdefault(found.get(x, x), set()).add(x)
    theirs: dict = {}
    for i, root in brute.items():
        theirs.setdefault(root, set()).add(signed[i])
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_pigeonring_keeps_every_near_pair():
    """Some chain start meets all budgets, for every pair within the distance."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        differ = sum(1 << int(b) for b in set(rng.integers(0, 64, 2)))
        assert any(
            all((differ & mask).bit_count() <= most for mask, most in chain)
            for chain in simhash.chains()
        )


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(7, 7)], "a long, b long")
    assert {r["root"] for r in components(edges).collect()} == {1}
    assert components(edges.limit(0)).collect() == []


def test_group_roots():
    near = np.zeros((5, 5), bool)
    near[0, 3] = near[3, 0] = near[3, 4] = near[4, 3] = True
    assert group_roots(near).tolist() == [0, 1, 2, 0, 0]


def test_long_texts_are_read_in_blocks():
    text = b"ab cde  f\tg " * 500
    assert [w for block in word_blocks(text, 64) for w in block] == text.split()
    parts = [h for block in simhash.shingle_hashes(text) for h in block]
    assert len(parts) == len(text.split()) - 2

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from trafficlens.llm import packing
from trafficlens.llm.queries import vocabulary

ODD = [
    "  a  b\n c ",
    "",
    "\n",
    " x",
    "it's we'll 12,5 §§ <|endoftext|> z<|endoftext|>",
    "tab\t tab \t",
    "é ü. ñ, ß!",
    "a .b ., ,",
    "日本語 テスト  x y \x1c z",
    "\N{PARTY POPPER} emoji  \n\n\n  x",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("size", [packing.BLOCK, 5])
def test_ids_are_the_tokenizers(tokenizer, monkeypatch, size):
    monkeypatch.setattr(packing.blocks, "__defaults__", (size,))
    encoder = packing.Encoder(vocabulary())
    for text in [*ODD, "The heed, ththnd on a. " * 50]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(tokenizer, text)


def smallest(sizes, capacity):
    """The least number of bins, by trying all ways."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(at, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if at == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= sizes[at] and bins[i] not in bins[:i]:
                place(at + 1, [*bins[:i], bins[i] - sizes[at], *bins[i + 1 :]])
        place(at + 1, [*bins, capacity - sizes[at]])

    place(0, [])
    return best


def check_plan(histogram, capacity):
    made = packing.plan(histogram, capacity)
    placed, bins = Counter(), defaultdict(list)
    ranks = defaultdict(list)
    for size, rank, count, sequence, offset in zip(
        made.length, made.rank, made.count, made.sequence, made.offset
    ):
        placed[size] += count
        ranks[size] += range(rank, rank + count)
        for i in range(count):
            bins[sequence + i].append((offset, size))
    assert placed == Counter(histogram) and set(bins) == set(range(made.sequences))
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    for held in bins.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= capacity
    return made


def test_reduction_never_costs_a_bin():
    rng = random.Random(3)
    for _ in range(400):
        capacity = rng.choice([10, 20, 50])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        histogram = dict(Counter(sizes))
        best = smallest(sizes, capacity)
        made = check_plan(histogram, capacity)
        assert best <= made.sequences <= best + 1
        packer = packing._Packer(dict(histogram), capacity)
        packer.reduce()
        rest = [size for size, n in packer.left.items() for _ in range(n)]
        assert packer.plan.sequences + (smallest(rest, capacity) if rest else 0) == best


def test_large_counts():
    histogram = {1024: 10**9, 600: 10**8, 424: 10**8 - 7, 300: 10**7, 5: 10**9}
    made = packing.plan(histogram)
    total = sum(size * n for size, n in histogram.items())
    assert len(made.length) < 2000 and made.sequences <= total // 1024 + 2 + 10**8 // 100


def test_documents(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = packing.pack(docs, vocabulary(), with_ids=True).toPandas()
    wanted = set()
    for row in docs.collect():
        held = [*ids(tokenizer, row["text"]), packing.END_ID]
        begin, stop = 0, (len(held) - 1) % 1024 + 1
        for piece in range(-(-len(held) // 1024)):
            data = np.array(held[begin:stop], "<u4").tobytes()
            wanted.add((row["doc_id"], piece, begin, stop - begin, zlib.crc32(data), data))
            begin, stop = stop, stop + 1024
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    found["ids"] = found["ids"].map(bytes)
    assert set(found[columns].itertuples(index=False, name=None)) == wanted
    for _, held in found.groupby("sequence_id"):
        held = held.sort_values("offset")
        assert held["offset"].tolist() == [0, *held["length"].cumsum().tolist()[:-1]]
        assert held["length"].sum() <= 1024
    assert found["sequence_id"].nunique() <= -(-found["length"].sum() // 1024) * 1.02 + 1


def test_nulls_repeats_and_no_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = packing.pack(docs, vocabulary()).collect()
    assert sorted(r["length"] for r in found) == [1, 1, 1, 3]
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 4
    assert packing.pack(docs.limit(0), vocabulary()).collect() == []

"""The stages on a small corpus with planted cases, and on awkward rows."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from trafficlens.llm import decontaminate
from trafficlens.session import staged

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, score int"
)
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.001"


def docs_of(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "k", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def prose(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = " ".join(r["text"] for r in docs.filter("lang = 'en'").collect()).split()
    rng = random.Random(8)
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


def texts(df):
    assert df.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_language_id(spark, sf_dir, prose):
    rows = [(i, prose(50)) for i in range(20)] + [(100, None), (101, ""), (102, "12 34 %")]
    kept = texts(STAGE["language_id"](spark, docs_of(spark, rows), sf_dir))
    assert kept == dict(rows[:20])


def test_near_duplicates(spark, sf_dir, prose):
    base = prose(3000)
    near = base + " changed"
    rows = [(1, prose(200)), (7, base), (5, near), (9, base), (9, base), (None, prose(99)), (None, base)]
    kept = texts(STAGE["near_duplicates"](spark, docs_of(spark, rows), sf_dir))
    assert set(kept) == {1, 5, None} and kept[5] == near and kept[None] == rows[5][1]


def test_repeated_passages(spark, sf_dir, prose):
    passage = prose(60)
    rows = [
        (1, prose(40) + " " + passage),
        (2, passage + " " + prose(40)),
        (3, passage),
        (4, ""),
        (5, None),
        (6, "é" * 60),
        (7, "xé" + "é" * 59 + "z" * 60),
    ]
    stage = STAGE["repeated_passages"](spark, docs_of(spark, rows), sf_dir)
    kept = texts(stage)
    assert kept[1] == rows[0][1] and kept[2].strip() == rows[1][1][len(passage) :].strip()
    assert 3 not in kept and kept[4] == "" and kept[5] is None
    assert kept[7] == "x" + "z" * 60
    assert all(r["n_chars"] == len(r["text"]) for r in stage.collect() if r["text"])


def test_benchmark_leaks(spark, sf_dir, prose):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    item = next(r["text"] for r in items if len(decontaminate.words_of(r["text"])) > 20)
    rows = [(1, prose(200)), (2, prose(50) + " " + item), (None, item), (None, prose(30))]
    kept = texts(STAGE["benchmark_leaks"](spark, docs_of(spark, rows), sf_dir))
    assert set(kept) == {1, None} and kept[None] == rows[3][1]


@pytest.mark.parametrize("filled", [True, False])
def test_awkward_rows_pass_every_stage(spark, sf_dir, prose, filled):
    rows = [(1, prose(3000)), (2, None), (3, ""), (4, prose(20)), (4, prose(20))] if filled else []
    docs = docs_of(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = staged(stage(spark, docs, sf_dir), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert docs.select("doc_id").distinct().count() == (2 if filled else 0)


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = corpus_pipeline.run(spark, sf_dir)
    assert set(r["doc_id"] for r in packed.collect()) < set(r["doc_id"] for r in docs.collect())

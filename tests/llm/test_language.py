from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.llm import language


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs, ~language.held_out(F.col("doc_id"), 4, 2))


def test_held_out_accuracy(docs, model):
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.filter(language.held_out(F.col("doc_id"), 4, 2)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark, model):
    rows = [
        (1, None),
        (2, ""),
        (3, "12 !"),
        (4, "привет мир"),
        (5, "the " * 50 + "de la que les une " * 50),
        (None, "the of and"),
        (7, "the of and that " * 20_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(9))
    found = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    for i in (1, 2, 3):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert (found[4]["lang_pred"], found[4]["score"]) == (model.languages[model.usual], 0.0)
    assert [s["lang"] for s in found[5]["spans"]] == ["en", "fr"]
    assert found[5]["spans"][1]["first_word"] == 50
    assert found[None]["lang_pred"] == found[7]["lang_pred"] == "en"
    assert language.identify(docs.limit(0), model).collect() == []


def test_without_training(spark, docs):
    untrained = language.fit(docs.limit(0), F.lit(True))
    found = language.identify(docs.limit(3), untrained).collect()
    assert {r["lang_pred"] for r in found} == {"und"}


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(24, 3)) * 5
    ends = np.array([0, 0, 7, 13, 14, 22, 24])
    labels = language.viterbi(scores, ends, 3.0)

    def value(path, low):
        return sum(scores[low + i, x] for i, x in enumerate(path)) - 3.0 * sum(
            x != y for x, y in zip(path, path[1:])
        )

    for low, high in zip(ends, ends[1:]):
        paths = product(range(3), repeat=high - low)
        best = max(value(path, low) for path in paths)
        assert value(tuple(labels[low:high]), low) == pytest.approx(best)


def test_held_out_without_id(spark):
    rows = spark.createDataFrame([(None,), (5,)], "doc_id long")
    folds = [language.held_out(F.col("doc_id"), 3, k).alias(str(k)) for k in range(3)]
    assert [sum(r) for r in rows.select(*folds).collect()] == [0, 1]

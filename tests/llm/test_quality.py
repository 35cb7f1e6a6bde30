from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trafficlens.llm import quality
from trafficlens.llm.language import held_out


@pytest.fixture(scope="module")
def tables(spark):
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    return (
        spark.read.parquet(f"{at}/documents.parquet"),
        labels.select("doc_id", F.col("quality").alias("label")),
    )


def test_held_out_accuracy(tables):
    docs, labels = tables
    fold = held_out(F.col("doc_id"), 3, 1)
    scored = quality.score(docs, labels, ~fold)
    assert scored.count() == docs.count()
    rows = scored.filter(fold).join(labels, "doc_id").collect()
    right = sum((r["score"] >= 0.5) == (r["label"] == 1) for r in rows)
    usual = max(sum(r["label"] for r in rows), sum(1 - r["label"] for r in rows))
    assert right / len(rows) > 0.95 and right > usual
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_statistics_of_plain_and_empty_texts(spark):
    rows = [(1, None), (2, ""), (3, "Aé a a!\nx#9\n\nx#9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("symbols", F.lit(5))
    found = {r["doc_id"]: r.asDict() for r in quality.measure(docs).collect()}
    assert all(found[i][name] == 0 for i in (1, 2) for name in quality.STATISTICS)
    assert found[3]["symbols"] == 2 / 16 and found[3]["digits"] == 2 / 16
    assert found[3]["capitals"] == 1 / 16 and found[3]["cries"] == 1 / 16
    assert found[3]["repeated_lines"] == pytest.approx(1 / 3)
    assert set(quality.STATISTICS) == set(quality.statistics(F.lit("")))


def test_rules_from_a_printed_tree():
    printed = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5
  If (feature 0 <= 1.5)
   If (feature 2 <= -3.0E-4)
    Predict: 0.0
   Else (feature 2 > -3.0E-4)
    Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 1.0
"""
    a, c = quality.STATISTICS[0], quality.STATISTICS[2]
    inf = float("inf")
    assert quality.tree_rules(printed) == {
        ((a, -inf, 1.5),),
        ((a, -inf, 1.5), (c, -inf, -3e-4)),
        ((a, -inf, 1.5), (c, -3e-4, inf)),
        ((a, 1.5, inf),),
    }


def test_labels_of_one_kind_or_none(spark, tables):
    docs, labels = tables
    few = docs.limit(5)
    assert {r["score"] for r in quality.score(few, labels.limit(0), F.lit(True)).collect()} == {0.5}
    ones = docs.limit(3).select("doc_id", F.lit(1).alias("label"))
    got = {r["score"] for r in quality.score(docs.limit(3), ones, F.lit(True)).collect()}
    assert len(got) == 1 and got.pop() == pytest.approx(0.8)
    assert quality.score(docs.limit(0), labels, F.lit(True)).collect() == []


def test_repeated_and_null_labels(spark):
    rows = [(1, "a"), (1, "a"), (None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, None), (None, 0)], "doc_id long, label int")
    found = quality.score(docs, labels, F.lit(True)).collect()
    assert len(found) == 3 and all(r["score"] > 0.5 for r in found)

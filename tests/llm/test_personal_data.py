"""Base spans against a plain reading, trees against their printed form, added spans."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from trafficlens.llm import personal_data
from trafficlens.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string"


def luhn(digits):
    values = [int(c) * (1 + at % 2) for at, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = []
    for at, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                found.append((m.start(), at, m.end()))
    return sorted(found)


TEXTS = [
    None,
    "",
    "no numbers",
    "a@b.c_x@d.e and .@x.y.z. q@@r.s é😀 me%1@h-1.example.com.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.00.1 01.2.3 4.5.6.7.",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 4111111111111111",
    "+1 (017) 555-7713 ( +12 3 +49 (0) 30.123-45 +1234567890123456 +1+2 345 678 901",
    "+4111111111111111 x",
    "0" * 30 + ".1.2.3 " + "1.1.1.1" * 3,
]


def test_base_spans_against_a_plain_reading(spark):
    rows = [(i, text) for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r["doc_id"]: r for r in personal_data.find(docs, personal_data.Model()).collect()}
    for i, text in rows:
        assert sorted(map(tuple, found[i]["base"])) == plain_spans(text), text
        assert found[i]["added"] == []


def test_query(spark):
    at = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{at}/documents.parquet").collect()}
    rows = QUERIES["op11_personal_data"](spark, at).collect()
    assert len(rows) == len(texts) and sum(r["n_email"] for r in rows)
    for row in rows:
        base = plain_spans(texts[row["doc_id"]])
        told = [f"{personal_data.KINDS[k]}:{start}:{stop}" for start, k, stop in base]
        assert row["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        counts = [sum(k == at for _, k, _ in base) for at in range(4)]
        assert [row[f"n_{kind}"] for kind in personal_data.KINDS] == counts
        assert set(told) <= set(row["spans"].split(","))


def test_very_long_texts(spark):
    texts = ["7" * 300_000, "a." * 200_000, "1.1" * 100_000, "a@b.c " * 30_000, "+1((" * 50_000, " 1" * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = {r["doc_id"]: r["base"] for r in personal_data.find(docs, personal_data.Model()).collect()}
    assert [s["start"] for s in found[3]] == list(range(0, 180_000, 6))
    assert not found[0] and not found[1] and not found[4]


def test_disguised_spans_are_added(spark):
    """Learned from plain addresses, found in another form; decoys stay out."""
    plain = [(i, f"Write to user{i}.x@mail{i % 9}.example.com for more of it") for i in range(400)]
    cards = [(1000 + i, f"order {i * 7919 % 100000:05d}{i:07d} of goods {i}.{i}") for i in range(400)]
    hidden = [(5000, "Write to user7.y at mail3 dot example dot com for more of it"), (5001, "version 3.4.5")]
    found = personal_data.redact(spark.createDataFrame(plain + cards + hidden, SCHEMA)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert [(s["start"], s["kind"], s["stop"]) for s in by_id[5000]["added"]] == [(9, 0, 45)]
    assert by_id[5001]["added"] == []
    assert all(len(r["base"]) + len(r["added"]) == len(r["spans"]) for r in found)


def test_repeated_rows_ties_and_extra_columns(spark):
    rows = [(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"), (2, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("rest", "found", "pieces", "spans", "base"):
        docs = docs.withColumn(name, F.create_map(F.lit("k"), F.lit(name)))
    found = personal_data.find(docs).collect()
    assert sorted(len(r["base"]) for r in found) == [0, 1, 1, 1]
    assert personal_data.find(docs.limit(0)).collect() == []


def test_tree_from_its_printed_form(spark):
    printed = """DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=19
  If (feature 0 <= 1.5)
   If (feature 2 <= -3.0E-4)
    Predict: -1.0
   Else (feature 2 > -3.0E-4)
    Predict: 0.25
  Else (feature 0 > 1.5)
   Predict: 1.0
"""
    tree = personal_data.parse_tree(printed)
    assert tree == (0, 1.5, (2, -3e-4, -1.0, 0.25), 1.0)
    values = [([1.0, 0.0, -1.0], -1.0), ([1.0, 0.0, 0.0], 0.25), ([2.0, 0.0, 0.0], 1.0)]
    rows = spark.createDataFrame(values, "f array<double>, want double")
    assert rows.filter(personal_data.tree_column(tree, F.col("f")) != F.col("want")).count() == 0


def test_thresholds_hold_their_precision():
    counts = [(0, 199, 40, 40), (0, 150, 30, 40), (0, 120, 0, 60), (1, 199, 5, 5), (2, 180, 10, 60)]
    found = personal_data._thresholds(counts, 0.85)
    # 71 of 82 hold down to the step that spoils them; the others have too few, or too many wrong.
    assert found == {0: 0.605}


def test_plan_has_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = personal_data.gather(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan

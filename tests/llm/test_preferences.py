from __future__ import annotations

import re

from trafficlens.llm import preferences

SCHEMA = "pair_id long, side string, turn long, role string, text string"


def formatted(spark, rows):
    messages = spark.createDataFrame(rows, SCHEMA)
    return {r["pair_id"]: r for r in preferences.format_pairs(messages).collect()}


def say(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def test_prefix_completions_and_spans(spark):
    rows = []
    for side, last in (("chosen", "good é"), ("rejected", "bad")):
        rows += [
            (1, side, 0, "user", "hi"),
            (1, side, 1, "assistant", "hello"),
            (1, side, 2, "user", "more"),
            (1, side, 3, "assistant", last),
            (1, side, 4, "user", "thanks"),
        ]
    row = formatted(spark, rows)[1]
    assert row["prompt"] == say("user", "hi") + say("assistant", "hello") + say("user", "more")
    assert row["prompt_messages"] == 3
    assert row["chosen"] == say("assistant", "good é") + say("user", "thanks")
    (span,) = row["chosen_train"]
    assert row["chosen"][span["start"] : span["end"]] == "good é<|end|>"
    (span,) = row["rejected_train"]
    assert row["rejected"][span["start"] : span["end"]] == "bad<|end|>"


def test_a_later_equal_turn_is_no_prefix(spark):
    rows = [
        (1, "chosen", 0, "user", "a"),
        (1, "rejected", 0, "user", "b"),
        (1, "chosen", 1, "assistant", "same"),
        (1, "rejected", 1, "assistant", "same"),
    ]
    row = formatted(spark, rows)[1]
    assert row["prompt"] == "" and row["chosen"].endswith(say("assistant", "same"))


def test_edges(spark):
    rows = [
        (1, "chosen", 0, "user", "alone"),
        (2, "chosen", 0, "user", "same"),
        (2, "rejected", 0, "user", "same"),
        (3, "chosen", None, None, None),
        (3, "rejected", None, None, None),
        (3, "chosen", 1, "user", ""),
        (4, "chosen", 0, "user", "twice"),
        (4, "chosen", 0, "user", "twice"),
        (4, "rejected", 0, "user", "twice"),
        (None, "chosen", 0, "user", "x"),
        (5, "neither", 0, "user", "x"),
        (6, "chosen", 0, "assistant", "x" * 100_000),
        (6, "rejected", 0, "assistant", "y"),
    ]
    found = formatted(spark, rows)
    assert set(found) == {1, 2, 3, 4, 6}
    assert (found[1]["prompt"], found[1]["rejected"]) == ("", None)
    assert (found[2]["prompt"], found[2]["chosen"]) == (say("user", "same"), "")
    assert found[3]["prompt"] == say("unknown", "") and found[3]["chosen"] == say("user", "")
    assert found[4]["chosen"] == say("user", "twice") * 2 and found[4]["prompt"] == ""
    assert len(found[6]["chosen"]) > 100_000
    assert formatted(spark, rows[:0] or [(None, None, None, None, None)]) == {}


def test_native_plan(spark):
    messages = spark.createDataFrame([], SCHEMA)
    plan = preferences.format_pairs(messages)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)

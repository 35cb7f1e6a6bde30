"""Cheapest repairs against a plain search over all places, and the query's contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trafficlens.llm import samples
from trafficlens.llm.conversation_repair import audit, cheapest_edits, digests, repair
from trafficlens.llm.queries import QUERIES

BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
FORM = re.compile(r"(s?(ua)+)?\Z")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def faults_of(rows):
    found, seen = [], set()
    for role, text in rows:
        shown = text.rstrip(" \t\n\v\f\r")
        if BLANK.match(text):
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if shown[-1] not in ".!?" else "sound")
        seen.add((role, text))
    return found


def least(rows, faults):
    """Cost, audit and messages of the cheapest edits: all ways, place by place, where of
    the ways to the same roles only the best matters (what may follow depends on the last)."""
    ways = {"": (0, "", ())}

    def insertions(ways):
        out = dict(ways)
        for _ in range(4):
            for q, (cost, edits, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    put(out, q, role, cost + 3, edits + "I", (*lines, f"{role}:"))
        return out

    def put(out, q, role, cost, edits, lines):
        to = role[:1]
        if (q, to) not in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
            return
        if to not in out or (cost, edits) < out[to][:2]:
            out[to] = (cost, edits, lines)

    for (role, text), fault in zip(rows, faults):
        ways, before = {}, insertions(ways)
        for q, (cost, edits, lines) in before.items():
            best = (cost + 4, edits + "D", lines)
            if q not in ways or best[:2] < ways[q][:2]:
                ways[q] = best
            if fault in ("sound", "truncated"):
                more = 3 if fault == "truncated" else 0
                put(ways, q, role, cost + more, edits + "K", (*lines, f"{role}:{text}"))
                for name in ("user", "assistant"):
                    line = f"{name}:{text}"
                    put(ways, q, name, cost + more + 3, edits + "R", (*lines, line))
    return min((w for q, w in insertions(ways).items() if q in ("", "a")), key=lambda w: w[:2])


INITIALS = {"s": 1, "u": 2, "a": 3}
FAULTS = {"sound": 0, "blank": 1, "duplicate": 2, "truncated": 3}
row = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", " "]), st.sampled_from(list(FAULTS)))


@settings(max_examples=500, deadline=None)
@given(st.lists(row, max_size=12))
def test_search_equals_a_plain_one(found):
    rows = [(role, "x") for role, _ in found]
    faults = [fault for _, fault in found]
    cost, edits, lines = least(rows, faults)
    places = [(INITIALS.get(role[:1], 0), FAULTS[fault]) for role, fault in found]
    assert cheapest_edits(places) == (cost, edits)
    assert FORM.match("".join(line[0] for line in lines))


def test_long_conversation_in_bounded_states():
    rng = random.Random(3)
    rows = [(rng.randrange(4), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(30_000)]
    cost, edits = cheapest_edits(rows)
    assert sum(edits.count(e) for e in "KRD") == len(rows)
    assert cost >= 4 * sum(fault in (1, 2) for _, fault in rows)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def expected(rows):
    """The contract, conversation by conversation."""
    told = damaged(rows)
    for conv in dict.fromkeys(r[0] for r in rows):
        mine = [r[1:] for r in told if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        said = [r[1:] for r in mine]
        faults = faults_of(said)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:])]
        cost, edits, lines = least(said, faults)
        yield (
            conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, sha("\n".join(lines)),
        )


SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
]


@pytest.mark.parametrize("seed", [1, 2])
def test_query(spark, tmp_path, seed):
    """Nulls, ties, repeated rows, unknown roles and emptied conversations."""
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "", " \t\n", "cut", "Why? ", "é. ", None, "Yes."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [
        (
            rng.choice([None, *range(-2, 60)]), rng.choice([None, *range(8)]),
            rng.choice(roles), rng.choice(texts),
        )
        for _ in range(500)
    ]
    rows += [(1000 + i, 0, "user", "Alone.") for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.selectExpr("*", "'x' as audit", "1 as fault", "map(1, 2) as cost").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    found = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert found.columns[: len(COLUMNS)] == COLUMNS
    ours = sorted(map(tuple, found.collect()), key=str)
    assert ours == sorted(expected(rows), key=str)
    assert any(r[7] == "" for r in ours)


def test_operator_writes_the_messages(spark):
    said = [(7, 0, "assistant", "Hello."), (7, 1, "user", "Hi."), (7, 1, "user", "Hi."), (7, 3, "user", "So?")]
    messages = spark.createDataFrame(said, SCHEMA)
    audits = audit(messages)
    [told] = audits.collect()
    # A question before the first answer, the copy goes, the last row becomes an answer.
    assert (told.gaps, told.duplicate, told.illegal) == (1, 1, 2)
    assert (told.cost, told.audit) == (3 + 4 + 3, "IKKDR")
    out = [(r.edit, r.role, r.text) for r in repair(messages, audits).orderBy("place").collect()]
    assert FORM.match("".join(role[0] for _, role, _ in out))
    assert [e for e, _, _ in out] == [e for e in told.audit if e != "D"]
    [sums] = digests(repair(messages, audits)).collect()
    assert sums.sha256 == sha("\n".join(f"{role}:{text}" for _, role, text in out))


def test_very_long_and_no_messages(spark):
    long = "word " * 400_000 + "."
    messages = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], SCHEMA)
    [told] = audit(messages).collect()
    assert (told.cost, told.audit) == (0, "KK")
    none = messages.limit(0)
    assert audit(none).count() == 0
    assert repair(none, audit(none)).count() == 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op12_conversation_repair"](spark, str(tmp_path)).count() == 0
    assert samples.damaged_messages(spark.createDataFrame([], SCHEMA)).count() == 0

"""Conversations audited and repaired by the cheapest edits.

Messages are rows of a conversation in the order of their turn (nulls first; ties
by role, then a digest of the text).  A message is blank without a character that
is no ASCII white space, else a duplicate if its role and text occurred earlier,
else truncated if its last such character is none of ``. ! ?``.  A null role or
text is one space.

A repaired conversation is empty, or an optional system message followed by turns
of user and assistant.  A row is kept (K, free), gets role user or assistant (R, 3)
or is deleted (D, 4), as blank and duplicate rows must be; an empty message is
inserted (I, 3).  A truncated row that stays costs 3 more.  Roles count by their
initial; one other than s, u and a, or none, cannot be kept.

The audit lists the cheapest edits, of several the least in ASCII order.  It is
found by iterative deepening A*: depth-first search in ASCII order of the edits
under a cost bound, the least estimate beyond it being the next bound.  The
estimate lets a conversation end after any role, so it falls short by an
insertion or so; a table holds the greatest budget a state (row, role before) failed
with.  The first path that ends well is the answer.

Equal rows are combined before they are dealt out, and a search sees one byte for a
row.  Texts stream past the finished audit and are not gathered.  A conversation
is searched and written in one task, one record however it grows.  Conversations
are told apart by ``conv_id``, null being one; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.arrow import small_batches

# Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# ASCII white space, and marks that end a message.
SPACE = " \t\n\x0b\x0c\r"
MARKS = ".!?"

# Faults of a row, in the order in which they count.
SOUND, BLANK, DUPLICATE, SHORT = range(4)
# The role before a place; a conversation may end at the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# The role a message gets if it is renamed or inserted after another.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = ("", "system", "user", "assistant")

# A row of a search: its role (START if it has none to keep) and its fault.
Row = tuple[int, int]


def follows(before: int, role: int) -> bool:
    """Whether a role may come after another (START: at the beginning)."""
    return role == NEXT[before] or (before == START and role == SYSTEM)


def estimates(rows: list[Row]) -> list[tuple[int, ...]]:
    """Least cost from each row on after each role, if any role may be the last."""
    after = (0, 0, 0, 0)
    found = [after]
    for role, fault in reversed(rows):
        kept = TRUNCATED if fault == SHORT else 0
        stay = fault in (SOUND, SHORT)
        base = []
        for before in range(4):
            cost = DELETE + after[before]
            if stay:
                cost = min(cost, RENAME + kept + after[NEXT[before]])
                if follows(before, role):
                    cost = min(cost, kept + after[role])
            base.append(cost)
        # A second insertion leads to a place that is no better than the first one.
        after = tuple(min(base[q], INSERT + base[NEXT[q]]) for q in range(4))
        found.append(after)
    return found[::-1]


def cheapest_edits(rows: list[Row]) -> tuple[int, str]:
    """Cost and audit of a conversation."""
    least = estimates(rows)
    bound = least[0][START]
    while True:
        audit, beyond = _within(rows, least, bound)
        if audit is not None:
            return bound, audit
        bound = beyond


def _within(
    rows: list[Row], least: list[tuple[int, ...]], bound: int
) -> tuple[str | None, int]:
    """The first audit of at most a cost, or the next cost to try."""
    n = len(rows)
    beyond = INSERT + bound
    failed: dict[int, int] = {}
    path: list[str] = []
    # Row, role before, cost so far, edits still to try (the next one last).
    stack = [(0, START, 0, ["R", "K", "I", "D"])]
    while stack:
        i, before, spent, edits = stack[-1]
        if i == n and before in (START, ASSISTANT):
            return "".join(path), bound
        if not edits:
            stack.pop()
            if path:
                path.pop()
            failed[4 * i + before] = bound - spent
            continue
        edit = edits.pop()
        if edit == "I":
            to, after, cost = i, NEXT[before], spent + INSERT
        elif i == n:
            continue
        elif edit == "D":
            to, after, cost = i + 1, before, spent + DELETE
        else:
            role, fault = rows[i]
            if fault in (BLANK, DUPLICATE) or (edit == "K" and not follows(before, role)):
                continue
            to = i + 1
            after = role if edit == "K" else NEXT[before]
            cost = spent + (RENAME if edit == "R" else 0) + (TRUNCATED if fault == SHORT else 0)
        if cost + least[to][after] > bound:
            beyond = min(beyond, cost + least[to][after])
        elif failed.get(4 * to + after, -1) < bound - cost:
            stack.append((to, after, cost, ["R", "K", "I", "D"]))
            path.append(edit)
    return None, beyond


class _Conversation:
    """Rows of one conversation as they arrive."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.rows: list[Row] = []
        self.seen: set[tuple[str, bytes]] = set()
        self.first: int | None = None
        self.last: int | None = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, role: str, digest: bytes, fault: int, times: int) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.last = turn
            self.first = turn if self.first is None else self.first
        place = INITIALS.get(role[:1], START)
        again = (role, digest) in self.seen
        self.seen.add((role, digest))
        if fault != BLANK and again:
            fault = DUPLICATE
        if self.rows:
            self.illegal += self._clashes(self.rows[-1][0], place)
        self.illegal += (times - 1) * self._clashes(place, place)
        self.rows.append((place, fault))
        self.rows += [(place, fault if fault == BLANK else DUPLICATE)] * (times - 1)

    @staticmethod
    def _clashes(before: int, role: int) -> bool:
        return before == START or role == START or not follows(before, role)

    def result(self) -> tuple:
        cost, audit = cheapest_edits(self.rows)
        faults = [fault for _, fault in self.rows]
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        counts = [faults.count(kind) for kind in (BLANK, DUPLICATE, SHORT)]
        return (self.conv_id, gaps, *counts, self.illegal, cost, audit)


AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)
_COUNTS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _audited(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found))
    arrays = [pa.array(column, pa.int64()) for column in columns[:-1]]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(columns[-1], pa.string())], [*_COUNTS, "audit"]
    )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Conversation | None = None
    for batch in batches:
        found = []
        names = ("conv_id", "turn", "role", "digest", "fault", "times")
        for conv_id, *row in zip(*(batch.column(name).to_pylist() for name in names)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    found.append(now.result())
                now = _Conversation(conv_id)
            now.add(*row)
        if found:
            yield _audited(found)
    if now is not None:
        yield _audited([now.result()])


def _messages(messages: DataFrame) -> DataFrame:
    """The rows with defaults for nulls, and a digest that orders ties."""
    return messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def audit(messages: DataFrame) -> DataFrame:
    """Per conversation the number of missing turns between its first and last
    (``gaps``), of faulty rows by kind, of neighbours whose roles may not follow one
    another (``illegal``), and the ``cost`` and ``audit`` of the cheapest repair."""
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    fault = F.when(end == "", BLANK).when(~end.isin(*MARKS), SHORT).otherwise(SOUND)
    rows = (
        _messages(messages)
        .groupBy("conv_id", "turn", "role", "digest")
        .agg(F.first(fault).alias("fault"), F.count(F.lit(1)).alias("times"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    )
    return small_batches(rows).mapInArrow(_search, AUDIT)


REPAIRED = "conv_id long, place long, edit string, role string, text string"


class _Writer:
    """Applies an audit to the rows of its conversation."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit = conv_id, audit
        self.at = self.place = 0
        self.before = START

    def _put(self, edit: str, role: int, name: str, text: str) -> tuple:
        self.before = role
        self.place += 1
        return (self.conv_id, self.place - 1, edit, name, text)

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            role = NEXT[self.before]
            yield self._put("I", role, NAMES[role], "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._put(edit, INITIALS[role[0]], role, text)
        elif edit == "R":
            to = NEXT[self.before]
            yield self._put(edit, to, NAMES[to], text)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Writer | None = None
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "place", "edit", "role", "text"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], names
        )

    for batch in batches:
        rows: list[tuple] = []
        fields = (batch.column(name).to_pylist() for name in ("conv_id", "audit", "role", "text"))
        for conv_id, edits, role, text in zip(*fields):
            if edits is not None:
                if now is not None:
                    rows += now.inserted()
                now = _Writer(conv_id, edits)
            else:
                rows += now.row(role, text)
        yield batch_of(rows)
    if now is not None:
        yield batch_of(list(now.inserted()))


def repair(messages: DataFrame, audits: DataFrame) -> DataFrame:
    """The messages after the edits of their conversation's audit: ``place`` from 0,
    the ``edit`` each is due to, ``role`` and ``text``.

    Rows of a conversation are neighbours in one partition, in order.
    """
    edits = audits.select("conv_id", "audit")
    rows = (
        _messages(messages)
        .unionByName(edits, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions(
            "conv_id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest"
        )
        .select("conv_id", "audit", "role", "text")
    )
    return small_batches(rows).mapInArrow(_write, REPAIRED)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, held = None, None
    names = ["conv_id", "sha256"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        ids, sums = zip(*rows) if rows else ([], [])
        arrays = [pa.array(ids, pa.int64()), pa.array(sums, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        rows = []
        fields = (batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))
        for conv_id, role, text in zip(*fields):
            if held is None or now != conv_id:
                if held is not None:
                    rows.append((now, held.hexdigest()))
                now, held = conv_id, hashlib.sha256()
            else:
                held.update(b"\n")
            held.update(f"{role}:{text}".encode())
        yield batch_of(rows)
    if held is not None:
        yield batch_of([(now, held.hexdigest())])


def digests(repaired: DataFrame) -> DataFrame:
    """The checksum of ``role:text`` lines of every conversation that has messages
    left, from the result of :func:`repair`, whose order it relies on."""
    return repaired.mapInArrow(_hash, "conv_id long, sha256 string")

"""Packing documents into sequences of bounded length.

Documents become token ids; longer ones are cut so that all pieces but the
first are full.  Piece lengths are whole numbers up to the capacity, so an
instance of bin packing is its histogram of at most ``capacity`` counts, however
many pieces there are.  On it the plan is made:

* Martello-Toth dominance reduction: a set of at most three lengths that
  dominates every other set with its largest member is fixed, for as many copies
  as there are, until nothing is dominated;
* best fit decreasing for the rest, with bins of equal free space handled
  together.

The plan says which ranks of a length go to which range of sequences.  Pieces
are ranked within a length by counts per input partition, so no length, however
frequent, is sorted or gathered in one task.

Null text is empty: its one piece is the end token.  Rows of a repeated or null
``doc_id`` are packed as rows of their own.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trafficlens.llm.arrow import small_batches
from trafficlens.session import staged

CAPACITY = 1024
END_ID = 2
BLOCK = 1 << 21

# Fixed value: how byte-level vocabularies of this kind cut text into words.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Before a space here two of the tokenizer's words always meet.
_BORDER = re.compile(r"(?<=\S) (?=\S)")


# -- tokens ------------------------------------------------------------------


def _byte_of() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others, in order, for the
    characters from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """Token ids of texts under a byte-level vocabulary file.

    Merging goes by rank with the file's own vocabulary, which gives the ids of
    its tokenizer three times as fast; a text with one of the file's added
    tokens is left to the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        self._added = [token["content"] for token in held["added_tokens"]]
        byte = _byte_of()
        ranks = {
            bytes(byte[c] for c in token): rank
            for token, rank in held["model"]["vocab"].items()
            if token not in self._added
        }
        self._merges = tiktoken.Encoding(
            "words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}
        )
        self._tokenizer = None

    def _whole(self, text: str) -> list[int]:
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit numbers; a long text block by block."""
        if any(token in text for token in self._added):
            return np.array(self._whole(text), "<u4").tobytes()
        encode = self._merges.encode_ordinary
        return b"".join(array("I", encode(part)).tobytes() for part in blocks(text))


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """A long text cut where the tokenizer cuts too, before a space between words."""
    start = 0
    while len(text) - start > size:
        border = _BORDER.search(text, start + size)
        if border is None:
            break
        yield text[start : border.start()]
        start = border.start()
    yield text[start:]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            columns: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(doc_ids, batch.column("text").to_pylist()):
                ids = encoder.encode(text or "") + last
                total = len(ids) // 4
                begin, stop = 0, (total - 1) % capacity + 1
                for piece in range(-(-total // capacity)):
                    held = ids[4 * begin : 4 * stop]
                    kept = held if with_ids else None
                    values = (doc_id, piece, begin, stop - begin, zlib.crc32(held), kept)
                    for column, value in zip(columns, values):
                        column.append(value)
                    begin, stop = stop, stop + capacity
            lengths = np.array(columns[3], np.int64)
            order = np.argsort(lengths, kind="stable")
            in_order = lengths[order]
            first = np.searchsorted(in_order, in_order)
            nth = np.empty(len(lengths), np.int64)
            nth[order] = np.arange(len(lengths)) - first + seen[in_order]
            seen += np.bincount(lengths, minlength=capacity + 1)
            arrays = [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int32()),
                *[pa.array(column, pa.int64()) for column in columns[2:5]],
                pa.array(np.full(len(lengths), part, np.int64)),
                pa.array(nth),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids, and their number ``nth`` among those of
    one length in the input partition ``part``; on request the ids themselves."""
    texts = small_batches(docs.select(F.col("doc_id").cast("long"), "text"))
    return texts.mapInArrow(
        _cut(tokenizer, capacity, end_id, with_ids),
        f"{_PIECE}, part long, nth long" + ", ids binary" * with_ids,
    )


# -- plan --------------------------------------------------------------------


@dataclass
class Plan:
    """Ranks ``rank`` on of a length go to sequences ``sequence`` on, at ``offset``."""

    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    count: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0
    reduced: int = 0


class _Packer:
    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {size: n for size, n in histogram.items() if n > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.plan = Plan()

    def put(self, size: int, count: int, sequence: int, offset: int) -> None:
        plan = self.plan
        plan.length.append(size)
        plan.rank.append(self.used[size])
        plan.count.append(count)
        plan.sequence.append(sequence)
        plan.offset.append(offset)
        self.used[size] += count
        self.left[size] -= count
        if not self.left[size]:
            del self.left[size]

    def dominating(self, size: int) -> list[int] | None:
        """A set of lengths with ``size`` that dominates all others with it, or None."""
        room = self.capacity - size
        others = dict(self.left)
        others[size] -= 1
        fits = sorted(s for s, n in others.items() if n and s <= room)
        if not fits:
            return [size]
        best = fits[-1]
        if best == room:
            return [size, best]

        def smallest(k: int) -> int:
            """Sum of the k smallest others, beyond the room if there are fewer."""
            total = 0
            for s in fits:
                take = min(k, others[s])
                total, k = total + take * s, k - take
                if not k:
                    return total
            return room + 1

        if smallest(2) > room:
            return [size, best]
        if smallest(3) <= room:
            return None
        # At most two others fit: the best single one and what fits beside it
        # dominate unless two larger than the latter fit and exceed the former.
        others[best] -= 1
        beside = [s for s in fits if others[s] and s <= room - best]
        others[best] += 1
        if not beside:
            return None
        second = beside[-1]
        larger = [s for s in fits if s > second]
        high = len(larger) - 1
        for low, s in enumerate(larger):
            while high >= low and s + larger[high] > room:
                high -= 1
            if high < low:
                break
            if high == low and others[s] < 2:
                continue
            if s + larger[high] > best:
                return None
        return [size, best, second]

    def reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for size in sorted(self.left, reverse=True):
                while size in self.left:
                    chosen = self.dominating(size)
                    if chosen is None:
                        break
                    times = min(self.left[s] // chosen.count(s) for s in chosen)
                    offset = 0
                    for s in chosen:
                        self.put(s, times, self.plan.sequences, offset)
                        offset += s
                    self.plan.sequences += times
                    self.plan.reduced += times * len(chosen)
                    changed = True

    def best_fit(self) -> None:
        free: dict[int, list[tuple[int, int]]] = {}  # free space: ranges of sequences
        for size in sorted(self.left, reverse=True):
            while size in self.left:
                room = min((r for r in free if r >= size), default=None)
                if room is None:
                    room, each = self.capacity, self.capacity // size
                    start, many = self.plan.sequences, -(-self.left[size] // each)
                    self.plan.sequences += many
                else:
                    start, many = free[room].pop()
                    if not free[room]:
                        del free[room]
                each = min(room // size, self.left[size])
                full = min(many, self.left[size] // each)
                for nth in range(each):
                    self.put(size, full, start, self.capacity - room + nth * size)
                free.setdefault(room - each * size, []).append((start, full))
                if full < many:
                    free.setdefault(room, []).append((start + full, many - full))
            free.pop(0, None)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Which lengths go together, from the number of pieces of each length."""
    packer = _Packer(histogram, capacity)
    packer.reduce()
    packer.best_fit()
    return packer.plan


def _assign(made: Plan):
    order = np.lexsort((made.rank, made.length))
    length, rank, sequence, offset = (
        np.array(x, np.int64)[order]
        for x in (made.length, made.rank, made.sequence, made.offset)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One ascending key for (length, rank): ranks of a length lie together.
        starts = np.searchsorted(length, np.arange(length[-1] + 2) if len(length) else [0])
        for batch in batches:
            size = batch.column("length").to_numpy()
            nth = batch.column("rank").to_numpy()
            at = np.empty(len(size), np.int64)
            for value in np.unique(size):
                low, high = starts[value], starts[value + 1]
                mine = size == value
                at[mine] = low + np.searchsorted(rank[low:high], nth[mine], "right") - 1
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(sequence[at] + nth - rank[at]),
                    pa.array(offset[at]),
                ],
                [*names, "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset``; on request ``ids``, little-endian 32-bit."""
    cut = staged(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    histogram = {
        r["length"]: r["n"]
        for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    extra = ["ids"] if with_ids else []
    ranked = cut.join(base, ["length", "part"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        *extra,
        (F.col("base") + F.col("nth")).alias("rank"),
    )
    return ranked.mapInArrow(
        _assign(plan(histogram, capacity)),
        _PIECE + ", ids binary" * with_ids + ", sequence_id long, offset long",
    )

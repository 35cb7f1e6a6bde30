"""Periodic runs of words, found with suffix trees, and texts without them.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``SHORTEST`` words and ``TIMES`` periods long, that no
neighbouring word extends.  Every run holds a Lyndon root: a period of it that is
the longest Lyndon word from its place on, in the order of words or in the
opposite order.  Such words end at the next smaller suffix, and suffixes are
ranked by the leaves of a suffix tree, so each word gives two candidates.  A
candidate is extended to the right by the longest common extension of its two
ends, read from the tree as the depth of a lowest common ancestor (least depth
between two leaves on the Euler tour, by a sparse table), and to the left by the
same on the tree of the reversal.  Both trees are built by Ukkonen's algorithm.

Trees are built only where a run may be: behind its first period every word of a
run has occurred within the last q words, so stretches are parted at words that
have not occurred within a third of the stretch, until nothing changes.  That
loses no run and leaves ordinary prose without trees.

A document is one record and is handled in one task; its trees take about a
kilobyte for each word of a stretch.  Null text is empty and has no words.  Rows
that repeat a ``doc_id`` are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trafficlens.llm.arrow import small_batches

SHORTEST = 6
TIMES = 4

Run = tuple[int, int, int]  # start, length, period


class SuffixTree:
    """The suffix tree of whole numbers from 1 on; 0 is put behind them."""

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.size = max(self.text) + 1
        self._build()
        self._tour()

    def _build(self) -> None:
        """Ukkonen: suffixes are added word by word at the active point."""
        text, size = self.text, self.size
        first, stop, link = [0], [0], [0]
        edges: dict[int, int] = {}
        node = place = length = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    place = i
                key = node * size + text[place]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(first)
                    first.append(i)
                    stop.append(len(text))
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = first[child]
                    span = min(stop[child], i + 1) - begin
                    if length >= span:
                        node = child
                        place += span
                        length -= span
                        continue
                    if text[begin + length] == symbol:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    middle = len(first)
                    first += (begin, i)
                    stop += (begin + length, len(text))
                    link += (0, 0)
                    edges[key] = middle
                    edges[middle * size + symbol] = middle + 1
                    first[child] = begin + length
                    edges[middle * size + text[begin + length]] = child
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    place = i - waiting + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        self.parent, self.symbol = keys // size, keys % size
        self.span = np.array(stop) - np.array(first)

    def _children(self, opposite: bool) -> tuple[list[int], list[int]]:
        """Children in the order of their symbols, and where each node's begin;
        the end mark comes first in the opposite order as well."""
        rank = self.symbol
        if opposite:
            rank = np.where(rank > 0, self.size - rank, 0)
        order = np.lexsort((rank, self.parent))
        begins = np.searchsorted(self.parent[order], np.arange(len(self.span) + 1))
        return self.child[order].tolist(), begins.tolist()

    def _tour(self) -> None:
        """Depths on the Euler tour, minima over powers of two, leaves' places."""
        child, begins = self._children(opposite=False)
        span = self.span.tolist()
        depth = [0] * len(span)
        seen = [0] * len(span)
        following = begins[:-1]
        tour: list[int] = []
        path = [0]
        while path:
            node = path[-1]
            seen[node] = len(tour)
            tour.append(depth[node])
            at = following[node]
            if at == begins[node + 1]:
                path.pop()
            else:
                following[node] = at + 1
                below = child[at]
                depth[below] = depth[node] + span[below]
                path.append(below)
        self.depth = depth
        leaf = np.flatnonzero(np.diff(begins) == 0)
        self.leaf_place = np.empty(len(self.text), np.int64)
        suffix = len(self.text) - np.array(depth)[leaf]
        self.leaf_place[suffix] = np.array(seen)[leaf]
        self.least = [np.array(tour, np.int32)]
        step = 1
        while 2 * step <= len(tour):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def ranks(self, opposite: bool) -> list[int]:
        """The rank of every suffix but the empty one."""
        if not opposite:
            places = self.leaf_place
        else:
            child, begins = self._children(opposite=True)
            places = np.empty(len(self.text), np.int64)
            stack, rank = [0], 0
            while stack:
                node = stack.pop()
                below = child[begins[node] : begins[node + 1]]
                if below:
                    stack += reversed(below)
                else:
                    places[len(self.text) - self.depth[node]] = rank
                    rank += 1
        return places[:-1].tolist()

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extensions of suffixes that start at different places."""
        low = np.minimum(self.leaf_place[a], self.leaf_place[b])
        high = np.maximum(self.leaf_place[a], self.leaf_place[b])
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.least[k]
            found[at] = np.minimum(table[low[at]], table[high[at] - (1 << k) + 1])
        return found


def next_smaller(ranks: list[int]) -> list[int]:
    """For each place the next one of smaller rank, else the end."""
    found = [len(ranks)] * len(ranks)
    stack: list[int] = []
    for i, rank in enumerate(ranks):
        while stack and ranks[stack[-1]] > rank:
            found[stack.pop()] = i
        stack.append(i)
    return found


def all_runs(words: np.ndarray) -> np.ndarray:
    """Start, length and period of all runs of at least two periods."""
    symbols = (np.unique(words, return_inverse=True)[1] + 1).tolist()
    n = len(symbols)
    tree = SuffixTree(symbols)
    starts = np.tile(np.arange(n), 2)
    ends = np.array(next_smaller(tree.ranks(False)) + next_smaller(tree.ranks(True)))
    right = tree.common(starts, ends)
    del tree
    left = SuffixTree(symbols[::-1]).common(n - starts, n - ends)
    period = ends - starts
    found = np.stack([starts - left, period + left + right, period], axis=1)
    return np.unique(found[found[:, 1] >= 2 * period], axis=0)


def stretches(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches in which every word has occurred within a third of the length."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    distance = np.full(n, n, np.int64)
    again = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    distance[order[again + 1]] = order[again + 1] - order[again]
    open_ = [(0, n)]
    while open_:
        start, stop = open_.pop()
        far = np.flatnonzero(distance[start:stop] > (stop - start) // (TIMES - 1))
        if not len(far):
            yield start, stop
            continue
        bounds = np.concatenate([[-1], far, [stop - start]])
        for at in np.flatnonzero(np.diff(bounds) >= SHORTEST):
            open_.append((start + int(bounds[at]) + 1, start + int(bounds[at + 1])))


def runs_of(words: np.ndarray) -> list[Run]:
    """All runs of a document's words, by start, then period."""
    if len(words) < SHORTEST:
        return []
    found: list[Run] = []
    for start, stop in stretches(words):
        # The first period of a run lies before its stretch.
        begin = max(0, start - (stop - start) // (TIMES - 1))
        for at, length, period in all_runs(words[begin:stop]).tolist():
            whole = length >= max(SHORTEST, TIMES * period)
            if whole and begin + at + period >= start:
                found.append((begin + at, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        listed, texts = [], []
        for value in batch.column("text"):
            words = (value.as_py() or "").encode().split()
            known: dict[bytes, int] = {}
            numbers = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
            runs = runs_of(numbers)
            if runs:
                change = np.zeros(len(words) + 1, np.int64)
                for start, length, period in runs:
                    change[start + period] += 1
                    change[start + length] -= 1
                kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                words = [words[i] for i in kept.tolist()]
            listed.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
            texts.append(b" ".join(words).decode())
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(listed, pa.list_(kind)), pa.array(texts, pa.string())],
            ["doc_id", "runs", "collapsed"],
        )


def collapse_runs(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, its ``runs`` (start, length and period in words, numbered
    from 0) by start, then period, and the words outside the repeated part of every
    run, joined by one space, as ``collapsed``.  Further columns do not matter."""
    rows = small_batches(docs.selectExpr("cast(doc_id as long) as doc_id", "text"))
    return rows.mapInArrow(
        _collapse,
        "doc_id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
        "collapsed string",
    )

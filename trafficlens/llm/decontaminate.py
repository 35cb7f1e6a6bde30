"""Documents that hold benchmark items, also reworded.

Texts become lower-cased words; terms are the words of the benchmark items, so
whatever the corpus holds, what is sent to the executors is bounded by a block
of items (``BLOCK_WORDS`` words at most; larger benchmarks take several passes).

1. Over all documents: document frequencies of the terms, and in the same pass the
   sums for step 2.
2. Randomised SVD of TF-IDF passages.  With passages T (term counts), weights D
   (idf) and a random matrix G, each task adds up T'TG, a row per term; rows are
   summed across tasks, and a small eigenproblem (Nystroem) gives the leading
   right singular vectors and values of TD, of the passages of all documents.
   The latent space is scaled by the singular values, so that frequent words do
   not outweigh the rest.
   It ranks nothing out: a match's ``cosine`` tells how near its window is.
3. Over all documents again: windows of words, every ``STEP`` words and just long
   enough to hold an item whole wherever it starts.  A window is a candidate if
   it has as many words of the item, with repeats, as step 4 asks for at least.
   That is a bound on the subsequence, so no window that counts is lost.  Running
   sums of the item's rarer words come first; words that most windows have anyway
   (``GIVEN``) are taken as found in them.  Items are handled in blocks.
4. A candidate counts if its longest common subsequence with the item is nearly
   all of the item, or a good part of it and the item's answer is there too.  The
   answer is the last sentence of an item of several, else its last words.

Null and empty texts and items hold nothing; an item under ``SHORT`` words counts
only if its words stand one after the other, in any window that has them all.  Repeated documents and items each
keep their rows; items longer than ``SECTION`` words are compared by sections of about
the same size.  Texts longer than ``SLICE`` are read by parts that share a whole window.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.arrow import small_batches

STEP = 8
PASSAGE = 64
SECTION = 480
BLOCK_WORDS = 100_000
RANK = 128
OVERSAMPLE = 32
SHORT = 8
WHOLE = 0.7
PART = 0.5
ANSWER_WORDS = 5
ANSWER = 0.7
TOGETHER = 32
SENT = 1 << 12
SLICE = 1 << 20
CHECKED = 1 << 13
GIVEN = 0.5

_MARKS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"[.!?]+(?:\s+|$)")
_SPACE = re.compile(r"\s")


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; ASCII marks separate them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_MARKS).split()


def blocks(text: str, size: int = SLICE, overlap: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """The words of a long text by parts, each with the number of its first word.

    With ``overlap`` a part begins as many words early, or a few more, so that its
    first word is one of every ``STEP``, as if the text were whole.
    """
    start, first, carry = 0, 0, []
    while len(text) - start > size:
        space = _SPACE.search(text, start + size)
        if space is None:
            break
        part = carry + words_of(text[start : space.start()])
        yield first, part
        again = max(0, len(part) - overlap) // STEP * STEP if overlap else len(part)
        first, carry = first + again, part[again:]
        start = space.start()
    yield first, carry + words_of(text[start:])


# -- benchmark items ------------------------------------------------------------


@dataclass
class Items:
    """A block of items as numbers of terms."""

    terms: dict[bytes, int] = field(default_factory=dict)
    ids: list[int] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    answers: list[np.ndarray] = field(default_factory=list)

    def add(self, item_id: int, text: str) -> None:
        words = words_of(text)
        sentences = [x for x in (words_of(s) for s in _SENTENCE.split(text)) if x]
        answer = sentences[-1] if len(sentences) > 1 else words[-ANSWER_WORDS:]
        last = self._numbers(answer)
        # Sections of about the same size: none is so short that it is only looked for whole.
        count = -(-len(words) // SECTION)
        for n in range(count):
            section = words[len(words) * n // count : len(words) * (n + 1) // count]
            self.ids.append(item_id)
            self.words.append(self._numbers(section))
            self.answers.append(last if n + 1 == count else self.words[-1][-ANSWER_WORDS:])

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        return np.array([self.terms.setdefault(w, len(self.terms)) for w in words], np.int32)

    def size(self) -> int:
        return sum(map(len, self.words))


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The items by blocks; one block at a time is on the driver."""
    held = Items()
    rows = benchmark.filter("item_id is not null and text is not null")
    for row in rows.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        held.add(row["item_id"], row["text"])
        if held.size() >= block_words:
            yield held
            held = Items()
    if held.ids:
        yield held


# -- latent space --------------------------------------------------------------


def _profile(terms: dict[bytes, int], random: np.ndarray):
    """Per term of a task the documents with it and its row of T'(T G)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(terms), np.int64)
        total = np.zeros(random.shape)

        def add(passages: np.ndarray) -> None:
            """Passages as rows of term numbers; -1 is no term."""
            for low in range(0, len(passages), TOGETHER):
                some = passages[low : low + TOGETHER]
                used, ids = np.unique(some, return_inverse=True)
                ids = ids.reshape(some.shape) + np.arange(len(some))[:, None] * len(used)
                counts = np.bincount(ids.ravel(), minlength=len(some) * len(used))
                counts = counts.reshape(len(some), -1).astype(np.float32)
                if used[0] < 0:
                    used, counts = used[1:], counts[:, 1:]
                total[used] += counts.T @ (counts @ random[used])

        pending, size = [], 0
        for batch in batches:
            for text in batch.column("text"):
                seen = []
                for _, words in blocks(text.as_py() or ""):
                    ids = np.full(-(-len(words) // PASSAGE) * PASSAGE, -1, np.int32)
                    ids[: len(words)] = [terms.get(w, -1) for w in words]
                    seen.append(ids)
                    pending.append(ids.reshape(-1, PASSAGE))
                    size += len(pending[-1])
                    if size >= 8 * TOGETHER:
                        add(np.concatenate(pending))
                        pending, size = [], 0
                here = np.unique(np.concatenate(seen))
                found[here[here >= 0]] += 1
        if pending:
            add(np.concatenate(pending))
        used = np.flatnonzero(found)
        for low in range(0, len(used), SENT):
            some = used[low : low + SENT]
            rows = [row.tobytes() for row in total[some].astype("<f8")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(found[some]), pa.array(rows, pa.binary())],
                ["term", "n", "sketch"],
            )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one term from all tasks, added up; a term's rows are in one task."""
    found: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for term, n, row in zip(
            batch.column("term").to_pylist(), batch.column("n").to_pylist(), batch.column("sketch")
        ):
            values = np.frombuffer(row.as_buffer(), "<f8")
            if term in total:
                found[term] += n
                total[term] += values
            else:
                found[term], total[term] = n, values.copy()
    used = list(total)
    for low in range(0, len(used), SENT):
        some = used[low : low + SENT]
        rows = [total[term].tobytes() for term in some]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int64()),
                pa.array([found[term] for term in some], pa.int64()),
                pa.array(rows, pa.binary()),
            ],
            ["term", "n", "sketch"],
        )


def latent_terms(
    docs: DataFrame,
    terms: dict[bytes, int],
    rank: int = RANK,
    oversample: int = OVERSAMPLE,
) -> np.ndarray:
    """For each term its idf times its row of the scaled leading singular vectors.

    A passage's place in the latent space is the sum over its words.  Fitted on
    all passages of all documents.
    """
    count = docs.count()
    random = np.random.default_rng(7).standard_normal((len(terms), rank + oversample))
    frequency = np.zeros(len(terms))
    sketch = np.zeros(random.shape)
    row_type = "term long, n long, sketch binary"
    for row in (
        docs.select("text")
        .mapInArrow(_profile(terms, random.astype(np.float32)), row_type)
        .repartition("term")
        .mapInArrow(_added, row_type)
        .collect()
    ):
        frequency[row["term"]] = row["n"]
        sketch[row["term"]] = np.frombuffer(row["sketch"], "<f8")
    idf = np.log((1 + count) / (1 + frequency)) + 0.01
    core = random.T @ sketch  # (TG)'(TG)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values[-1], 1e-9)
    if not good.any():  # no term in any text: every term is its own direction
        return random[:, :rank].astype(np.float32)
    wide = (idf[:, None] * sketch) @ (vectors[:, good] / np.sqrt(values[good]))
    basis, scale, _ = np.linalg.svd(wide, full_matrices=False)
    kept = scale[:rank] > 1e-6 * scale[0]
    return (idf[:, None] * (basis[:, :rank] / scale[:rank])[:, kept]).astype(np.float32)


# -- search and checks -----------------------------------------------------------


def _masks(words: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for at, word in enumerate(words.tolist()):
        masks[word] = masks.get(word, 0) | 1 << at
    return masks


def common_subsequence(masks: dict[int, int], size: int, words: Iterable[int]) -> int:
    """Length of the longest common subsequence, a bit per word of the item."""
    full = (1 << size) - 1
    state = full
    for word in words:
        mask = masks.get(word)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


@dataclass
class _Query:
    """What a search task needs of an item."""

    item_id: int
    size: int
    masks: dict[int, int]
    answer_size: int
    answer_masks: dict[int, int]
    order: list[int]

    def check(self, words: list[int]) -> tuple[float, bool] | None:
        share = common_subsequence(self.masks, self.size, words) / self.size
        if self.size < SHORT:
            n = self.size
            whole = any(words[i : i + n] == self.order for i in range(len(words) - n + 1))
            return (1.0, True) if whole else None
        if share < PART:
            return None
        held = common_subsequence(self.answer_masks, self.answer_size, words)
        answered = held >= ANSWER * self.answer_size
        return (share, answered) if share >= WHOLE or answered else None


def _search(items: Items, vectors: np.ndarray):
    of_width = np.array([-(-(len(w) + STEP - 1) // STEP) * STEP for w in items.words])
    widths = sorted(set(of_width.tolist()))
    longest = widths[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [
            _Query(i, len(w), _masks(w), len(a), _masks(a), w.tolist())
            for i, w, a in zip(items.ids, items.words, items.answers)
        ]
        wide = np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)])
        units = np.array([vectors[w].sum(axis=0) for w in items.words])
        units /= np.maximum(np.linalg.norm(units, axis=1), 1e-12)[:, None]
        # How often an item has a word; the last row is of words of no item.
        times = np.zeros((len(items.terms) + 1, len(queries)), np.uint16)
        for number, words in enumerate(items.words):
            np.add.at(times[:, number], words, 1)
        term, item = np.nonzero(times)
        repeats = times[term, item]
        wanted = np.array([q.size if q.size < SHORT else math.ceil(PART * q.size) for q in queries])
        pad = longest // STEP + 1
        for batch in batches:
            out: dict[tuple[int, int], tuple] = {}

            def scan(parts: list[tuple[int, int, np.ndarray]]) -> None:
                """Parts of texts: row, number of its first word, term numbers."""
                lengths = [-(-len(ids) // STEP) for _, _, ids in parts]
                firsts = np.cumsum([1, *[n + pad for n in lengths]])
                laid = np.full(int(firsts[-1]) * STEP, -1, np.int32)
                for (_, _, ids), first in zip(parts, firsts):
                    laid[first * STEP : first * STEP + len(ids)] = ids
                # Words so frequent that a window has them anyway are not counted,
                # but taken as found as often as the item has them.
                rate = np.bincount(laid[laid >= 0], minlength=len(times)) / len(laid)
                given = rate[term] * (of_width[item] + 2 * STEP) > GIVEN * repeats
                least = wanted - np.bincount(item, given * repeats, len(queries)).astype(int)
                given &= least[item] > 0  # else nothing would be left to count
                least = np.where(least > 0, least, wanted)
                rare = (times > 0).astype(np.uint8)
                rare[term[given], item[given]] = 0
                sums = rare[laid[::STEP]]
                for place in range(1, STEP):
                    sums += rare[laid[place::STEP]]
                before_block = np.zeros((len(sums) + 1, len(queries)), np.uint16)
                np.cumsum(sums, axis=0, dtype=np.uint16, out=before_block[1:])
                for target in widths:
                    mine = np.flatnonzero(of_width == target)
                    counted = before_block if len(mine) == len(queries) else before_block[:, mine]
                    reach = target // STEP + 2
                    found = counted[reach:] - counted[:-reach]  # from a block before the window
                    at, which = np.nonzero(found >= least[mine])
                    at, which = at + 1, mine[which]
                    # No subsequence is longer than the words that both have, with repeats.
                    around = np.arange(-STEP, target + STEP)
                    keep = np.zeros(len(at), bool)
                    for low in range(0, len(at), CHECKED):
                        some = slice(low, low + CHECKED)
                        held = np.sort(laid[at[some, None] * STEP + around], axis=1)
                        new = np.diff(held, axis=1, prepend=-2) != 0
                        column = np.arange(held.shape[1])
                        nth = column - np.maximum.accumulate(np.where(new, column, 0), axis=1)
                        shared = (nth < times[held, which[some, None]]).sum(axis=1)
                        keep[some] = shared >= wanted[which[some]]
                    for at, query in zip(at[keep].tolist(), which[keep].tolist()):
                        part = int(np.searchsorted(firsts, at, "right")) - 1
                        row, before, ids = parts[part]
                        begin = (at - int(firsts[part])) * STEP
                        old = out.get((row, query))
                        if begin >= len(ids) or old and old[0] == 1.0 and old[1]:
                            continue
                        low = max(0, begin - STEP)
                        held = ids[low : begin + target + STEP].tolist()
                        verdict = queries[query].check(held)
                        if verdict and (not old or verdict > old[:2]):
                            latent = wide[ids[begin : begin + target]].sum(axis=0)
                            norm = max(float(np.linalg.norm(latent)), 1e-12)
                            cosine = float(latent @ units[query]) / norm
                            out[row, query] = (*verdict, cosine, before + low, len(held))

            pending, size = [], 0
            for row, text in enumerate(batch.column("text")):
                for before, words in blocks(text.as_py() or "", overlap=longest + 2 * STEP):
                    ids = np.fromiter(
                        (items.terms.get(w, -1) for w in words), np.int32, len(words)
                    )
                    pending.append((row, before, ids))
                    size += len(ids)
                    if size >= SLICE // 8:
                        scan(pending)
                        pending, size = [], 0
            if pending:
                scan(pending)
            keys = sorted(out)
            ids = batch.column("doc_id").to_pylist()
            values = [out[key] for key in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[row] for row, _ in keys], pa.int64()),
                    pa.array([queries[query].item_id for _, query in keys], pa.int64()),
                    pa.array([v[0] for v in values], pa.float64()),
                    pa.array([v[1] for v in values], pa.bool_()),
                    pa.array([v[2] for v in values], pa.float64()),
                    pa.array([v[3] for v in values], pa.int64()),
                    pa.array([v[4] for v in values], pa.int64()),
                ],
                ["doc_id", "item_id", "lcs_share", "answer_found", "cosine", "first_word", "words"],
            )

    return run


MATCH = (
    "doc_id long, item_id long, lcs_share double, answer_found boolean, cosine double, "
    "first_word long, words long"
)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document and benchmark item (or section) found in it, with the best window."""
    texts = small_batches(docs.select(F.col("doc_id").cast("long"), "text"))
    found = None
    for items in item_blocks(benchmark, block_words):
        if not items.terms:
            continue
        vectors = latent_terms(texts, items.terms)
        part = texts.mapInArrow(_search(items, vectors), MATCH)
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], MATCH)
    return found

"""Languages of documents, also of spans within mixed texts.

Words are runs of letters.  The script of a word, by Unicode ranges, narrows the
languages it may be in to those that use the script in training.  A word's score
per language is the sum of log probabilities of its letter trigrams, counted in
a table of fixed size.  Viterbi over the words of a text, with a penalty for
switching language, labels spans; the text's language is the one that labels
most letters, and the score is its share.

Null texts and texts without a letter are ``und`` with score 0.  Letters of a
script that no language was trained on say nothing; a text of such letters alone
gets the language most frequent in training, with score 0.  Ties go to the
language that sorts first.  Without training texts every result is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.arrow import small_batches

# Upper bound, on average, of training documents per language.
TRAIN_DOCS = 3000
TABLE_BITS = 16
SWITCH = 12.0
# A script is one of a language's if this share of its training letters is in it.
SCRIPT_SHARE = 0.02
GROUP_CHARS = 6 << 20
PIECE_CHARS = 1 << 19

# First and last code point of the letters of scripts.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F),
    ("Greek", 0x0370, 0x03FF),
    ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F),
    ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x077F),
    ("Devanagari", 0x0900, 0x097F),
    ("Bengali", 0x0980, 0x09FF),
    ("Gurmukhi", 0x0A00, 0x0A7F),
    ("Gujarati", 0x0A80, 0x0AFF),
    ("Tamil", 0x0B80, 0x0BFF),
    ("Telugu", 0x0C00, 0x0C7F),
    ("Kannada", 0x0C80, 0x0CFF),
    ("Malayalam", 0x0D00, 0x0D7F),
    ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF),
    ("Hangul", 0x1100, 0x11FF),
    ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x1F00, 0x1FFF),
    ("Kana", 0x3040, 0x30FF),
    ("Han", 0x3400, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF),
    ("Han", 0x20000, 0x323AF),
)
OTHER = "Other"
NAMES = [OTHER, *dict.fromkeys(name for name, _, _ in SCRIPTS)]


def script_table() -> np.ndarray:
    """Per code point 0 for what is no letter, else one more than the script's place."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    table = letters.astype(np.uint8)
    for name, first, last in SCRIPTS:
        table[first : last + 1] *= NAMES.index(name) + 1
    return table


def trigrams(points: np.ndarray) -> np.ndarray:
    """A table place for every position and its two neighbours; non-letters are 0."""
    wide = np.zeros(len(points) + 2, np.uint64)
    wide[1:-1] = points
    with np.errstate(over="ignore"):
        mixed = (wide[:-2] << np.uint64(42)) ^ (wide[1:-1] << np.uint64(21)) ^ wide[2:]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def letters_of(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with non-letters as 0, and their scripts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    scripts = table[points]
    return np.where(scripts > 0, points, 0), scripts


def blocks(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """A long text cut at spaces, so that words stay whole."""
    start = 0
    while len(text) - start > size:
        stop = text.find(" ", start + size)
        if stop < 0:
            break
        yield text[start:stop]
        start = stop
    yield text[start:]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # table place x language, log probability
    uses: np.ndarray  # script x language
    usual: int  # place of the most frequent language


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts, and letters per script under negative places."""
    table = script_table()
    for batch in batches:
        counts: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            held = counts.setdefault(lang, np.zeros(1 << TABLE_BITS, np.int64))
            seen = scripts.setdefault(lang, np.zeros(len(NAMES) + 1, np.int64))
            for part in blocks(text):
                points, script = letters_of(part, table)
                held += np.bincount(trigrams(points)[points > 0], minlength=len(held))
                seen += np.bincount(script, minlength=len(seen))
        for lang, held in counts.items():
            places = np.flatnonzero(held)
            used = np.flatnonzero(scripts[lang][1:])
            size = len(places) + len(used)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array(np.concatenate([places, -1 - used])),
                    pa.array(np.concatenate([held[places], scripts[lang][1:][used]])),
                ],
                ["lang", "place", "n"],
            )


def fit(docs: DataFrame, train: Column, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from the documents with a text and a ``lang`` where ``train`` holds.

    Of a language with more than ``train_docs`` documents about that many are
    taken, by a hash of their id.  The counts that come to the driver are bounded
    by the table's size for each language.
    """
    known = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((1 << TABLE_BITS, 0)), np.zeros((len(NAMES), 0), bool), 0)
    steps = {lang: max(1, round(sizes[lang] / train_docs)) for lang in languages}
    step = F.create_map(*[F.lit(x) for lang in languages for x in (lang, steps[lang])])
    sample = small_batches(known).filter(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), step[F.col("lang")]) == 0)
    counted = (
        sample.select("lang", "text")
        .mapInArrow(_count, "lang string, place long, n long")
        .groupBy("lang", "place")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    grams = np.zeros((1 << TABLE_BITS, len(languages)))
    scripts = np.zeros((len(NAMES), len(languages)))
    of = counted["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(int)
    place, n = counted["place"].to_numpy(), counted["n"].to_numpy()
    gram = place >= 0
    grams[place[gram], of[gram]] = n[gram]
    scripts[-1 - place[~gram], of[~gram]] = n[~gram]
    # Unseen trigrams share the weight of one part in twenty.
    share = grams / np.maximum(grams.sum(axis=0), 1)
    weights = np.log(0.95 * share + 0.05 / len(share)).astype(np.float32)
    uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    usual = max(range(len(languages)), key=lambda i: (sizes[languages[i]], -i))
    return Model(languages, weights, uses, usual)


@dataclass
class Words:
    """Words of several texts one after the other."""

    scores: np.ndarray  # word x language
    letters: np.ndarray  # 0 if the word says nothing
    ends: np.ndarray  # where each text's words start and end
    has_letter: np.ndarray


def score_words(texts: list[str], model: Model, table: np.ndarray) -> Words:
    scores, letters, sizes, any_letter = [], [], [], []
    for text in texts:
        size, seen = 0, False
        for part in blocks(text):
            points, script = letters_of(part, table)
            inside = points > 0
            starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
            if not len(starts):
                continue
            seen = True
            at = np.flatnonzero(inside)
            first = np.searchsorted(at, starts)
            each = np.add.reduceat(model.weights[trigrams(points)[at]], first, axis=0)
            length = np.diff(np.append(first, len(at)))
            fits = model.uses[script[starts] - 1]
            known = fits.any(axis=1)
            each = np.where(fits, each - each.max(axis=1, keepdims=True, initial=-np.inf), -1e6)
            each[~known] = 0
            scores.append(each)
            letters.append(np.where(known, length, 0))
            size += len(starts)
        sizes.append(size)
        any_letter.append(seen)
    kinds = len(model.languages)
    return Words(
        np.concatenate([np.empty((0, kinds), np.float32), *scores]),
        np.concatenate([np.empty(0, np.int64), *letters]),
        np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]),
        np.array(any_letter, bool),
    )


def viterbi(scores: np.ndarray, ends: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word; the texts advance word by word together."""
    sizes = np.diff(ends)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = ends[:-1][order], sizes[order]
    stays = np.zeros(scores.shape, bool)
    best = np.zeros(len(scores), np.int16)
    value = np.zeros((len(order), scores.shape[1]), scores.dtype)
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0] if len(sizes) else 0), "right")
    for step, n in enumerate(active):
        at = begin[:n] + step
        now = value[:n]
        if step:
            top = now.argmax(axis=1)
            change = now[np.arange(n), top] - switch
            best[at] = top
            stay = now >= change[:, None]
            stays[at] = stay
            now = np.where(stay, now, change[:, None])
            now -= now.max(axis=1, keepdims=True)
        value[:n] = now + scores[at]
    labels = np.zeros(len(scores), np.int16)
    state = value.argmax(axis=1)
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        at = begin[:n] + step
        labels[at] = state[:n]
        if step:
            state[:n] = np.where(stays[at, state[:n]], state[:n], best[at])
    return labels


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a column in groups of bounded size; null is empty."""
    held, size = [], 0
    for value in column:
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= GROUP_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _label(model: Model, switch: float, keep: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = script_table()
        kinds = len(model.languages)
        for batch in batches:
            langs, shares, spans = [], [], []
            for texts in _groups(batch.column("text")):
                words = score_words(texts, model, table)
                if not kinds:
                    langs += ["und"] * len(texts)
                    shares += [0.0] * len(texts)
                    spans += [[]] * len(texts)
                    continue
                labels = viterbi(words.scores, words.ends, switch)
                text_of = np.repeat(np.arange(len(texts)), np.diff(words.ends))
                held = np.bincount(
                    text_of * kinds + labels, words.letters, len(texts) * kinds
                ).reshape(-1, kinds)
                total = held.sum(axis=1)
                top = np.where(total > 0, held.argmax(axis=1), model.usual)
                share = held[np.arange(len(texts)), top] / np.maximum(total, 1)
                langs += [
                    model.languages[i] if seen else "und"
                    for i, seen in zip(top, words.has_letter)
                ]
                shares += share.tolist()
                new = np.append(True, (np.diff(labels) != 0) | (np.diff(text_of) != 0))
                first = np.flatnonzero(new[: len(labels)])
                length = np.diff(np.append(first, len(labels)))
                runs: list[list] = [[] for _ in texts]
                for a, n in zip(first.tolist(), length.tolist()):
                    runs[text_of[a]].append(
                        {
                            "lang": model.languages[labels[a]],
                            "first_word": a - int(words.ends[text_of[a]]),
                            "words": n,
                        }
                    )
                spans += runs
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in ("doc_id", *keep)],
                    pa.array(langs, pa.string()),
                    pa.array(shares, pa.float64()),
                    pa.array(
                        spans,
                        pa.list_(
                            pa.struct(
                                [
                                    ("lang", pa.string()),
                                    ("first_word", pa.int64()),
                                    ("words", pa.int64()),
                                ]
                            )
                        ),
                    ),
                ],
                ["doc_id", *keep, "lang_pred", "score", "spans"],
            )

    return run


def identify(
    docs: DataFrame, model: Model, switch: float = SWITCH, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Per row ``doc_id``, the columns ``keep``, ``lang_pred``, ``score`` and the
    labelled ``spans`` of words."""
    held = ["text", *[c for c in keep if c != "text"]]
    rows = small_batches(docs.select(F.col("doc_id").cast("long"), *held))
    kept = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(
        _label(model, switch, keep),
        f"doc_id long, {kept}lang_pred string, score double, "
        "spans array<struct<lang: string, first_word: bigint, words: bigint>>",
    )


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row is in a fold by the checksum of its id as text; no id: no."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))

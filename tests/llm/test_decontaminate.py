from __future__ import annotations

import random

import pytest

from trafficlens.llm import decontaminate as d


@pytest.fixture(scope="module")
def tables(spark):
    at = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(
        f"{at}/benchmark.parquet"
    )


def test_verbatim_items_are_found_and_nothing_else(tables):
    docs, items = tables
    words = {r["item_id"]: b" ".join(d.words_of(r["text"])) for r in items.collect()}
    wanted = set()
    for row in docs.collect():
        text = b" " + b" ".join(d.words_of(row["text"])) + b" "
        wanted |= {(row["doc_id"], i) for i, x in words.items() if b" " + x + b" " in text}
    found = {(r["doc_id"], r["item_id"]) for r in d.contaminated(*tables).collect()}
    assert found == wanted and wanted


def test_reworded_items(spark, tables):
    """Every eighth word another: found; half of the words in another order: not."""
    docs, items = tables
    rng = random.Random(5)
    filler = " ".join(r["text"] for r in docs.limit(30).collect()).split()
    rows, wanted = [], set()
    for row in items.collect():
        words = row["text"].split()
        light = [rng.choice(filler) if i % 8 == 3 else w for i, w in enumerate(words)]
        heavy = words[::2]
        rng.shuffle(heavy)
        around = filler[rng.randrange(2000) :][:60]
        i = row["item_id"]
        rows += [(2 * i, " ".join(around + light + around)), (2 * i + 1, " ".join(around + heavy))]
        if len(words) >= d.SHORT:
            wanted.add((2 * i, i))
    found = {
        (r["doc_id"], r["item_id"])
        for r in d.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    }
    assert len(found & wanted) >= 0.95 * len(wanted)
    assert not {x for x in found if x[0] % 2}


def test_edges(spark):
    item = "one two three four five six seven eight nine ten. The answer is eleven"
    items = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (4, "alpha beta gamma"), (None, item)],
        "item_id long, text string",
    )
    rows = [
        (1, item.upper()),
        (2, None),
        (3, ""),
        (4, "alpha, beta gamma!"),
        (5, "alpha x beta gamma"),
        (6, "words without any of it " * 3000 + item + " and more of it" * 3000),
        (1, item),
        (None, item),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(
        ((r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()), key=str
    )
    assert found == [(1, 1), (1, 1), (4, 4), (6, 1), (None, 1)]
    assert d.contaminated(docs.limit(0), items).collect() == []
    assert d.contaminated(docs, items.limit(0)).collect() == []


def test_blocks_of_items_give_the_same(tables):
    docs, items = tables
    whole = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    parts = {
        (r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items, block_words=600).collect()
    }
    assert whole == parts


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 15))]
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
        import numpy as np

        assert d.common_subsequence(d._masks(np.array(a)), len(a), b) == row[-1]


def by_check_alone(texts, benchmark):
    """Pairs that the check accepts in any window, without a search for candidates."""
    items = d.Items()
    for i, text in benchmark:
        items.add(i, text)
    queries = [
        d._Query(i, len(w), d._masks(w), len(a), d._masks(a), w.tolist())
        for i, w, a in zip(items.ids, items.words, items.answers)
    ]
    found = set()
    for doc, text in texts:
        ids = [items.terms.get(w, -1) for w in d.words_of(text)]
        for query in queries:
            width = -(-(query.size + d.STEP - 1) // d.STEP) * d.STEP
            for begin in range(0, len(ids), d.STEP):
                if query.check(ids[max(0, begin - d.STEP) : begin + width + d.STEP]):
                    found.add((doc, query.item_id))
                    break
    return found


def test_all_reworded_items_that_the_check_accepts(spark, tables):
    """Shares from all words down to half with the answer, between other words."""
    docs, items = tables
    rng = random.Random(11)
    filler = [w for r in docs.limit(200).collect() for w in (r["text"] or "").split()]
    benchmark = [(r["item_id"], r["text"]) for r in items.collect()]
    benchmark = [x for x in benchmark if len(d.words_of(x[1])) >= d.SHORT]
    rows = []
    for share in (1.0, 0.85, 0.72, 0.65, 0.55, 0.52):
        for item_id, text in benchmark[:25]:
            words = text.split()
            answer = [] if share >= d.WHOLE else words[-d.ANSWER_WORDS :]
            body = words[: len(words) - len(answer)]
            keep = max(0, round(share * len(words)) - len(answer))
            kept = set(rng.sample(range(len(body)), keep))
            body = [w if i in kept else rng.choice(filler) for i, w in enumerate(body)]
            at = rng.randrange(len(filler) - 80)
            text = filler[at : at + 40] + body + answer + filler[at + 40 : at + 80]
            rows.append((len(rows), " ".join(text)))
    wanted = by_check_alone(rows, benchmark)
    found = d.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(benchmark, "item_id long, text string"),
    )
    assert len(wanted) > 100
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == wanted


def test_short_items_whatever_the_words_around_them_weigh():
    """Three to seven words whole among terms that outweigh them in the latent space."""
    import numpy as np
    import pyarrow as pa

    other = [f"w{i}" for i in range(40)]
    items, rows = d.Items(), []
    for size in range(3, d.SHORT):
        words = [f"s{size}x{i}" for i in range(size)]
        items.add(size, " ".join(words))
        rows.append((size, " ".join(other[:17] + words + other[17:])))
        rows.append((-size, " ".join(other[:17] + words[:1] + other[:1] + words[1:] + other[17:])))
    items.add(100, " ".join(other[::-1]))
    heavy = [t.startswith(b"w") for t in items.terms]
    vectors = np.where(np.array(heavy)[:, None], [[0, 10]], [[1, 0]]).astype(np.float32)
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": text} for i, text in rows])
    found = [r for b in d._search(items, vectors)(iter([batch])) for r in b.to_pylist()]
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(i, i) for i in range(3, d.SHORT)]


def test_latent_space_is_fitted_on_every_document(spark):
    """The Gram matrix of all passages, at more documents than a bounded sample would hold."""
    import numpy as np
    from pyspark.sql import functions as F

    count, words = 20_000, 10
    word = [
        F.when(F.pmod(F.xxhash64(F.lit(t), "id"), F.lit(t + 2)) == 0, F.lit(f"t{t} ") if t % 2 else F.lit(f"t{t} t{t} "))
        for t in range(words)
    ]
    once = F.when(F.col("id") < 40, F.concat(F.lit("only"), F.col("id").cast("string")))
    docs = spark.range(count).select(
        F.col("id").alias("doc_id"), F.concat_ws("", *word, once).alias("text")
    )
    terms = {f"t{t}".encode(): t for t in range(words)}
    terms |= {f"only{i}".encode(): words + i for i in range(40)}
    terms[b"nowhere"] = len(terms)
    held = len(terms) - 1
    gram, frequency = np.zeros((held, held)), np.zeros(held)
    for row in docs.collect():
        ids = [terms[w] for w in d.words_of(row["text"])]
        passage = np.bincount(ids, minlength=held)
        frequency += passage > 0
        gram += np.outer(passage, passage)
    assert (frequency > 0).all()

    vectors = d.latent_terms(docs, terms).astype(float)
    # All directions are kept, so terms weigh as in the inverse of the Gram matrix.
    assert np.allclose(vectors[:held] @ vectors[:held].T @ gram, np.eye(held), atol=0.02)
    assert not vectors[held].any()


def test_terms_of_long_and_many_passages(spark):
    """Sums do not depend on how texts fall into batches, blocks and tasks."""
    import numpy as np

    rng = random.Random(3)
    rows = [(i, " ".join(f"t{rng.randrange(30)}" for _ in range(n))) for i, n in enumerate([0, 1, 64, 65, 9000, 130] * 4)]
    rows.append((99, None))
    terms = {f"t{t}".encode(): t for t in range(25)}
    gram = np.zeros((25, 25))
    for _, text in rows:
        words = d.words_of(text or "")
        for at in range(0, len(words), d.PASSAGE):
            ids = [terms[w] for w in words[at : at + d.PASSAGE] if w in terms]
            passage = np.bincount(ids, minlength=25)
            gram += np.outer(passage, passage)
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        vectors = d.latent_terms(docs, terms).astype(float)
        assert np.allclose(vectors @ vectors.T @ gram, np.eye(25), atol=0.02)


def searched(benchmark, rows):
    import numpy as np
    import pyarrow as pa

    items = d.Items()
    for i, text in benchmark:
        items.add(i, text)
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": text} for i, text in rows])
    vectors = np.ones((len(items.terms), 1), np.float32)
    return [r for b in d._search(items, vectors)(iter([batch])) for r in b.to_pylist()]


def test_windows_across_the_slices_of_a_long_text():
    """A reworded item as wide as its window, with the end of a slice at every place of it."""
    words = [f"item{i:03d}" for i in range(40)]
    kept = words[:28]  # 70 % of the words, without the answer
    end = d.SLICE // 8 + 1  # words of the first slice: each takes eight characters
    rows = []
    for at in range((end - 72) // d.STEP * d.STEP, end + 8, d.STEP):
        text = [f"w{i % 900_000:06d}" for i in range(end + 200)]
        text[at : at + 14], text[at + 50 : at + 64] = kept[:14], kept[14:]
        rows.append((at, " ".join(text)))
    benchmark = [(1, " ".join(words))]
    assert sum(len(w) + 1 for w in text[: end - 1]) == d.SLICE
    found = searched(benchmark, rows)
    assert by_check_alone(rows[:2], benchmark) == {(at, 1) for at, _ in rows[:2]}
    assert [(r["doc_id"], r["first_word"], r["lcs_share"]) for r in found] == [
        (at, at, 0.7) for at, _ in rows
    ]


def test_parts_of_a_long_text_begin_at_whole_steps():
    text = " ".join(f"w{i}" for i in range(3000))
    words = d.words_of(text)
    for size, overlap in ((100, 24), (1000, 64), (333, 40)):
        after = 0
        for first, part in d.blocks(text, size, overlap):
            assert first % d.STEP == 0 and part == words[first : first + len(part)]
            assert after == 0 or after - first >= min(overlap, after)
            after = first + len(part)
        assert after == len(words)
    assert [w for _, part in d.blocks(text, 100) for w in part] == words


def test_the_end_of_a_long_item_is_no_short_item():
    """An item just over a section has two halves, each checked for rewording and answer."""
    words = [f"word{i}" for i in range(d.SECTION + 5)]
    around = [f"other{i}" for i in range(60)]
    half = [f"new{i}" if i % 8 == 3 else w for i, w in enumerate(words)][len(words) // 2 :]
    half[-2] = "new"
    texts = [words, half, words[-5:], words[: len(words) // 4]]
    rows = [(i, " ".join(around + x + around)) for i, x in enumerate(texts)]
    found = searched([(1, " ".join(words))], rows)
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(0, 1), (0, 1), (1, 1)]

from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest

from trafficlens.llm import embeddings


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def plain(rows, least=0.9):
    ids = [i for i, _ in rows]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    units = [
        np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max())
        if usable(v)
        else None
        for _, v in rows
    ]
    links = [0] * len(rows)
    for a, u in enumerate(units):
        for b, w in enumerate(units):
            if a != b and u is not None and w is not None and len(u) == len(w) and u @ w >= least:
                links[a] += 1
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return sorted((i, n, find(i), find(i) == i) for i, n in zip(ids, links))


def ours(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(tuple(r) for r in embeddings.near_duplicates(table, **options).collect())


@pytest.mark.parametrize("block", [1024, 16])
def test_spread_vectors_and_edges(spark, block):
    """Few dimensions: groups lie across cells, so visits decide."""
    vectors = np.random.default_rng(1).normal(size=(250, 4))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    rows += [
        (2000, None),
        (2001, []),
        (2002, [0.0] * 4),
        (2003, [1.0, None, 0.0, 0.0]),
        (2004, [float("nan")] * 4),
        (2005, [float("inf"), 0.0, 0.0, 0.0]),
        (2006, [x * 1e200 for x in rows[3][1]]),
        (2007, rows[3][1][:3]),
    ]
    assert ours(spark, rows, block=block) == plain(rows)


def test_tight_groups(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(12, 16))
    rows = [
        (i, [float(x) for x in middles[i % 12] + rng.normal(size=16) * 0.2]) for i in range(300)
    ]
    assert ours(spark, rows, block=8) == plain(rows)


def test_no_rows_and_no_id(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(table).collect()}
    assert found == {None: (None, None, None), 1: (0, 1, True), 2: (0, 2, True)}
    assert embeddings.near_duplicates(table.limit(0)).collect() == []


def bytes_below(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*") if p.is_file())


def test_written_bytes_are_in_proportion_to_the_vectors(spark):
    """Vectors without structure visit about every cell; no visit is written."""
    vectors = np.random.default_rng(3).normal(size=(12_000, 64)).astype(np.float32)
    vectors[6000:6100] = vectors[:100] * 2
    table = spark.createDataFrame(
        [(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>"
    )
    shared = spark.conf.get("spark.checkpoint.dir")
    before = bytes_below(shared)
    found = embeddings.near_duplicates(table).collect()
    sample = min(len(vectors), embeddings.FIT_ROWS) * 64 * 8  # in double precision, for k-means
    assert bytes_below(shared) - before < sample + 2 * vectors.nbytes
    pairs = {(r["vec_id"], r["n_links"], r["component_id"]) for r in found if r["n_links"]}
    assert pairs == {(i + at, 1, i) for i in range(100) for at in (0, 6000)}


@pytest.mark.parametrize("most, block", [(8, 64), (1 << 16, 16)])
def test_many_copies_of_a_vector(spark, monkeypatch, most, block):
    """Copies of one vector are several nodes, in several blocks, and ids may repeat."""
    monkeypatch.setattr(embeddings, "MOST_COPIES", most)
    vectors = np.random.default_rng(4).normal(size=(60, 3)).astype(np.float32).astype(float)
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    rows += [(100 + i, vectors[7].tolist()) for i in range(90)]
    rows += [(200, vectors[7].tolist())] * 40
    rows += [(300 + i, vectors[8].tolist()) for i in range(5)]
    rows += [(8, vectors[8].tolist())] * 3
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    floats = table.withColumn("embedding", table["embedding"].cast("array<float>"))
    wanted = plain(rows)
    for rows_of in (table, floats):
        found = embeddings.near_duplicates(rows_of, block=block).collect()
        assert sorted(map(tuple, found)) == wanted


def near_and_far(least, dims, count, seed):
    """Pairs of vectors whose cosine differs from ``least`` by 1e-9 either way."""
    rng = np.random.default_rng(seed)
    out = []
    for at in range(count):
        x, y = np.linalg.qr(rng.normal(size=(dims, 2)))[0].T
        cosine = least + (1e-9 if at % 2 else -1e-9)
        out += [x * rng.uniform(0.1, 9), (cosine * x + (1 - cosine**2) ** 0.5 * y) * 5]
    return out


def test_pairs_beside_the_threshold(spark):
    """What single precision cannot tell apart is judged in double."""
    vectors = near_and_far(0.9, 64, 60, 6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = ours(spark, rows)
    assert found == plain(rows)
    assert sum(n for _, n, _, _ in found) == 60


@pytest.mark.parametrize("many", [0.0, 1.0])
def test_dense_groups_and_sparse_ones(spark, monkeypatch, many):
    monkeypatch.setattr(embeddings, "MANY", many)
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(3, 32))
    vectors = np.concatenate(
        [middles[rng.integers(3, size=400)] + rng.normal(size=(400, 32)) * 0.3, rng.normal(size=(300, 32))]
    )
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(700), vectors)]
    assert ours(spark, rows, block=100) == plain(rows)


def test_the_leading_coordinates_bound_the_cosine():
    rng = np.random.default_rng(8)
    for dims, cells in ((3, 5), (16, 4), (64, 20), (64, 300), (200, 7)):
        vectors = rng.normal(size=(50, dims)) * rng.uniform(0.01, 3, size=dims)
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        middle = rng.normal(size=(cells, dims))
        basis = embeddings.leading(middle / np.linalg.norm(middle, axis=1)[:, None], 0.9)
        assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]))
        lead = unit @ basis
        rest = np.sqrt(np.maximum(1 - (lead**2).sum(axis=1), 0))
        assert (lead @ lead.T + np.outer(rest, rest) >= unit @ unit.T - 1e-9).all()


def test_labels_of_united_groups():
    rng = np.random.default_rng(9)
    for _ in range(50):
        a, b = rng.integers(30, size=(2, 25))
        label = embeddings.united(embeddings.united(np.arange(30), a[:9], b[:9]), a[9:], b[9:])
        wanted = np.arange(30)
        for _ in range(30):
            for x, y in zip(a, b):
                wanted[[x, y]] = min(wanted[x], wanted[y])
        assert label.tolist() == wanted.tolist()

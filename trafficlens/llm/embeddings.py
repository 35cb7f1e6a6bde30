"""Near duplicates among vectors by cosine.

Spherical k-means, fitted on about ``FIT_ROWS`` vectors taken by a hash, splits
unit vectors into about sqrt(n) cells.  Every vector is at home in the cell of
its nearest centre.  A pair beyond the threshold may lie in two cells; then each
of the two vectors visits the cell of the other.  Which visits are needed follows
from the centres exactly: if y at home in b has a partner at home in a within the
angle t,

    y.(c_b - c_a) <= tan(t) * |part of (c_b - c_a) across y|

so no link is lost, whatever the centres.

Vectors are moved and written once, by cell, in blocks of at most about ``BLOCK``.
Visits are never rows: pairs of blocks come from the files of the blocks, those
whose members visit each other's cells, and of these only the visitors are
multiplied.  The product is of leading coordinates in a basis of the centres,
with the length of the rest, which bounds the cosine from above; pairs that the
bound admits are judged in double precision.  A block product gives, for each
vector, the rows it links to and the smallest member of its group in this
product, never the pairs.  Equal vectors are one node of a block, up to
``MOST_COPIES`` of them; nodes with equal vectors link like others.

Vectors that are null, empty or zero, or have a null or non-finite component,
link with nothing; vectors of different lengths do not link; rows without
``vec_id`` take no part and have null results.  Rows that repeat a ``vec_id`` with
the same vector link with each other and with themselves as equal vectors do.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from trafficlens.llm.arrow import small_batches
from trafficlens.llm.components import components
from trafficlens.session import staged

LEAST_COSINE = 0.9
FIT_ROWS = 20_000
MOST_CELLS = 2_000
BLOCK = 8192
BLOCK_BYTES = 4 << 20
MOST_COPIES = 1 << 16
ROUNDS = 5
# Rows of two blocks that are multiplied at once, and bytes of blocks that a task keeps.
TILE = (1024, 1024)
KEPT = 48 << 20
# Above this share of its pairs a product is made in double precision as a whole.
MANY = 0.02


def _usable(vector: str) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1)[:, None]
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


# -- cells ---------------------------------------------------------------------


def centres(vectors: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres of spherical k-means over ``vector``, and the rows expected at each."""
    cells = int(min(MOST_CELLS, max(1, round(count**0.5))))
    step = max(1, round(count / FIT_ROWS))
    scaled = F.transform("vector", lambda x: x / F.array_max(F.transform("vector", F.abs)))
    length = F.sqrt(F.aggregate("unit", F.lit(0.0), lambda a, x: a + x * x))
    sample = staged(
        vectors.filter(F.pmod(F.xxhash64(F.lit("cells"), "vector"), F.lit(step)) == 0)
        .select(F.col("vector").cast("array<double>"))
        .distinct()
        .withColumn("unit", scaled)
        .select(array_to_vector(F.transform("unit", lambda x: x / length)).alias("features")),
        "vectors",
    )
    if cells == 1 or sample.limit(cells + 1).count() <= cells:
        first = np.array([vectors.select("vector").first()["vector"]])
        return _units(first), np.array([count])
    fitted = KMeans(k=cells, distanceMeasure="cosine", maxIter=ROUNDS, seed=11).fit(sample)
    found = np.array(fitted.clusterCenters())
    sizes = np.array(fitted.summary.clusterSizes) * step
    return found / np.maximum(np.linalg.norm(found, axis=1), 1e-12)[:, None], sizes


class _Visits:
    """Which vectors may have a partner at home in a cell."""

    def __init__(self, middle: np.ndarray, least: float) -> None:
        self.middle = middle
        self.tangent = np.sqrt(1 - least**2) / least
        self.apart = 2 - 2 * middle @ middle.T  # squared distances of centres

    def own(self, unit: np.ndarray, home: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", unit, self.middle[home])

    def of(self, unit: np.ndarray, home: np.ndarray, own: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """A row per vector, a column per cell of ``cells``."""
        along = own[:, None] - unit @ self.middle[cells].T
        across = np.sqrt(np.maximum(self.apart[home[:, None], cells] - along**2, 0))
        return (along <= self.tangent * across + 1e-9) | (home[:, None] == cells)


def _fixed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    data = np.ascontiguousarray(rows)
    ends = np.arange(len(data) + 1, dtype=np.int64) * data[:1].nbytes
    return pa.Array.from_buffers(
        pa.large_binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)]
    ).cast(pa.binary())


PLACED = "bucket long, mark long, first long, others binary, vector binary"


def _place(middle: np.ndarray, parts: np.ndarray, kind: str):
    """Vectors with their cells; equal ones of a batch are one row.

    A cell expected to be large has several buckets; equal vectors share theirs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("vec_id").to_numpy()
            mark = batch.column("mark").to_numpy()
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(len(ids), -1).astype(kind) + np.zeros(1, kind)  # no -0.0
            order = np.lexsort((ids, mark))
            ids, mark, vectors = ids[order], mark[order], vectors[order]
            new = np.ones(len(ids), bool)
            maybe = np.flatnonzero(mark[1:] == mark[:-1]) + 1
            new[maybe] = (vectors[maybe] != vectors[maybe - 1]).any(axis=1)
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(ids))
            others = [None] * len(start)
            for at in np.flatnonzero(end - start > 1).tolist():
                others[at] = ids[start[at] + 1 : end[at]].tobytes()
            mark, vectors = mark[start], vectors[start]
            home = np.concatenate(
                [
                    (_units(vectors[low : low + 1024]) @ middle.T).argmax(axis=1)
                    for low in range(0, len(vectors), 1024)
                ]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(home << 32 | mark % parts[home]),
                    pa.array(mark),
                    pa.array(ids[start]),
                    pa.array(others, pa.binary()),
                    _fixed(vectors),
                ],
                ["bucket", "mark", "first", "others", "vector"],
            )

    return run


BLOCKS = (
    "block long, cells array<int>, visited array<int>, nodes binary, copies binary, homes binary, "
    "vectors binary, vec_id array<long>, node array<long>, more array<long>"
)


def _pack(visits: _Visits, kind: str, most: int):
    """Rows in the order of bucket and mark become blocks; equal vectors become nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        vectors: list[bytes] = []
        homes: list[int] = []
        members: list[list[np.ndarray]] = []
        held = here = 0  # ids of the block and of its last node

        def block() -> pa.RecordBatch:
            home = np.array(homes, np.int32)
            ids = [np.concatenate(parts) for parts in members]
            copies = np.array([len(x) for x in ids], np.int64)
            nodes = np.array([x[0] for x in ids], np.int64)
            data = b"".join(vectors)
            unit = _units(np.frombuffer(data, kind).reshape(len(home), -1))
            own = visits.own(unit, home)
            every = np.arange(len(visits.middle))
            visited = np.zeros(len(every), bool)
            for low in range(0, len(unit), 1024):
                some = slice(low, low + 1024)
                visited |= visits.of(unit[some], home[some], own[some], every).any(axis=0)
            lists = [
                np.unique(home),
                np.flatnonzero(visited).astype(np.int32),
                np.concatenate(ids),
                np.repeat(nodes, copies),
                np.repeat(copies - 1, copies),
            ]
            cells, reach, vec_id, node, more = (
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in lists
            )
            binary = [pa.array([x], pa.binary()) for x in (nodes.tobytes(), copies.tobytes(), home.tobytes(), data)]
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), cells, reach, *binary, vec_id, node, more],
                "block cells visited nodes copies homes vectors vec_id node more".split(),
            )

        for batch in batches:
            columns = (batch.column(c) for c in ("bucket", "first", "others", "vector"))
            for bucket, first, others, vector in zip(*(c.to_pylist() for c in columns)):
                ids = np.array([first], np.int64)
                if others is not None:
                    ids = np.append(ids, np.frombuffer(others, np.int64))
                equal = bool(vectors) and vector == vectors[-1] and homes[-1] == bucket >> 32
                # An id that starts two nodes would count what both link to.
                if equal and (here < MOST_COPIES or members[-1][0][0] == first):
                    members[-1].append(ids)
                    here += len(ids)
                    held += len(ids)
                    continue
                if len(vectors) >= most or held >= 4 * MOST_COPIES:
                    yield block()
                    number += 1
                    vectors, homes, members, held = [], [], [], 0
                vectors.append(vector)
                homes.append(bucket >> 32)
                members.append([ids])
                here = len(ids)
                held += here
        if vectors:
            yield block()

    return run


# -- products ------------------------------------------------------------------


def leading(middle: np.ndarray, least: float) -> np.ndarray:
    """Columns: so many orthonormal directions, those of the centres first, that the
    bound admits few pairs even of vectors without structure."""
    dims = middle.shape[1]
    spread = 3.7 / dims**0.5
    share = ((spread + (spread**2 + 4 * (1 - least)) ** 0.5) / 2) ** 2
    count = int(np.ceil(dims * share))
    if count >= 0.8 * dims:
        return np.eye(dims)
    _, _, rows = np.linalg.svd(middle, full_matrices=False)
    basis, _ = np.linalg.qr(np.hstack([rows.T, np.eye(dims)[:, : max(0, count - len(rows))]]))
    return basis[:, :count]


class _Block:
    """A block as a product needs it."""

    def __init__(self, row: dict, kind: str, basis: np.ndarray, visits: _Visits) -> None:
        self.home = np.frombuffer(row["homes"], np.int32).copy()
        self.cells = np.unique(self.home)
        self.nodes = np.frombuffer(row["nodes"], np.int64).copy()
        self.copies = np.frombuffer(row["copies"], np.int64).copy()
        self.unit = _units(np.frombuffer(row["vectors"], kind).reshape(len(self.home), -1))
        self.own = visits.own(self.unit, self.home)
        lead = self.unit @ basis
        rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", lead, lead), 0))
        self.lead = np.column_stack([lead, rest]).astype(np.float32)
        self.size = self.unit.nbytes + self.lead.nbytes


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of ``a`` and ``b``; a group's label is its least."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _links_of(one: _Block, two: _Block, same: bool, visits: _Visits, least: float):
    """Node, links and root of every node that links with one of the other block."""
    mine = np.flatnonzero(visits.of(one.unit, one.home, one.own, two.cells).any(axis=1))
    theirs = np.flatnonzero(visits.of(two.unit, two.home, two.own, one.cells).any(axis=1))
    width = one.lead.shape[1]
    # Single precision errs by less than this; the rest is judged in double.
    floor = np.float32(least - (width + 8) * 2.0**-22)
    nodes = one.nodes if same else np.concatenate([one.nodes, two.nodes])
    copies = one.copies if same else np.concatenate([one.copies, two.copies])
    behind = 0 if same else len(one.nodes)
    label = links = None
    bounds = np.empty(TILE[0] * TILE[1], np.float32)
    admitted = np.empty(bounds.shape, bool)
    for low, left in product(range(0, len(mine), TILE[0]), range(0, len(theirs), TILE[1])):
        rows, columns = mine[low : low + TILE[0]], theirs[left : left + TILE[1]]
        if same and rows[0] > columns[-1]:
            continue
        shape = len(rows), len(columns)
        bound = bounds[: shape[0] * shape[1]].reshape(shape)
        np.matmul(one.lead[rows], two.lead[columns].T, out=bound)
        hit = np.flatnonzero(np.greater_equal(bound.ravel(), floor, out=admitted[: bound.size]))
        if not len(hit):
            continue
        if len(hit) > bound.size * MANY:
            hit = np.flatnonzero(one.unit[rows] @ two.unit[columns].T >= least)
            a, b = rows[hit // len(columns)], columns[hit % len(columns)]
        else:
            a, b = rows[hit // len(columns)], columns[hit % len(columns)]
            near = np.einsum("ij,ij->i", one.unit[a], two.unit[b]) >= least
            a, b = a[near], b[near]
        if same:
            later = a < b
            a, b = a[later], b[later]
        b = b + behind
        if not len(a):
            continue
        if label is None:
            rank = np.empty(len(nodes), np.int64)
            order = np.argsort(nodes, kind="stable")
            rank[order] = np.arange(len(nodes))
            label, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        label = united(label, rank[a], rank[b])
    if label is None:
        return None
    hit = np.flatnonzero(links)
    return nodes[hit], links[hit], nodes[order[label[rank[hit]]]]


def _product(visits: _Visits, basis: np.ndarray, kind: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, _Block] = OrderedDict()
        size = 0
        for batch in batches:
            for at in range(batch.num_rows):
                pair = []
                for side in ("", "other_"):
                    number = batch.column(f"{side}block")[at].as_py()
                    if number not in kept:
                        row = {c: batch.column(side + c)[at].as_buffer() for c in _DATA}
                        kept[number] = _Block(row, kind, basis, visits)
                        size += kept[number].size
                    kept.move_to_end(number)
                    pair.append((number, kept[number]))
                while size > KEPT and len(kept) > 2:
                    size -= kept.popitem(last=False)[1].size
                (first, one), (second, two) = pair
                found = _links_of(one, two, first == second, visits, least)
                if found is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in found], ["node", "links", "root"]
                    )

    return run


_DATA = ("nodes", "copies", "homes", "vectors")
FOUND = "node long, links long, root long"


def _pairs(blocks: DataFrame) -> DataFrame:
    """Pairs of blocks whose members visit each other's cells, a block with itself too.

    Read from the blocks' files again and again, so nothing is copied on disk.  Of
    two blocks the sum of their numbers says which comes first, which spreads the
    pairs evenly over the pairs of file parts.
    """
    names = ("block", "cells", "visited", *_DATA)
    one = blocks.select(*names)
    two = blocks.select(*[F.col(c).alias(f"other_{c}") for c in names])
    turn = (F.col("block") < F.col("other_block")) == ((F.col("block") + F.col("other_block")) % 2 == 0)
    once = (F.col("block") == F.col("other_block")) | ((F.col("block") != F.col("other_block")) & turn)
    meet = F.arrays_overlap("visited", "other_cells") & F.arrays_overlap("other_visited", "cells")
    return one.join(two.hint("shuffle_replicate_nl"), once & meet, "inner").select(
        *[side + c for side in ("", "other_") for c in ("block", *_DATA)]
    )


def _compared(rows: DataFrame, dims: int, count: int, least: float, block: int):
    """For vectors of one length their blocks, and per node and block product the
    linked rows and the smallest of its group."""
    rows = rows.filter(F.size("vector") == dims)
    kind = "<f4" if rows.schema["vector"].dataType == ArrayType(FloatType()) else "<f8"
    middle, sizes = centres(rows, count)
    most = max(2, min(block, BLOCK_BYTES // (dims * np.dtype(kind).itemsize)))
    parts = np.maximum(1, -(-sizes // most))
    visits = _Visits(middle, least)
    placed = small_batches(rows.withColumn("mark", F.xxhash64("vector"))).mapInArrow(
        _place(middle, parts, kind), PLACED
    )
    blocks = staged(
        placed.repartition("bucket")
        .sortWithinPartitions("bucket", "mark", "first")
        .mapInArrow(_pack(visits, kind, most), BLOCKS),
        "blocks",
    )
    compare = _product(visits, leading(middle, least), kind, least)
    return blocks, _pairs(blocks).mapInArrow(compare, FOUND)


def near_duplicates(
    vectors: DataFrame, least: float = LEAST_COSINE, block: int = BLOCK
) -> DataFrame:
    """Per row ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, ArrayType) and kind.elementType == FloatType()
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"),
    )
    usable = F.col("vec_id").isNotNull() & _usable("vector")
    valid = rows.filter(usable)
    lengths = valid.groupBy(F.size("vector").alias("dims")).count().orderBy("dims").collect()
    found = spark.createDataFrame([], FOUND)
    members = spark.createDataFrame([], "vec_id long, node long, more long")
    for row in lengths:
        blocks, part = _compared(valid, row["dims"], row["count"], least, block)
        found = found.union(part)
        each = F.explode(F.arrays_zip("vec_id", "node", "more")).alias("row")
        members = members.union(blocks.select(each).select("row.*"))
    found = staged(found, "products")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = (
        members.join(links, "node", "left")
        .join(groups, "node", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.col("more")).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
        )
    )
    alone = rows.filter(~usable).select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.lit(0)).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
    )
    return joined.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))

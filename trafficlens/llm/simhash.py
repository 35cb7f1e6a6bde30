"""Near copies by SimHash fingerprints and pigeonring filtering.

Fingerprints at most ``distance`` bits apart are linked.  The 64 bits form a
ring of equal segments; of two fingerprints within the distance, some segment
begins a chain whose first l segments differ in at most l * distance / segments
bits, for every l.  While that budget is below one, the chain's segments are
equal: they are the key under which candidates meet.  The longer chains are
checked before the full distance.

A key shared by more than ``BUCKET`` different fingerprints is refined: the bits
outside the key are split in ``distance + 1`` parts, one of which must be equal
too.  After a few such steps a key leaves so few bits that a bucket is bounded
by their combinations, so no group grows with the data and no pair is lost.
Equal fingerprints are one node, and a bucket returns a spanning forest of its
links instead of pairs.

Null and empty texts have fingerprint zero and are linked like any other; rows
with a null ``doc_id`` get a fingerprint but never name a component unless all
its documents lack an id; rows of a repeated ``doc_id`` each keep their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.arrow import small_batches, utf8, word_blocks
from trafficlens.llm.components import components, group_roots
from trafficlens.session import staged

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 2
SEGMENTS = 16
BUCKET = 2048

_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, words: int = SHINGLE) -> Iterator[list[int]]:
    """XXH64 of every word shingle, block by block; a short text is one shingle."""
    from xxhash import xxh64_intdigest as digest

    carry: list[bytes] = []
    seen = False
    for block in word_blocks(text.lower()):
        block = carry + block
        if len(block) >= words:
            joined = b" ".join(block)
            ends = list(accumulate(map(len, block), lambda at, n: at + 1 + n))
            starts = [0, *[at + 1 for at in ends[:-1]]]
            yield [digest(joined[i:j], SEED) for i, j in zip(starts, ends[words - 1 :])]
            seen = True
            carry = block[len(block) - words + 1 :]
        else:
            carry = block
    if not seen and carry:
        yield [digest(b" ".join(carry), SEED)]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, counted in byte lanes."""
    counts = np.zeros((8, 8), np.int64)
    starts = np.arange(0, len(hashes), 255)
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & _LANES
        sums = np.add.reduceat(lanes, starts)
        counts[:, bit] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(-1)


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """The bits set in over half of the shingle hashes, as an unsigned number."""
    counts, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, words):
        counts += bit_counts(np.array(hashes, np.uint64))
        total += len(hashes)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id`` and signed 64-bit ``fp`` per row of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = utf8(batch.column("text"))
            found = [
                fingerprint(data[ends[i] : ends[i + 1]].tobytes(), words)
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))],
                ["doc_id", "fp"],
            )

    texts = small_batches(docs.select(F.col("doc_id").cast("long"), "text"))
    return texts.mapInArrow(run, "doc_id long, fp long")


def chains(segments: int = SEGMENTS, distance: int = DISTANCE) -> list[list[tuple[int, int]]]:
    """For each start on the ring: (mask, allowed difference) of chains by length."""
    width = BITS // segments
    found = []
    for start in range(segments):
        mask, chain = 0, []
        for length in range(1, segments + 1):
            at = (start + length - 1) % segments
            mask |= ((1 << width) - 1) << (at * width)
            chain.append((mask, length * distance // segments))
        found.append(chain)
    return found


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def first_keys(segments: int = SEGMENTS, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(chain start, mask of the segments that must be equal)."""
    return [
        (start, max((mask for mask, most in chain if most == 0), key=int.bit_count))
        for start, chain in enumerate(chains(segments, distance))
    ]


def refined(mask: int, distance: int = DISTANCE) -> list[int]:
    """Masks that add one of ``distance + 1`` parts of the bits outside ``mask``."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    parts = np.array_split(np.array(free, object), distance + 1)
    return [mask | sum(1 << int(bit) for bit in part) for part in parts if len(part)]


def linked(values: np.ndarray, chain: list[tuple[int, int]], distance: int) -> np.ndarray:
    """For each fingerprint of a bucket the position of its group's smallest one."""
    n = len(values)
    near = np.zeros((n, n), bool)
    tests = [(np.uint64(m), most) for m, most in chain if most > 0]
    for at in range(0, n, 256):
        differ = values[at : at + 256, None] ^ values[None, :]
        rows, cols = np.nonzero(np.bitwise_count(differ & tests[0][0]) <= tests[0][1])
        left = differ[rows, cols]
        for mask, most in [*tests[1:], (np.uint64(2**BITS - 1), distance)]:
            keep = np.bitwise_count(left & mask) <= most
            rows, cols, left = rows[keep], cols[keep], left[keep]
        near[at + rows, cols] = True
    near |= near.T
    return group_roots(near)


def _forest(segments: int, distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = chains(segments, distance)
        for batch in batches:
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            starts = batch.column("chain").to_pylist()
            members = batch.column("members")
            for start, held in zip(starts, members):
                values = np.sort(held.values.to_numpy(zero_copy_only=False).view(np.uint64))
                root = linked(values, every[start], distance)
                hung = np.flatnonzero(root != np.arange(len(root)))
                a.append(values[hung].view(np.int64))
                b.append(values[root[hung]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
            )

    return run


def _keyed(rows: DataFrame, keys: Column) -> DataFrame:
    """A row for each key of a fingerprint: chain start, mask and the masked bits."""
    return rows.withColumn("key", F.explode(keys)).select(
        "fp",
        F.col("key.chain").alias("chain"),
        F.col("key.mask").alias("mask"),
        F.col("fp").bitwiseAND(F.col("key.mask")).alias("bits"),
    )


def _key(chain: int, mask: int) -> Column:
    return F.struct(F.lit(chain).alias("chain"), F.lit(_signed(mask)).cast("long").alias("mask"))


def near_links(
    fps: DataFrame,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
    bucket: int = BUCKET,
) -> DataFrame:
    """A spanning forest (``a``, ``b``) of the links between distinct fingerprints ``fp``."""
    by = ["chain", "mask", "bits"]
    masks = first_keys(segments, distance)
    keys = _keyed(fps, F.array(*[_key(c, m) for c, m in masks]))
    edges = None
    while True:
        shared = staged(
            keys.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets"
        )
        left = BITS - max(mask.bit_count() for _, mask in masks)
        last = left <= max(bucket, 2).bit_length() - 1
        fits = shared if last else shared.filter(F.col("n") <= bucket)
        found = (
            keys.join(fits.drop("n"), by)
            .groupBy(*by)
            .agg(F.collect_list("fp").alias("members"))
            .select("chain", "members")
            .mapInArrow(_forest(segments, distance), "a long, b long")
        )
        edges = found if edges is None else edges.union(found)
        wide = shared.filter(F.col("n") > bucket)
        if last or wide.isEmpty():
            return edges
        finer = F.create_map(
            *[
                part
                for c, m in masks
                for part in (_key(c, m), F.array(*[_key(c, x) for x in refined(m, distance)]))
            ]
        )
        keys = _keyed(
            keys.join(wide.drop("n"), by).select("fp", "chain", "mask"),
            finer[F.struct("chain", "mask")],
        )
        masks = [(c, x) for c, m in masks for x in refined(m, distance)]


def near_copies(
    docs: DataFrame,
    words: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` per row of documents."""
    marked = staged(fingerprints(docs, words), "fingerprints")
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    groups = staged(components(near_links(nodes.select("fp"), distance, segments)), "groups")
    rooted = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )

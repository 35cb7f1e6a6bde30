"""Repeated byte strings by sorted suffixes.

A byte goes if it lies in a ``WINDOW``-byte string that also starts in a
document with a smaller ``doc_id``.  Sorting the suffixes of all positions
would move the corpus many times, so suffixes start at anchors only: of each
window, the leftmost of its ``GRAM``-byte strings with the least hash.  Equal
windows have their anchor at the same place, so windows that meet nowhere in an
anchor are not equal, and the result is that of all suffixes.

1. Documents are packed in chunks, compressed, in the shared folder.
2. Anchors that occur in one document only are dropped: 32-bit fingerprints of
   the anchors' hashes, one per chunk, meet in hash buckets.  A collision keeps
   an anchor for nothing and changes no result.
3. The other suffixes, with the bytes that their windows span, are partitioned
   by range of their leading bytes, at splitters sampled from the chunks.  A
   chunk sends a context once per smallest document; its other copies are
   decided at home, so that a passage in any share of all documents sends a
   bounded number of suffixes per chunk.
4. A bucket sorts its suffixes by multikey quicksort, word by word, and the
   bytes before them likewise.  Classes of equal windows are read off the
   longest common prefixes of neighbours in both orders.  Splitters fall only
   between different leading bytes: neighbours across a boundary share less than
   ``GRAM`` bytes, which ``boundary_prefix`` checks, and can share no window.
   Leading bytes whose suffixes would fill a bucket (counted on the sampled
   chunks) are parted by window instead: a chunk sends each of their windows once
   per smallest document to a bucket by the window's hash, so that no bucket has
   more than the chunks hold of one window.
5. The removed spans go back to the chunks.

Null text is empty; texts shorter than the window keep all bytes; a null
``doc_id`` counts as larger than any other; rows of equal ``doc_id`` do not
remove each other's bytes.  Columns of documents are kept, new columns replace
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.arrow import small_batches, utf8
from trafficlens.session import staged

WINDOW = 50
GRAM = 20
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
SAMPLE_CHUNKS = 64
SAMPLE_HEADS = 256
SLICE_BYTES = 1 << 19

_REACH = WINDOW - GRAM
_SPAN = _REACH + WINDOW
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 24) - 1)
_LAST_ID = np.iinfo(np.int64).max


# -- chunks ---------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        _, ends = utf8(batch.column("text"))
        row = 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[row] + CHUNK_BYTES, "right")) - 1
            stop = min(max(stop, row + 1), batch.num_rows)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                writer.write_batch(batch.slice(row, stop - row))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()),
                    pa.array([int(ends[stop] - ends[row])], pa.int64()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                ["chunk", "size", "payload"],
            )
            chunk += 1
            row = stop


def _unpack(payload: pa.Scalar) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload.as_buffer()) as reader:
        return reader.read_next_batch()


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    ids = batch.column("doc_id").cast(pa.int64()).fill_null(_LAST_ID)
    return ids.to_numpy(zero_copy_only=False)


# -- anchors --------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position on."""
    with np.errstate(over="ignore"):
        width, power = 1, _BASE
        have = {1: (data.astype(np.uint64) + np.uint64(1)) * _MIX}
        powers = {1: power}
        while width * 2 <= GRAM:
            half = have[width]
            have[width * 2] = half[:-width] * powers[width] + half[width:]
            powers[width * 2] = powers[width] * powers[width]
            width *= 2
        found, length = have[width], width
        for part in sorted(have, reverse=True):
            if length + part <= GRAM:
                n = len(data) - length - part + 1
                found = found[:n] * powers[part] + have[part][length : length + n]
                length += part
        found = found ^ (found >> np.uint64(32))
        found *= _MIX
        return found ^ (found >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of documents that lie one after the other from ``ends[0]`` on.

    ``at`` (position), ``row``, ``hash``, and ``least`` and ``most``: a window
    of this anchor starts that many bytes before it.
    """
    start, stop = int(ends[0]), int(ends[-1])
    parts = []
    for low in range(start, stop, SLICE_BYTES):
        piece = data[low : min(stop, low + SLICE_BYTES + WINDOW - 1)]
        if len(piece) < WINDOW:
            break
        hashes = gram_hashes(piece)
        places = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        chosen = (_sliding_min(places, _REACH + 1) & _PLACE).astype(np.int64)
        begin = np.arange(len(chosen)) + low
        row = np.searchsorted(ends, begin, "right") - 1
        whole = begin + WINDOW <= ends[row + 1]
        begin, chosen, row = begin[whole], chosen[whole], row[whole]
        new = np.flatnonzero(np.diff(chosen, prepend=-1))
        if not len(new):
            continue
        final = np.append(new[1:], len(chosen)) - 1
        place = chosen[new]
        parts.append(
            {
                "at": place + low,
                "row": row[new],
                "hash": hashes[place],
                "least": place + low - begin[final],
                "most": place + low - begin[new],
            }
        )
    names = ("at", "row", "hash", "least", "most")
    kinds = (np.int64, np.int64, np.uint64, np.int64, np.int64)
    return {
        name: np.concatenate([np.empty(0, kind), *[part[name] for part in parts]])
        for name, kind in zip(names, kinds)
    }


# -- anchors in more than one document --------------------------------------


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _offer(buckets: int):
    """Per chunk and bucket the fingerprints in one document, and in several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk"), batch.column("payload")):
                held = _unpack(payload)
                found = anchors(*utf8(held.column("text")))
                ids = _ids(held)[found["row"]]
                hashes = found["hash"]
                order = np.argsort(hashes, kind="stable")
                hashes, ids = hashes[order], ids[order]
                first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
                if not len(first):
                    continue
                several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
                hashes = hashes[first]
                place = _bucket(hashes, buckets)  # ascending, as hashes are
                cuts = np.flatnonzero(np.diff(place, prepend=-1))
                values = hashes.astype(np.uint32)
                spans = list(zip(cuts, [*cuts[1:], len(place)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place[cuts].astype(np.int64)),
                        pa.array([chunk.as_py()] * len(cuts), pa.int64()),
                        pa.array([values[a:b][~several[a:b]].tobytes() for a, b in spans]),
                        pa.array([values[a:b][several[a:b]].tobytes() for a, b in spans]),
                    ],
                    ["bucket", "chunk", "once", "often"],
                )

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """The fingerprints of each chunk that are in several documents."""
    once, often = (
        [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column(name)]
        for name in ("once", "often")
    )
    parts = [values for pair in zip(once, often) for values in pair]
    sizes = [len(values) for values in parts]
    values = np.concatenate(parts)
    surely = np.repeat(np.arange(len(parts)) % 2 == 1, sizes)
    order = np.argsort(values, kind="stable")
    first = np.flatnonzero(np.diff(values[order].astype(np.int64), prepend=-1))
    many = np.diff(np.append(first, len(values))) > 1
    many |= np.logical_or.reduceat(surely[order], first)
    repeated = np.empty(len(values), bool)
    repeated[order] = np.repeat(many, np.diff(np.append(first, len(values))))
    ends = np.cumsum([0, *sizes])[::2]
    chunks, blobs = [], []
    for chunk, start, stop in zip(table.column("chunk").to_pylist(), ends, ends[1:]):
        both = values[start:stop][repeated[start:stop]]
        if len(both):
            chunks.append(chunk)
            blobs.append(both.tobytes())
    bucket = table.column("bucket")[0].as_py()
    return pa.table(
        {
            "chunk": pa.array(chunks, pa.int64()),
            "bucket": pa.array([bucket] * len(chunks), pa.int64()),
            "values": pa.array(blobs, pa.binary()),
        }
    )


# -- suffixes ----------------------------------------------------------------

_SUFFIX = np.dtype(
    [
        ("head", f"S{GRAM}"),
        ("rest", f"V{WINDOW - GRAM}"),
        ("left", f"V{_REACH}"),
        ("id", np.int64),
        ("row", np.uint32),
        ("at", np.uint32),
        ("least", np.uint8),
        ("most", np.uint8),
    ]
)
_WINDOW = np.dtype(
    [("window", f"V{WINDOW}"), ("id", np.int64), ("row", np.uint32), ("start", np.uint32)]
)
_CUT = np.dtype([("row", np.uint32), ("start", np.uint32), ("end", np.uint32)])


def contexts(
    data: np.ndarray, ends: np.ndarray, ids: np.ndarray, found: dict[str, np.ndarray]
) -> np.ndarray:
    """The suffixes of anchors with the bytes that their windows span, else zero."""
    out = np.zeros(len(found["at"]), _SUFFIX)
    bytes_of = out.view(np.uint8).reshape(len(out), _SUFFIX.itemsize)
    after, before = np.arange(WINDOW), np.arange(1, _REACH + 1)
    for low in range(0, len(out), 1 << 14):
        some = slice(low, low + (1 << 14))
        at, least, most = (found[name][some, None] for name in ("at", "least", "most"))
        right = data[np.minimum(at + after, len(data) - 1)]
        left = data[np.maximum(at - before, 0)]
        bytes_of[some, :WINDOW] = np.where(after < WINDOW - least, right, 0)
        bytes_of[some, WINDOW:_SPAN] = np.where(before <= most, left, 0)
    at, least, most = found["at"], found["least"], found["most"]
    out["id"], out["row"] = ids[found["row"]], found["row"]
    out["at"] = at - ends[found["row"]]
    out["least"], out["most"] = least, most
    return out


def _spans(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bytes of windows starting ``low`` to ``high`` before the anchors."""
    cuts = np.empty(len(rows), _CUT)
    cuts["row"] = rows["row"]
    cuts["start"] = rows["at"] - high
    cuts["end"] = rows["at"] - low + WINDOW
    return cuts


def decide_at_home(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that still have to be compared, and spans decided in this chunk.

    Of equal contexts only those of the smallest document are compared further.
    """
    if not len(rows):
        return rows, np.empty(0, _CUT)
    raw = rows.view(np.uint8).reshape(len(rows), _SUFFIX.itemsize)
    key = np.concatenate([raw[:, :_SPAN], raw[:, -2:]], axis=1)
    wide = np.zeros((len(rows), 88), np.uint8)
    wide[:, : key.shape[1]] = key
    words = wide.view(np.uint64)
    mixed = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for col in range(words.shape[1]):
            mixed = (mixed ^ words[:, col]) * _MIX
            mixed ^= mixed >> np.uint64(31)
    order = np.lexsort((rows["id"], mixed))
    words, ids = words[order], rows["id"][order]
    new = np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)])
    first = np.flatnonzero(new)
    later = ids > ids[first][np.cumsum(new) - 1]
    gone = rows[order[later]]
    return rows[order[~later]], _spans(gone, gone["least"], gone["most"])


def _heads(splits: int):
    """A few leading byte strings of the sampled chunks, without ``n``; those that
    have several contexts in a chunk with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                held = _unpack(payload)
                data, ends = utf8(held.column("text"))
                found = anchors(data, ends)
                take = found["at"][np.argsort(found["hash"])[:splits]]
                some = [data[a : a + GRAM].tobytes() for a in take]
                _, where, times = np.unique(found["hash"], return_inverse=True, return_counts=True)
                often = times[where] > 1
                found = {name: values[often] for name, values in found.items()}
                rows, _ = decide_at_home(contexts(data, ends, _ids(held), found))
                raw = rows.view(np.uint8).reshape(len(rows), _SUFFIX.itemsize)
                order = multikey_order(raw[:, :GRAM]) if len(rows) else np.empty(0, np.int64)
                first = np.flatnonzero(common_prefixes(raw[order, :GRAM]) < GRAM) if len(rows) else order
                n = np.diff(np.append(first, len(rows)))
                several = first[n > 1]
                some += [raw[i, :GRAM].tobytes() for i in order[several]]
                numbers = [None] * len(take) + n[n > 1].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.binary()), pa.array(numbers, pa.int64())], ["head", "n"]
                )

    return run


def windows_of(rows: np.ndarray, offset: int) -> np.ndarray:
    """The windows that start ``offset`` bytes before the anchors."""
    rows = rows[(rows["least"] <= offset) & (offset <= rows["most"])]
    raw = rows.view(np.uint8).reshape(len(rows), _SUFFIX.itemsize)
    line = np.concatenate([raw[:, WINDOW:_SPAN][:, ::-1], raw[:, :WINDOW]], axis=1)
    out = np.zeros(len(rows), _WINDOW)
    out.view(np.uint8).reshape(len(rows), _WINDOW.itemsize)[:, :WINDOW] = line[
        :, _REACH - offset : _SPAN - offset
    ]
    out["id"], out["row"], out["start"] = rows["id"], rows["row"], rows["at"] - offset
    return out


def later(found: np.ndarray) -> np.ndarray:
    """Of each window, if it is also in a smaller document."""
    if not len(found):
        return np.empty(0, bool)
    raw = found.view(np.uint8).reshape(len(found), _WINDOW.itemsize)[:, :WINDOW]
    order = multikey_order(raw)
    first = np.flatnonzero(common_prefixes(raw[order]) < WINDOW)
    ids = found["id"][order]
    least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(ids))))
    gone = np.empty(len(found), bool)
    gone[order] = ids > least
    return gone


def _window_cuts(found: np.ndarray) -> np.ndarray:
    cuts = np.empty(len(found), _CUT)
    cuts["row"], cuts["start"], cuts["end"] = found["row"], found["start"], found["start"] + WINDOW
    return cuts


def split_windows(rows: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows to compare elsewhere, the part of each by its hash, and spans decided here."""
    opened, cuts = [np.empty(0, _WINDOW)], [np.empty(0, _CUT)]
    for offset in range(_REACH + 1):  # equal windows have their anchor at the same place
        found = windows_of(rows, offset)
        gone = later(found)
        opened.append(found[~gone])
        cuts.append(_window_cuts(found[gone]))
    found = np.concatenate(opened)
    raw = found.view(np.uint8).reshape(len(found), _WINDOW.itemsize)
    mixed = np.zeros(len(found), np.uint64)
    with np.errstate(over="ignore"):
        for column in range(WINDOW):
            mixed = (mixed ^ raw[:, column]) * _MIX
            mixed ^= mixed >> np.uint64(31)
    return found, (mixed % np.uint64(parts)).astype(np.int64), np.concatenate(cuts)


def _parts(order: np.ndarray, place: np.ndarray, rows: np.ndarray) -> list[tuple[int, bytes]]:
    place, rows = place[order], rows[order]
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    return [
        (int(place[a]), rows[a:b].tobytes()) for a, b in zip(starts, [*starts[1:], len(place)])
    ]


def home_bucket(chunk: int) -> int:
    """A negative bucket for each chunk, so that decided spans are spread like chunks."""
    return -1 - chunk


def _send(splitters: np.ndarray, buckets: int, hot: np.ndarray, parts: int):
    """Suffixes of a chunk by range bucket, then windows of hot heads by hash; decided
    spans under a negative bucket."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, rows = [], []
        if left.num_rows and right.num_rows:
            held = _unpack(left.column("payload")[0])
            data, ends = utf8(held.column("text"))
            found = anchors(data, ends)
            wanted = np.sort(
                np.concatenate(
                    [
                        (np.uint64(b) << np.uint64(32))
                        | np.frombuffer(v.as_buffer(), np.uint32).astype(np.uint64)
                        for b, v in zip(
                            right.column("bucket").to_pylist(), right.column("values")
                        )
                    ]
                )
            )
            hashes = found["hash"]
            mine = (_bucket(hashes, buckets) << np.uint64(32)) | hashes.astype(
                np.uint32
            ).astype(np.uint64)
            place = np.minimum(np.searchsorted(wanted, mine), len(wanted) - 1)
            keep = wanted[place] == mine
            found = {name: values[keep] for name, values in found.items()}
            open_rows, cuts = decide_at_home(contexts(data, ends, _ids(held), found))
            fills = np.isin(open_rows["head"], hot)
            windows, place, more = split_windows(open_rows[fills], parts)
            cuts = np.concatenate([cuts, more])
            open_rows = open_rows[~fills]
            ranges = np.searchsorted(splitters, open_rows["head"], "right")
            rows = _parts(np.argsort(ranges, kind="stable"), ranges, open_rows)
            place += len(splitters) + 1
            rows += _parts(np.argsort(place, kind="stable"), place, windows)
            chunk = left.column("chunk")[0].as_py()
            if len(cuts):
                rows.append((home_bucket(chunk), cuts.tobytes()))
        squeeze = pa.Codec("zstd", 3)
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in rows], pa.int64()),
                "chunk": pa.array([chunk] * len(rows), pa.int64()),
                "size": pa.array([len(blob) for _, blob in rows], pa.int64()),
                "suffixes": pa.array(
                    [squeeze.compress(blob, asbytes=True) for _, blob in rows], pa.binary()
                ),
            }
        )

    return run


# -- sorted buckets -----------------------------------------------------------


def multikey_order(text: np.ndarray) -> np.ndarray:
    """Order of byte strings of one length: eight bytes at a time, ties only."""
    n, width = text.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = text
    words = wide.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    new = np.ones(n, bool)
    new[1:] = np.diff(words[order, 0]) != 0
    for col in range(1, words.shape[1]):
        alone = new & np.append(new[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        rows = order[tied]
        rows = rows[np.lexsort((words[rows, col], group))]
        order[tied] = rows
        new[tied[1:]] |= np.diff(words[rows, col]) != 0
    return order


def common_prefixes(text: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each string and the one before it; first -1."""
    same = np.logical_and.accumulate(text[1:] == text[:-1], axis=1).sum(axis=1)
    return np.concatenate([[-1], same])


def boundary_prefix(before: bytes, after: bytes) -> int:
    """Bytes that the last string of a bucket and the first of the next share."""
    return next((i for i, (a, b) in enumerate(zip(before, after)) if a != b), len(before))


def judge(rows: np.ndarray) -> np.ndarray:
    """Removed spans among the suffixes of one bucket, with the suffix each is of."""
    raw = rows.view(np.uint8).reshape(len(rows), _SUFFIX.itemsize)
    order = multikey_order(raw[:, :WINDOW])
    rows, raw = rows[order], raw[order]
    prefix = common_prefixes(raw[:, :WINDOW])
    before = multikey_order(raw[:, WINDOW:_SPAN])
    back = common_prefixes(raw[before, WINDOW:_SPAN])
    low = np.full(len(rows), 255, np.uint8)
    high = np.zeros(len(rows), np.uint8)
    left_class = np.empty(len(rows), np.int64)
    for offset in range(_REACH + 1):
        valid = np.flatnonzero((rows["least"] <= offset) & (offset <= rows["most"]))
        if len(valid) < 2:
            continue
        right_class = np.cumsum(prefix < WINDOW - offset)
        left_class[before] = np.cumsum(back < offset)
        both = right_class[valid] * (len(rows) + 1) + left_class[valid]
        ids = rows["id"][valid]
        by = np.lexsort((ids, both))
        new = np.diff(both[by], prepend=-1) != 0
        least = ids[by][np.flatnonzero(new)][np.cumsum(new) - 1]
        gone = valid[by[ids[by] > least]]
        low[gone] = np.minimum(low[gone], offset)
        high[gone] = offset
    hit = low < 255
    back_to = np.empty(len(rows), np.int64)
    back_to[:] = order
    cuts = _spans(rows[hit], low[hit], high[hit])
    return back_to[hit], cuts


def _judged(ranges: int):
    """Removed spans of a bucket; windows are in the buckets from ``ranges`` on."""

    def run(table: pa.Table) -> pa.Table:
        squeeze = pa.Codec("zstd")
        blobs = [
            squeeze.decompress(x.as_buffer(), decompressed_size=n, asbytes=True)
            for x, n in zip(table.column("suffixes"), table.column("size").to_pylist())
        ]
        chunks = np.array(table.column("chunk").to_pylist(), np.int64)
        if table.column("bucket")[0].as_py() < 0:
            return pa.table({"chunk": pa.array(chunks), "cuts": pa.array(blobs, pa.binary())})
        whole = table.column("bucket")[0].as_py() >= ranges
        parts = [np.frombuffer(blob, _WINDOW if whole else _SUFFIX) for blob in blobs]
        owner = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
        rows = np.concatenate(parts)
        if whole:
            which = np.flatnonzero(later(rows))
            cuts = _window_cuts(rows[which])
        else:
            which, cuts = judge(rows)
        owner = owner[which]
        by = np.argsort(owner, kind="stable")
        owner, cuts = owner[by], cuts[by]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        return pa.table(
            {
                "chunk": pa.array(chunks[owner[first]]),
                "cuts": pa.array(
                    [cuts[a:b].tobytes() for a, b in zip(first, [*first[1:], len(cuts)])],
                    pa.binary(),
                ),
            }
        )

    return run


# -- results -------------------------------------------------------------------


def cut_out(
    data: np.ndarray, ends: np.ndarray, cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kept bytes, their ends, and per document removed bytes and runs."""
    base, size = int(ends[0]), int(ends[-1] - ends[0])
    begin = ends[cuts["row"]] - base
    depth = np.bincount(begin + cuts["start"], minlength=size + 1)[: size + 1]
    depth = depth - np.bincount(begin + cuts["end"], minlength=size + 1)[: size + 1]
    gone = np.cumsum(depth[:size]) > 0
    opens = gone.copy()
    if size:
        opens[1:] &= ~gone[:-1]
        starts = ends[:-1][np.diff(ends) > 0] - base
        opens[starts] = gone[starts]
    places = ends - base
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[places])
    runs = np.diff(np.concatenate([[0], np.cumsum(opens)])[places])
    kept_ends = np.concatenate([[0], np.cumsum(np.diff(ends) - removed)])
    return data[base : base + size][~gone], kept_ends, removed, runs


NEW_COLUMNS = ("kept", "n_bytes", "n_removed", "n_spans")


def _apply(names: list[str]):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        batch = _unpack(left.column("payload")[0])
        data, ends = utf8(batch.column("text"))
        cuts = np.concatenate(
            [np.empty(0, _CUT), *[np.frombuffer(x.as_buffer(), _CUT) for x in right.column("cuts")]]
        )
        kept, kept_ends, removed, runs = cut_out(data, ends, cuts)
        columns = {name: batch.column(name) for name in names}
        columns["kept"] = pa.Array.from_buffers(
            pa.large_binary(),
            batch.num_rows,
            [None, pa.py_buffer(kept_ends.astype(np.int64)), pa.py_buffer(kept)],
        ).cast(pa.binary())
        columns["n_bytes"] = pa.array(np.diff(ends), pa.int64())
        columns["n_removed"] = pa.array(removed, pa.int64())
        columns["n_spans"] = pa.array(runs, pa.int64())
        return pa.table(columns)

    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Columns of documents, and ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``.

    The column ``text`` is left as it was.
    """
    docs = small_batches(docs.drop(*NEW_COLUMNS))
    chunks = staged(docs.mapInArrow(_pack, "chunk long, size long, payload binary"), "chunks")
    total = chunks.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("n")
    ).first()
    buckets = max(1, -(-total["size"] // BUCKET_BYTES))
    share = max(1, total["n"] // SAMPLE_CHUNKS)
    sampled = chunks.filter(F.pmod(F.xxhash64("chunk"), F.lit(share)) == 0)
    counted = sampled.mapInArrow(_heads(SAMPLE_HEADS), "head binary, n long")
    counted = counted.groupBy("head").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n").isNull()).alias("sampled")
    )
    seen = max(1, sampled.count())
    size = F.col("n") * F.lit(_SUFFIX.itemsize * total["n"] / seen)
    fills = F.coalesce(size > BUCKET_BYTES, F.lit(False))
    found = counted.select("head", "sampled", F.when(fills, size).alias("size"))
    found = found.filter("sampled > 0 or size is not null").collect()
    heads = np.sort(
        np.array([x["head"] for x in found for _ in range(x["sampled"])], f"S{GRAM}")
    )
    splitters = np.unique(heads[np.arange(1, buckets) * len(heads) // buckets]) if len(heads) else heads
    hot = np.array([x["head"] for x in found if x["size"]], f"S{GRAM}")
    wide = (_REACH + 1) * _WINDOW.itemsize / _SUFFIX.itemsize
    parts = 1 + int(sum(x["size"] or 0 for x in found) * wide / BUCKET_BYTES)
    repeated = (
        chunks.mapInArrow(_offer(buckets), "bucket long, chunk long, once binary, often binary")
        .groupBy("bucket")
        .applyInArrow(_repeated, "chunk long, bucket long, values binary")
    )
    by_chunk = chunks.groupBy("chunk")
    cuts = (
        by_chunk.cogroup(repeated.groupBy("chunk"))
        .applyInArrow(
            _send(splitters, buckets, hot, parts), "bucket long, chunk long, size long, suffixes binary"
        )
        .groupBy("bucket")
        .applyInArrow(_judged(len(splitters) + 1), "chunk long, cuts binary")
    )
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return by_chunk.cogroup(cuts.groupBy("chunk")).applyInArrow(
        _apply(docs.columns), f"{shape}, kept binary, n_bytes long, n_removed long, n_spans long"
    )

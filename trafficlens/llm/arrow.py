"""Small helpers around Arrow batches inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# Bytes of a batch that goes to a Python worker, however long its texts are.
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the batches of its session by ``BATCH_BYTES``.

    The bound by rows alone would let a batch grow with the length of texts.  It
    stays set in the session.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each row starts and ends; null is empty."""
    filled = column.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    ends = np.frombuffer(filled.buffers()[1], np.int64)
    ends = ends[filled.offset : filled.offset + len(filled) + 1]
    held = filled.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data, ends


def word_blocks(text: bytes, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of a text between ASCII white space, in blocks of bounded length.

    A text longer than ``size`` is cut at the next white space, so that a very
    long document is never held as one list of words.
    """
    start = 0
    while len(text) - start > size:
        space = _SPACE.search(text, start + size)
        if space is None:
            break
        yield text[start : space.start()].split()
        start = space.start()
    yield text[start:].split()

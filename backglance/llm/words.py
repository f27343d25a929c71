"""Words of many texts as arrays, for operators that work on Arrow batches.

A word is a longest run of UTF-8 bytes other than space and 0x09 to 0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

_BYTE = np.arange(256)
IS_SPACE = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
ASCII_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)

# Bytes of text that are worked on at a time: bounds the arrays of a task, drops nothing.
SLICE_BYTES = 4 << 20


@dataclass
class Words:
    """``codes[i]`` is the place of word i in ``vocabulary``; document d has the words from ``first[d]`` to ``first[d + 1]``."""

    codes: np.ndarray
    vocabulary: pa.Array
    first: np.ndarray
    starts: np.ndarray  # byte where each word starts, in ``data``
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray  # byte where each document starts

    @property
    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


# Rows to an Arrow batch: texts are long, so few of them make a slice.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python in batches of about a slice.

    A setting of the session, because results are lazy: it has to hold when they run.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each starts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    if pa.types.is_null(texts.type):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator:
    """Parts of a batch or table with at most ``limit`` bytes of text each, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, end - start)
        start = end
    # A worker lives on after its task: what Arrow no longer uses goes back to the system.
    pa.default_memory_pool().release_unused()


def words_of(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = ASCII_LOWER[data]
    inside = ~IS_SPACE[data]
    begins, closes = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[:-1][np.diff(offsets) > 0]
        begins[edges] |= inside[edges]
        lasts = offsets[1:][np.diff(offsets) > 0] - 1
        closes[lasts] |= inside[lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    flat = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = flat.dictionary_encode()
    return Words(
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, np.searchsorted(starts, offsets), starts, ends, data, offsets
    )

"""Vectorised helpers on UTF-8 buffers, used inside Arrow batches.

A chunk is a run of whole texts laid end to end in one byte buffer; ``offsets[i]`` and
``offsets[i + 1]`` bound text ``i``. Chunks hold about ``CHUNK_BYTES`` (one longer text
is a chunk of its own), which bounds the memory of every helper here.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 18  # some 60 MB of arrays in the largest step

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the first text, bytes, offsets) of consecutive chunks; nulls are empty texts. Nothing is copied."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    _, raw_offsets, raw = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(raw_offsets, dtype=width)[column.offset : column.offset + n + 1].astype(np.int64)
    if column.null_count and (np.diff(offsets) * column.is_null().to_numpy(zero_copy_only=False)).any():  # bytes behind a null
        yield from text_chunks(column.fill_null(""))
        return
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def release() -> None:
    """Gives memory that is free back to the system; a worker that waits for its next task should not hold what the last one needed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries keep their own counsel
        ctypes.CDLL(None).malloc_trim(0)


def some_rows(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for steps that make Python objects of them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


def by_bytes(batches: Iterator[pa.RecordBatch], column: int = 0, limit: int = CHUNK_BYTES, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text in a column; a longer text comes alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = min(max(int(np.searchsorted(ends, done + limit, side="right")), first + 1), first + rows)
            yield batch.slice(first, last - first)
            first = last
    release()


def text_mark(text: Column | str) -> Column:
    """128 bits that tell texts apart; null is like empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _MULTIPLIER, dtype=np.uint64))), dtype=np.uint64)
        _inverses = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _INVERSE, dtype=np.uint64))), dtype=np.uint64)
    return _powers, _inverses


class SpanHashes:
    """64-bit hashes of any spans of a sequence, from one prefix sum.

    The sequence is bytes, or 64-bit values such as word hashes; equal spans have equal
    hashes wherever they stand."""

    def __init__(self, values: np.ndarray) -> None:
        values = _BYTE_VALUES[values] if values.dtype == np.uint8 else values | np.uint64(1)
        powers, self._back = _tables(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers[: len(values)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._back[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))

    def of_length(self, length: int) -> np.ndarray:
        """Of every span of this length, by start."""
        count = max(0, len(self._sums) - length)
        raw = (self._sums[length : length + count] - self._sums[:count]) * self._back[:count]
        return mix(raw + np.uint64(length * 0xD1B54A32D192ED03 % 2**64))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes, and the index of the first word of
    each text (one more entry at the end). Words never cross texts."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Word bytes, for texts in UTF-8 (bytes from 0x80 on belong to letters and other signs).
NOT_BLANK = ~byte_class((0x09, 0x0D), (0x20, 0x20))
LETTERS_DIGITS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in two passes over blocks."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])

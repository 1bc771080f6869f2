"""Whole texts of Arrow batches as flat byte arrays, their words and 64-bit hashes, without per-row loops.

A task holds one slice of a batch at a time: about ``SLICE_BYTES`` of text, or one text where that is longer.
Memory is some 50 bytes per byte of the slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

#: Space and the control characters 9-13 separate words.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Letters and digits of ASCII and every byte of a longer character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, cut where their texts add up to ``most`` bytes."""
    n = batch.num_rows
    if not n:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and the offsets of the rows (one more than rows); NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if column.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of ``inside`` bytes; runs do not cross rows."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    rows = offsets[1:-1]
    rows = rows[(rows > 0) & (rows < n)]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[rows] = inside[rows]
    last[:-1] &= ~inside[1:]
    last[rows - 1] = inside[rows - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; one to one."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes (``data`` already folded)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    at = np.zeros(len(data), np.int64)
    at[start] = start
    at = np.arange(len(data)) - np.maximum.accumulate(at)
    value = (data.astype(np.uint64) + np.uint64(1)) * inside
    value *= powers(int((end - start).max()) + 1)[np.minimum(at, int((end - start).max()))]
    return mix(np.add.reduceat(value, start))


def concat_rows(pieces: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(pieces) if pieces else np.zeros(0, dtype)


def binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()

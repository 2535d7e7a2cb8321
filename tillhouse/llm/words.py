"""Words, windows and hashes of Arrow text columns, computed on whole buffers instead of word by word.

A word is a run of characters outside `[\\x20\\x09-\\x0D]`. Hashes have 64 bits; they find candidates and count, and
whatever has to be exact is compared afterwards or hashed with SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text makes a chunk of its own.
CHUNK_BYTES = 500_000
_BASE = 0x9E3779B97F4A7C15 | 5
_POWERS: dict[int, np.ndarray] = {}


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base][:n]


class SpanHashes:
    """Hashes of any span [start, end) of a sequence, from one prefix sum."""

    def __init__(self, values: np.ndarray):
        self.prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(values)), out=self.prefix[1:])
        self.shift = powers(pow(_BASE, -1, 1 << 64), len(values) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.shift[start])


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most `limit` bytes of text, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more at the end). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(offsets) else np.zeros(0, np.uint8)
    return data, (offsets - offsets[0]) if len(offsets) else np.zeros(1, np.int64)


class Words:
    """The words of a column of texts: byte spans in `data`, and for each text the range `of[i]:of[i + 1]` of its words."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = raw(column)
        n = len(self.data)
        solid = ~space_table()[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(n + 1, bool)
        before[1:] = solid
        after = np.zeros(n + 1, bool)
        after[:n] = solid
        self.start = np.flatnonzero(solid & (~before[:n] | edge[:n]))
        self.end = np.flatnonzero(solid & (~after[1:] | edge[1:])) + 1
        self.of = np.searchsorted(self.start, self.offsets)

    def hashes(self) -> np.ndarray:
        return SpanHashes(self.data)(self.start, self.end) if len(self.start) else np.zeros(0, np.uint64)


def windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """The hash of each run of `width` values; run i begins at value i."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, c in enumerate(constants(width, seed)):
        total += hashes[i : i + n] * c
    return mix(total)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def array_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()

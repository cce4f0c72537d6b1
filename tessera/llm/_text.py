"""Vectorised byte-level text primitives for Arrow batches of whole documents.

A batch's texts lie behind each other in one byte buffer with offsets. Substring hashes come
from prefix sums of byte * P**position modulo 2**64, so any substring costs O(1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = 0x5851F42D4C957F2D
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: ASCII white space: space and 09-0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power_table(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        got = np.full(size, base, U64)
        got[0] = 1
        got = np.cumprod(got, dtype=U64)
        _powers[base] = got
    return got[:n]


class Hasher:
    """Hashes of any substring of one buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, U64)
        terms = self.sums[1:]  # in place: a batch's arrays are eight times its bytes
        terms[:] = data
        terms += U64(1)
        terms *= _power_table(_P, n)
        np.cumsum(terms, out=terms)
        self.inverse = _power_table(_P_INVERSE, n + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(value + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))

    def every(self, width: int) -> np.ndarray:
        """Of all substrings of one width, by start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, U64)
        value = self.sums[width:] - self.sums[:n]
        value *= self.inverse[:n]
        return mix(value)


def body_of(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n + 1 offsets into them, without copying where Arrow allows."""
    column = batch.column(batch.schema.get_field_index(name))
    if column.type != pa.large_binary():
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], name: str, limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows with about `limit` bytes of text (a longer text is a run of its
    own). All arrays of a run are multiples of it, so the limit bounds a worker's memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = body_of(batch, name)
        row = 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            stop = min(max(stop, row + 1), batch.num_rows)
            yield batch.slice(row, stop - row), data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
            row = stop
    _powers.clear()
    pa.default_memory_pool().release_unused()  # an idle worker keeps nothing


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of bytes outside `gap`; none crosses a row."""
    inside = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run behind the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return shift + np.arange(total)

"""Vectorised text kernels over Arrow string columns.

All functions work on the raw UTF-8 buffer of a whole block of documents, so
their cost is a few numpy passes over the bytes and never a Python call a word.
A word is a maximal run of bytes other than space and the controls 0x09-0x0D;
those separators are ASCII, so splitting bytes equals splitting code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
MASK64 = (1 << 64) - 1

#: Text bytes that a kernel handles at once; a longer document is a block alone.
BLOCK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit over all 64."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def combine(x: np.ndarray, y: np.ndarray, seed: int = 1) -> np.ndarray:
    """Hash of the ordered pair (x, y)."""
    a, b = (U64((0x9E3779B97F4A7C15 * (2 * seed + k)) & MASK64 | 1) for k in (1, 2))
    return mix(x * a + (y ^ (y >> U64(29))) * b + U64(seed))


SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True

_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        have = np.full(size, base & MASK64, U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[base] = have
    return have[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(buffer: np.ndarray, offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents (first, end, bytes, offsets) of about limit bytes."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, buffer[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


@dataclass
class Words:
    """Words of a block: byte ranges [start, end), and first[d] .. first[d + 1] are those of document d."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(buffer: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(buffer)
    inside = ~SEPARATOR[buffer]
    edge = np.zeros(n + 1, bool)  # a document begins here
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    if n:
        end[:-1] &= ~inside[1:] | edge[1:n]
    s = np.flatnonzero(start)
    return Words(s, np.flatnonzero(end) + 1, np.searchsorted(s, offsets))


def range_hash(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from prefix sums over the buffer.

    Ranges are ascending and don't overlap. A long buffer is taken in slices, so
    memory follows the slice and not the longest document.
    """
    out, at = np.empty(len(start), U64), 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + 2 * BLOCK_BYTES, "right")))
        lo, hi = int(start[at]), int(end[stop - 1])
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE[buffer[lo:hi]] * _powers(_BASE, hi - lo), out=total[1:])
        s, e = start[at:stop] - lo, end[at:stop] - lo
        out[at:stop] = mix((total[e] - total[s]) * _powers(pow(_BASE, -1, 1 << 64), hi - lo + 1)[s] + (e - s).astype(U64) * U64(0xA0761D6478BD642F))
        at = stop
    return out


def widen(h: np.ndarray, length: int, to: int, seed: int = 1) -> np.ndarray:
    """Hashes of windows of `to` items from those of `length` items, length < to <= 2 * length.

    Two overlapping windows cover the longer one, so the pair identifies it.
    """
    step = to - length
    return combine(h[: max(0, len(h) - step)], h[step:], seed * 64 + to % 61) if len(h) > step else h[:0]


def window_ladder(size: int) -> list[int]:
    """1, 2, 4 ... size: the lengths by which doubling reaches size."""
    out = [size]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def window_hash(h: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hashes of all runs of `size` consecutive items; entry i begins at item i."""
    steps = window_ladder(size)
    for a, b in zip(steps, steps[1:], strict=False):
        h = widen(h, a, b, seed)
    return h


def window_valid(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the n windows of `size` words lie inside one document."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])
    return (left >= size)[:n]


def pack(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of each value, little-endian."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    got = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(got), 8), np.uint8)
    out[:, :width] = got
    return out.view("<u8").reshape(-1).astype(U64, copy=False)


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted set."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values

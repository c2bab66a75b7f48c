"""Vectorised byte work inside tasks: words and rolling hashes of whole
Arrow text columns, without a Python loop over characters or words."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = 0x9E3779B97F4A7C15                  # odd: it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
SLICE = 1 << 20                          # bytes handled at a time: the arrays of a slice fit the caches


@functools.cache
def symbols() -> np.ndarray:
    """A fixed odd 64-bit number for each byte value."""
    return np.random.default_rng(20_231).integers(0, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``P**i`` and ``P**-i`` modulo 2**64 for i < n (kept between calls)."""
    if not _POWERS or len(_POWERS[0]) < n:
        m = max(n, SLICE + 1024)
        one = np.ones(1, U64)
        _POWERS[:] = [np.cumprod(np.concatenate([one, np.full(m - 1, p, U64)])) for p in (_P, _P_INV)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over the word (a bijection)."""
    h = h ^ (h >> U64(29))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(32)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(30)
    return h


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(buffers[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[off[0]:off[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def slices(data: np.ndarray, off: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``most`` bytes (a longer row stands alone):
    first row, end row, bytes, offsets."""
    row, n = 0, len(off) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + most, "right")) - 1)
        yield row, end, data[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def word_bytes(pattern: str) -> np.ndarray:
    """Which byte values belong to words: ``"text"`` for ``[^\\x20\\x09-\\x0D]``,
    ``"term"`` for ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing."""
    inside = np.ones(256, bool)
    if pattern == "text":
        inside[[0x20, *range(0x09, 0x0E)]] = False
    else:
        inside[:0x80] = False
        for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
            inside[low:high + 1] = True
    return inside


@functools.cache
def lowered() -> np.ndarray:
    """Byte values with A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 32
    return t


def word_spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and words before each row's start; words
    never cross rows."""
    return run_spans(inside[data], off)


def run_spans(w: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of true bytes, and runs before each row's start."""
    n = len(w)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    before = np.zeros(n, bool)
    before[1:] = w[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = w[1:]
    last = off[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` hashes any span."""
    t = symbols()[lowered()] if lower else symbols()
    out = np.empty(len(data) + 1, U64)
    out[0] = 0
    np.cumsum(t[data] * powers(len(data) + 1)[0][:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes have equal hashes."""
    back = powers(len(prefix))[1]
    h = (prefix[ends] - prefix[starts]) * back[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and words before each row's start."""
    hashes, edges = [np.zeros(0, U64)], [np.zeros(1, np.int64)]
    for _, _, part, at in slices(data, off):
        starts, ends, counts = word_spans(part, at, inside)
        hashes.append(span_hash(prefix_hash(part, lower), starts, ends))
        edges.append(edges[-1][-1] + counts[1:])
    return np.concatenate(hashes), np.concatenate(edges)

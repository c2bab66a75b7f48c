"""Compact payloads of integer arrays, and lookups of known keys, for
operators that exchange whole arrays instead of a row per element."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .bytesops import U64


def pack(values: np.ndarray) -> bytes:
    """Bytes of an array, the bytes of equal weight side by side (they repeat
    in small or sorted numbers), compressed."""
    raw = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), raw.itemsize).T) if len(raw) else np.zeros(0, np.uint8)
    return raw.dtype.str.encode() + b";" + len(raw).to_bytes(8, "little") + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(raw) else b"")


def unpack(payload: bytes) -> np.ndarray:
    at = payload.index(b";")
    kind, n = np.dtype(payload[:at].decode()), int.from_bytes(payload[at + 1:at + 9], "little")
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(payload[at + 9:], n * kind.itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Rising unsigned 64-bit keys, as their differences."""
    return pack(np.diff(keys, prepend=U64(0))) if len(keys) else pack(keys)


def unpack_sorted(payload: bytes) -> np.ndarray:
    return np.cumsum(unpack(payload), dtype=U64)


def pack_bytes(data: np.ndarray) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data.tobytes(), "zstd", asbytes=True)


def unpack_bytes(payload: bytes) -> np.ndarray:
    n = int.from_bytes(payload[:8], "little")
    return np.frombuffer(pa.decompress(payload[8:], n, "zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)


def count_keys(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often (or with what total weight) each occurs."""
    if weights is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    if not len(keys):
        return keys, weights
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(weights, at)


class Lookup:
    """Places of known keys in an array of distinct keys.  Tables of four
    times their keys' number, one under the other: a key that finds its slot
    taken goes to the next table."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables = keys, []
        rest, seed = np.arange(len(keys), dtype=np.int32), 0x9E3779B97F4A7C15
        while len(rest):
            bits = max(4, int(4 * len(rest)).bit_length())
            seed = (seed * 0xD1342543DE82EF95 + 0xF1357AEA2E62A9C5) % (1 << 64) | 1
            slot = (keys[rest] * U64(seed)) >> U64(64 - bits)
            table = np.full(1 << bits, 0, np.int32)
            table[slot] = rest
            self.tables.append((U64(seed), U64(64 - bits), table))
            rest = rest[table[slot] != rest]

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted key; all of them must be known."""
        out = np.zeros(len(wanted), np.int32)
        left = None
        for seed, shift, table in self.tables:
            ask = wanted if left is None else wanted[left]
            at = table[(ask * seed) >> shift]
            miss = np.flatnonzero(self.keys[at] != ask)
            if left is None:
                out, left = at, miss
            else:
                out[left] = at
                left = left[miss]
            if not len(left):
                break
        return out

"""Words, word hashes and shingles of many texts at once, as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Hashes have 64 bits:
a word's is a polynomial over random byte values, taken from running sums of the whole buffer;
a shingle's folds the hashes of its words in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE = 5
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public domain): every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=U) + U(salt)) * U(0x9E3779B97F4A7C15))


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE = seeds(256, 7)
BASE = 0xD6E8FEB86659FD93
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, base, U)
            p[0] = 1
            made.append(np.cumprod(p, dtype=U))
        _powers[:] = made
    return _powers[0], _powers[1]


@dataclass
class Words:
    start: np.ndarray  # byte offsets in the buffer
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text, index of its first word; one longer than the number of texts
    buffer: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary or string column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def split(column: pa.Array, lower: bool = True) -> Words:
    raw, offsets = buffers(column)
    raw = LOWER[raw] if lower else raw
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(BYTE[raw] * up[:n], out=total[1:])
    # the length keeps words apart that differ by bytes whose value is 0
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * U(0x9E3779B97F4A7C15))
    return Words(start, end, hashes, np.searchsorted(start, offsets), raw)


def fold(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    out = np.full(len(at), n, U)
    for k in range(n):
        out = (out ^ hashes[at + k]) * U(0xFF51AFD7ED558CCD)
        out ^= out >> U(32)
    return mix(out)


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in order of the text, and of each text the first one's index (one longer)."""
    first, count = words.first[:-1], np.diff(words.first)
    per = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(per)])
    out = np.zeros(begin[-1], U)
    whole = np.repeat(count >= n, per)
    at = np.repeat(first - begin[:-1], per) + np.arange(begin[-1])
    out[whole] = fold(words.hash, at[whole], n)
    for k in range(1, n):
        few = np.flatnonzero(count == k)
        out[begin[few]] = fold(words.hash, first[few], k)
    return out, begin


def sets(column: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; none for a text without words."""
    found, begin = shingles(split(column), n)
    return [np.unique(found[begin[i] : begin[i + 1]]) for i in range(len(begin) - 1)]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array for each row."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))

"""Vectorised words, word hashes and word n-grams of Arrow text columns.

All work is on the UTF-8 bytes, in chunks of a few megabytes, so a batch of
long texts needs little memory. A class of bytes says what belongs to a word;
every byte of a non-ASCII character is at least 0x80, so byte classes express
the character classes used here exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1


def byte_class(member) -> np.ndarray:
    return np.array([bool(member(b)) for b in range(256)])


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z became a-z: digits, a-z and everything outside ASCII.
WORD_BYTES = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: ``[^\x20\x09-\x0D]``
VISIBLE_BYTES = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the odd base and of its inverse modulo 2**64, grown when a longer chunk needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + (1 << 17))
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, base & _MASK, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Words:
    """The words of some rows: byte ranges in ``data``, and ``first[i]:first[i+1]`` as the words of row i."""

    rows: slice
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        up, down = _POWERS.upto(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start])

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets; a null row is an empty one."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32, count=len(column) + 1 + column.offset)[column.offset:].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def scan(column: pa.Array | pa.ChunkedArray, members: np.ndarray = WORD_BYTES, lower: bool = True, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """Words of all rows, a chunk of rows at a time. Longer rows than a chunk come alone and whole."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    data, offsets = _buffers(column)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1
        stop = min(max(stop, at + 1), len(column))
        piece = data[offsets[at]:offsets[stop]]
        piece = LOWER[piece] if lower else piece
        yield _words(slice(at, stop), piece, offsets[at:stop + 1] - offsets[at], members)
        at = stop


def _words(rows: slice, data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> Words:
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = members[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True                       # a word never goes on in the next row
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return Words(rows, data, starts, ends, np.searchsorted(starts, offsets))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words, rows not told apart."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * _STEP + hashes[j:j + n]
    return mix(total)


def row_grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and row numbers of the k-grams within rows; a row of 1 to k-1 words gives one gram of all its words."""
    lengths = np.diff(first)
    row = np.repeat(np.arange(len(lengths)), lengths)
    left = first[1:][row] - np.arange(len(hashes))         # words from here to the row's end
    inside = left[:max(len(hashes) - k + 1, 0)] >= k
    found, rows = grams(hashes, k)[inside], row[:len(inside)][inside]
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    if len(short):
        whole = np.empty(len(short), dtype=np.uint64)
        for i, r in enumerate(short):
            whole[i] = grams(hashes[first[r]:first[r + 1]], int(lengths[r]))[0]
        found, rows = np.concatenate([found, whole]), np.concatenate([rows, short])
    return found, rows

"""Whole texts as NumPy arrays inside a task: bytes, words, shingles and their hashes.

A word is a maximal run of bytes other than space and U+0009 to U+000D. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 19

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, U64)
            p[0] = 1
            both.append(np.cumprod(p))
        if n > 4 * SLICE_BYTES:  # one very long text: not kept
            return both[0], both[1]
        _powers[:] = both
    return _powers[0], _powers[1]


@dataclass
class Texts:
    """Texts laid end to end: ``data[offs[i]:offs[i + 1]]`` is text i."""

    data: np.ndarray
    offs: np.ndarray

    def __len__(self) -> int:
        return len(self.offs) - 1


def texts_of(column: pa.Array) -> Texts:
    """The UTF-8 bytes of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(whole[offs[0] : offs[-1]], offs - offs[0])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Batches cut so that their texts hold about ``limit`` bytes; a longer text is one slice."""
    for batch in batches:
        offs = texts_of(batch.column(column)).offs
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            part = batch.slice(at, to - at)
            yield part, texts_of(part.column(column))
            at = to


@dataclass
class Words:
    """Words of texts: byte ranges, hashes, and ``offs`` as for texts but counting words."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offs: np.ndarray

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.offs))


def bounds_of_words(
    texts: Texts, data: np.ndarray | None = None, separators: np.ndarray = SEPARATORS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes, and the number of words before each text."""
    data = texts.data if data is None else data
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(texts) + 1, np.int64)
    word = ~separators[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = texts.offs[:-1][texts.offs[:-1] < n]
    first[inner] = word[inner]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = texts.offs[1:][texts.offs[1:] > 0] - 1
    last[inner] = word[inner]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, texts.offs)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, by differences of one running polynomial sum."""
    p, q = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * p[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * q[starts]
    return mix(h ^ ((ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)))


def words_of(texts: Texts, lower: bool = False, separators: np.ndarray = SEPARATORS) -> Words:
    """All words; ``lower`` folds A to Z only."""
    data = LOWER[texts.data] if lower else texts.data
    starts, ends, offs = bounds_of_words(texts, data, separators)
    return Words(starts, ends, range_hashes(data, starts, ends), offs)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k items from each position on; as many as there are such positions."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= U64(0x9FB21C651E98DF25)
        out += hashes[j : j + n]
    return mix(out)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def binary_column(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary Arrow column of byte ranges of ``data``."""
    offs = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(data[ranges(starts, lengths)]))])

"""Suffix-array dedup: bytes of strings that also start in a document of smaller id.

The suffix array of a group of segments is built in two stages. Suffixes smaller than their
successor are sorted directly. The rest are induced: going through the first-byte buckets in
ascending order, the predecessor of each suffix, if it is larger than that suffix, is appended to
its own bucket. Adjacent common prefixes of the array then give the groups of equal windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from polyspark.llm.text import texts_of
from polyspark.llm.windows import BYTES, merged, verdicts, with_spans

DEPTH = 50  # suffixes are ordered by so many bytes, the length that must repeat


def _words_at(padded: np.ndarray, at: np.ndarray, skip: int) -> np.ndarray:
    """The 8 bytes that stand ``skip`` after each position, so that numbers order as bytes do."""
    view = np.ndarray(len(padded) - 7, ">u8", padded, 0, (1,))
    return view[at + skip].astype(np.uint64)


def smaller_suffixes(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; a run of one byte goes with what follows it."""
    n = len(data)
    up = np.zeros(n, bool)
    if n > 1:
        differ = np.flatnonzero(data[1:] != data[:-1])
        rise = data[differ] < data[differ + 1]
        up[: differ[-1] + 1 if len(differ) else 0] = np.repeat(rise, np.diff(np.concatenate([[-1], differ])))
    return up


def direct_sort(padded: np.ndarray, at: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions in order of the ``depth`` bytes that start there: by 8 bytes, then ties by 5 more at a time."""
    if len(at) < 2:
        return at
    key = _words_at(padded, at, 0)
    order = np.argsort(key)
    at, key = at[order], key[order]
    tied = np.concatenate([[False], key[1:] == key[:-1]])
    done = 8
    while done < depth:
        open_ = tied.copy()
        open_[:-1] |= tied[1:]
        rows = np.flatnonzero(open_)
        if not len(rows):
            break
        take = min(5, depth - done)
        key = _words_at(padded, at[rows], done) >> np.uint64(64 - 8 * take)
        group = np.cumsum(~tied[rows]).astype(np.uint64)
        if group[-1] < 1 << 24:
            key |= group << np.uint64(40)
            order = np.argsort(key)
        else:  # more ties than fit beside the bytes
            order = np.lexsort((key, group))
        at[rows], key, group = at[rows][order], key[order], group[order]
        tied = np.zeros(len(at), bool)
        tied[rows[1:]] = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        done += take
    return at


def inducing(small: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted suffixes and those they are induced from: after a larger one its successor, up to a smaller one."""
    at = np.arange(len(small))
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(small, at, -1))[:-1]])  # smaller suffix before each
    total = np.concatenate([[0], np.cumsum(wanted)])
    return total[at + 1] > total[last + 1]


def suffix_array(data: np.ndarray, depth: int = DEPTH, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of ``data`` in order of at least their first ``depth`` bytes, by two-stage sorting.

    All of them, or those that ``wanted`` marks and the few others that these are induced from.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(depth + 16, np.uint8)])
    small = smaller_suffixes(data)
    needed = np.ones(n, bool) if wanted is None else inducing(small, wanted)
    large = needed & ~small
    direct = direct_sort(padded, np.flatnonzero(needed & small), depth)
    cuts = np.searchsorted(data[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    if large[n - 1]:
        pending[data[n - 1]].append(np.array([n - 1]))  # larger than the empty suffix after it
    out = []
    for c in range(256):
        larger = pending[c]
        wave = np.concatenate(larger) if larger else np.zeros(0, np.int64)
        parts = [wave]
        while len(wave):  # runs of byte c: each wave stands one byte before the last
            before = wave[wave > 0] - 1
            wave = before[(data[before] == c) & large[before]]
            parts.append(wave)
        bucket = np.concatenate([*parts, direct[cuts[c] : cuts[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = data[before]
        rest = (first > c) & large[before]
        before, first = before[rest], first[rest]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        for b, e in zip(*_runs(first), strict=True):
            pending[first[b]].append(before[b:e])
        pending[c] = []
    return np.concatenate(out)


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    cuts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, np.int64)
    return cuts[:-1].tolist(), cuts[1:].tolist()


def agree(padded: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Whether the common prefix of the suffixes a and b has at least ``depth`` bytes."""
    rows = np.arange(len(a))
    for k in range(-(-depth // 8)):
        x, y = _words_at(padded, a[rows], 8 * k), _words_at(padded, b[rows], 8 * k)
        spare = 8 * (k + 1) - depth
        if spare > 0:
            x, y = x >> np.uint64(8 * spare), y >> np.uint64(8 * spare)
        rows = rows[x == y]
    out = np.zeros(len(a), bool)
    out[rows] = True
    return out


def find(bodies: pa.Array, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """First places of all windows of the segments, from one suffix array over them."""
    texts = texts_of(bodies)
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.offs))
    whole = np.arange(len(texts.data)) + DEPTH <= texts.offs[1:][owner]  # a window starts here and ends in its segment
    array = suffix_array(texts.data, wanted=whole)
    array = array[whole[array]]
    padded = np.concatenate([texts.data, np.zeros(DEPTH + 16, np.uint8)])
    joined = np.concatenate([[False], agree(padded, array[:-1], array[1:])])
    group = np.empty(len(texts.data), np.int64)
    group[array] = np.cumsum(~joined)
    at = np.flatnonzero(whole)
    seg = owner[at]
    return verdicts(seg, at - texts.offs[seg], group[at], doc, start, by_start=False)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """Every document with its repeated byte spans: doc_id, text, spans (array of from, to; null if none; may overlap).

    Reads doc_id and text. A span covers strings of 50 bytes that also start in a document of
    smaller doc_id. A null text is empty; a null doc_id is larger than any other; rows of one
    doc_id, repeated or with other texts, do not count as smaller than each other. Empty in, empty out.
    """
    return with_spans(docs, BYTES, find, by_start=False)


def removed_bytes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            rows = []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text = texts.data[texts.offs[i] : texts.offs[i + 1]].tobytes()
                cuts = merged(spans) if spans else []
                kept = b"".join(text[a:b] for a, b in zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(text)], strict=True)) if cuts else text
                rows.append((len(text), len(text) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return repeated_bytes(docs).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )

"""Bringing equal fixed-width windows of all documents together, for exact repeat removal.

A window is ``width`` consecutive bytes or words. Its route is the least hash of the
``gram``-unit strings in it, so equal windows have equal routes wherever they stand. A segment is
a run of consecutive windows with one route (cut after ``LONGEST`` windows).

1. The strings that lie around the routes of segments (``_sides``) are counted, packed per task and
   bucket; a segment whose strings are all met once in the corpus cannot hold a repeat. What is left sets bits of a filter of fixed size (``FILTER_BITS``). It only ever lets
   too much through, so its filling up costs shuffle, never a result.
2. Segments with repeated strings are folded by content to their first place and number, before the
   shuffle, and grouped by route. A ``find`` function (suffix array or suffix automaton) gives,
   for every window of a segment, the first place of an equal window.
3. These verdicts are joined back to the places of the segments and become spans of documents.

No step gathers the places of one window: a passage in a third of all documents is one row per
task before the shuffle, and the join that hands verdicts back can be split by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyspark.llm.common import by_group, shuffle_partitions, tidy
from polyspark.llm.text import U64, Texts, binary_column, bounds_of_words, grams, mix, ranges, range_hashes, slices
from polyspark.session import saved

FILTER_BITS = 1 << 27
LONGEST = 64
LAST_ID = (1 << 63) - 1
BATCH_BYTES = 1 << 20
VERDICTS = "route long, seg long, from int, to int, first_doc long, base int"


@dataclass(frozen=True)
class Kind:
    """Windows of ``width`` units, routed by strings of ``gram`` units; units are words or bytes."""

    width: int
    gram: int
    words: bool
    group_bytes: int  # of segments searched at once
    fold_bytes: int  # of a task's text whose segments are folded at once


BYTES = Kind(50, 12, words=False, group_bytes=3 << 20, fold_bytes=16 << 20)
WORDS = Kind(20, 6, words=True, group_bytes=3 << 19, fold_bytes=8 << 20)


@dataclass
class Runs:
    """Segments: document, first unit, number of windows, route; and the least hash of all windows of the texts."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    route: np.ndarray
    least: np.ndarray


def _byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes (8 or more) from each position on, taken 8 at a time."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    data = np.ascontiguousarray(data)
    out = np.zeros(n, U64)
    for skip in (*range(0, k - 8, 8), k - 8):
        out = mix(np.ndarray(n, "<u8", data, skip, (1,)) + out * U64(0x9FB21C651E98DF25) + U64(1))
    return out


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs_of(kind: Kind, hashes: np.ndarray, offs: np.ndarray) -> Runs:
    """Segments of texts whose units have these gram hashes; ``offs`` counts units before each text."""
    n = int(offs[-1]) - kind.width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, np.zeros(0, U64), np.zeros(0, U64))
    least = _sliding_min(hashes, kind.width - kind.gram + 1)
    lengths = np.diff(offs)
    starts = np.repeat(False, n + 1)
    valid = np.zeros(n + 1, np.int8)  # +1 where a text's windows begin, -1 after their end
    whole = np.flatnonzero(lengths >= kind.width)
    valid[offs[:-1][whole]] = 1
    ends = offs[:-1][whole] + lengths[whole] - kind.width + 1
    close = np.zeros(n + 1, np.int8)
    close[ends] = 1
    starts[offs[:-1][whole]] = True
    inside = np.cumsum(valid - close, dtype=np.int8)[:n].astype(bool)
    new = starts[:n]
    new[1:] |= least[1:] != least[:-1]
    new &= inside
    begin = np.flatnonzero(new)
    stops = np.flatnonzero(new | (close[:n] > 0))
    after = np.searchsorted(stops, begin, "right")
    count = np.where(after < len(stops), stops[np.minimum(after, len(stops) - 1)], n) - begin
    pieces = -(-count // LONGEST)
    nth = ranges(np.zeros(len(begin), np.int64), pieces)
    start = np.repeat(begin, pieces) + nth * LONGEST
    count = np.minimum(np.repeat(count, pieces) - nth * LONGEST, LONGEST)
    return Runs(np.searchsorted(offs, start, "right") - 1, start, count, least[start], least)


def _sides(kind: Kind, hashes: np.ndarray, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """The longer strings around each place of a segment's route string: number of the segment, hash.

    A window holds ``width - gram`` units beside its route string, so half of them stand before or
    after it. Equal windows therefore share the string with that many units before it, or the one
    with that many after it, around their first route string. Strings that stick out of their
    segment lie in none of its windows.
    """
    if not len(runs.start):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    half = (kind.width - kind.gram) // 2
    span = kind.width - kind.gram + 1
    ends = runs.start + runs.count + span - 1  # of the strings that lie in a segment
    pad = np.full(span - 1, ~U64(0))
    most = ~_sliding_min(np.concatenate([pad, ~runs.least, pad]), span)
    at = np.flatnonzero(hashes == most)  # strings that are the least of some window
    first = np.searchsorted(ends, at, "right")
    times = np.searchsorted(runs.start, at, "right") - first
    at, seg = np.repeat(at, times), ranges(first, times)
    same = hashes[at] == runs.route[seg]
    at, seg = at[same], seg[same]
    before = np.flatnonzero(at - half >= runs.start[seg])
    after = np.flatnonzero(at + half < ends[seg])
    left, right = hashes[at[before]], hashes[at[after]] + U64(1)
    for step in (half // 2, half):
        left = mix(hashes[at[before] - step] + left * U64(0x9FB21C651E98DF25))
        right = mix(hashes[at[after] + step] + right * U64(0x9FB21C651E98DF25))
    return np.concatenate([seg[before], seg[after]]), np.concatenate([left, right])


def _units(kind: Kind, texts: Texts) -> tuple[np.ndarray, np.ndarray, Callable[[Runs], tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Gram hashes, unit offsets, and a function to the bytes of segments (words joined by one space)."""
    if not kind.words:
        cut = lambda runs: (texts.data, runs.start, runs.count + kind.width - 1)
        return _byte_grams(texts.data, kind.gram), texts.offs, cut
    starts, ends, offs = bounds_of_words(texts)

    def joined(runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = ends - starts + 1
        at = np.concatenate([[0], np.cumsum(sizes)])
        data = texts.data[np.minimum(ranges(starts, sizes), max(len(texts.data) - 1, 0))]
        data[at[1:] - 1] = 0x20
        last = runs.start + runs.count + kind.width - 1
        return data, at[runs.start], at[last] - at[runs.start] - 1

    return grams(range_hashes(texts.data, starts, ends), kind.gram), offs, joined


def _place(sides: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of a string's hash and the 32 bits that stand for it there."""
    return ((sides >> U64(32)) % U64(buckets)).astype(np.int64), (mix(sides) & U64(0xFFFFFFFF)).astype(np.uint32)


def repeated_sides(docs: DataFrame, kind: Kind) -> np.ndarray:
    """The filter: bit b * segment + (print mod segment) is set if bucket b met the print twice or more.

    The only thing that reaches the driver has ``FILTER_BITS`` bits, whatever the corpus holds.
    """
    buckets = max(64, 2 * shuffle_partitions(docs.sparkSession))
    segment = FILTER_BITS // buckets // 8 * 8

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            hashes, offs, _ = _units(kind, texts)
            _, sides = _sides(kind, hashes, runs_of(kind, hashes, offs))
            bucket, prints = _place(sides, buckets)
            if not len(bucket):
                continue
            both, times = np.unique((bucket.astype(U64) << U64(32)) | prints, return_counts=True)
            cuts = np.searchsorted(both >> U64(32), np.arange(buckets + 1))
            at = np.flatnonzero(np.diff(cuts))
            values = (both & U64(0xFFFFFFFF)).astype(np.uint32)
            values = [values[cuts[b] : cuts[b + 1]].tobytes() for b in at]
            many = [np.packbits(times[cuts[b] : cuts[b + 1]] > 1).tobytes() for b in at]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(values, pa.binary()), pa.array(many, pa.binary())], ["bucket", "prints", "many"])

    def repeats(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = table.column("bucket").to_numpy()
        prints, many = table.column("prints").to_pylist(), table.column("many").to_pylist()
        for b in np.unique(keys):
            rows = np.flatnonzero(keys == b)
            values = [np.frombuffer(prints[i], np.uint32) for i in rows]
            twice = [v[np.unpackbits(np.frombuffer(many[i], np.uint8), count=len(v)).astype(bool)] for i, v in zip(rows, values, strict=True)]
            values = np.sort(np.concatenate(values))
            hit = np.concatenate([values[1:][values[1:] == values[:-1]], *twice]) % np.uint32(segment)
            bits = np.zeros(segment, np.uint8)
            bits[hit] = 1
            yield pa.RecordBatch.from_arrays([pa.array([int(b)]), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bucket", "bits"])

    packed = docs.select("text").mapInArrow(count, "bucket long, prints binary, many binary")
    out = np.zeros((buckets, segment // 8), np.uint8)
    for row in by_group(packed, "bucket", repeats, "bucket long, bits binary").toLocalIterator():
        out[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return out


@dataclass
class Found:
    """Segments with repeated strings: rows (doc, t1, t2, start, route, name) and, for folding, where their bytes are."""

    doc: np.ndarray
    t1: np.ndarray
    t2: np.ndarray
    start: np.ndarray
    route: np.ndarray
    name: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    length: np.ndarray


def _scan(kind: Kind, bits: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[Found]:
    """The segments of each slice of rows (doc, t1, t2, text) that have repeated strings; starts are in units of their text."""
    buckets, segment = bits.shape[0], bits.shape[1] * 8
    for batch, texts in slices(batches):
        hashes, offs, cut = _units(kind, texts)
        runs = runs_of(kind, hashes, offs)
        seg, sides = _sides(kind, hashes, runs)
        bucket, prints = _place(sides, buckets)
        at = prints % np.uint32(segment)
        hit = np.unique(seg[((bits[bucket, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)])
        if len(hit):
            runs = Runs(runs.doc[hit], runs.start[hit], runs.count[hit], runs.route[hit], runs.least)
            data, begin, length = cut(runs)
            name = range_hashes(data, begin, begin + length)
            doc, t1, t2 = (batch.column(c).to_numpy()[runs.doc] for c in ("doc", "t1", "t2"))
            yield Found(doc, t1, t2, runs.start - offs[runs.doc], runs.route, name, data, begin, length)


def _fold(found: list[Found], by_start: bool) -> Iterator[pa.RecordBatch]:
    """One row per content: route, seg, body, first place, number of places; in batches of about ``BATCH_BYTES`` of bodies."""
    base = np.cumsum([0] + [len(f.data) for f in found])
    doc, start, route, name, length = (np.concatenate([getattr(f, c) for f in found]) for c in ("doc", "start", "route", "name", "length"))
    begin = np.concatenate([f.begin + b for f, b in zip(found, base, strict=False)])
    data = np.concatenate([f.data for f in found])
    found.clear()
    if not by_start:
        start = np.zeros_like(start)
    order = np.lexsort((start, doc, name, route))
    r, s = route[order], name[order]
    new = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] != s[:-1])]))
    times = np.diff(np.concatenate([new, [len(order)]])).astype(np.int32)
    first = order[new]
    block = np.cumsum(length[first]) // BATCH_BYTES
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])).tolist()
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        at = first[i:j]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(route[at].view(np.int64)),
                pa.array(name[at].view(np.int64)),
                binary_column(data, begin[at], length[at]),
                pa.array(doc[at]),
                pa.array(start[at].astype(np.int32)),
                pa.array(times[i:j]),
            ],
            ["route", "seg", "body", "doc", "start", "times"],
        )


def folded_segments(docs: DataFrame, kind: Kind, bits: np.ndarray, by_start: bool) -> DataFrame:
    """Segments with repeated strings, one row per content and about ``fold_bytes`` of a task's text: route, seg, body, doc, start, times.

    Folding before the shuffle turns a passage that many documents share into one row of each
    stretch of a task. The route and ``seg``, 128 bits in all, name the content.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Found] = []
        size = 0
        for found in _scan(kind, sent.value, batches):
            held.append(found)
            size += len(found.data)
            if size >= kind.fold_bytes:
                yield from _fold(held, by_start)
                size = 0
        if held:
            yield from _fold(held, by_start)

    return docs.mapInArrow(run, "route long, seg long, body binary, doc long, start int, times int")


def placed_segments(docs: DataFrame, kind: Kind, bits: np.ndarray) -> DataFrame:
    """All places of the segments with repeated strings: doc, t1, t2, start, route, seg."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in _scan(kind, sent.value, batches):
            columns = (f.doc, f.t1, f.t2, f.start.astype(np.int32), f.route.view(np.int64), f.name.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "t1", "t2", "start", "route", "seg"])

    return docs.mapInArrow(run, "doc long, t1 long, t2 long, start int, route long, seg long")


def verdicts(seg: np.ndarray, window: np.ndarray, group: np.ndarray, doc: np.ndarray, start: np.ndarray, by_start: bool) -> tuple[np.ndarray, ...]:
    """First places of windows, as runs of one verdict: segment, from, to, document, base.

    Window ``window`` of segment ``seg`` equals all windows of its ``group``; ``doc`` and ``start``
    are the first place of each segment. A run's windows o stand first at ``base + o`` of ``doc``.
    Rows must come in order of (seg, window).
    """
    d, p = doc[seg], (start[seg] + window if by_start else np.zeros(len(seg), np.int64))
    order = np.lexsort((p, d, group))
    g = group[order]
    new = np.concatenate([[True], g[1:] != g[:-1]])
    least = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    first_doc, base = np.empty_like(d), np.empty_like(d)
    first_doc[order], base[order] = d[least], p[least]
    if by_start:
        base -= window
    cut = np.ones(len(seg), bool)
    cut[1:] = (seg[1:] != seg[:-1]) | (first_doc[1:] != first_doc[:-1]) | (base[1:] != base[:-1]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(cut)
    stop = np.concatenate([at[1:], [len(seg)]])
    return seg[at], window[at], window[stop - 1] + 1, first_doc[at], base[at]


Find = Callable[[pa.Array, np.ndarray, np.ndarray], tuple[np.ndarray, ...]]


def _judge(table: pa.Table, find: Find, by_start: bool) -> Iterator[pa.RecordBatch]:
    """Verdicts on the segments of whole routes, for those some place of which loses something."""
    route, seg, doc, start, times = (table.column(c).to_numpy() for c in ("route", "seg", "doc", "start", "times"))
    order = np.lexsort((start, doc, seg, route))
    route, seg = route[order], seg[order]
    new = np.flatnonzero(np.concatenate([[True], (route[1:] != route[:-1]) | (seg[1:] != seg[:-1])]))
    times = np.add.reduceat(times[order], new, dtype=np.int64)
    first = order[new]
    doc, start = doc[first], start[first].astype(np.int64)
    which, froms, tos, docs, bases = find(table.column("body").combine_chunks().take(pa.array(first)), doc, start)
    moved = (docs != doc[which]) | ((bases != start[which]) if by_start else False)
    useful = (moved | (times[which] > 1)).nonzero()[0]
    row = new[which[useful]]
    values = (froms, tos, docs, bases)
    yield pa.RecordBatch.from_arrays(
        [pa.array(route[row]), pa.array(seg[row]), *(pa.array(v[useful].astype(t)) for v, t in zip(values, (np.int32, np.int32, np.int64, np.int32), strict=True))],
        ["route", "seg", "from", "to", "first_doc", "base"],
    )


def row_name() -> list[Column]:
    """(doc, t1, t2, text): the id in order (null last), 128 bits of the text to tell rows of one id apart, the text (null: empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    return [doc.alias("doc"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2"), text.alias("text")]


def repeated_spans(docs: DataFrame, kind: Kind, find: Find, by_start: bool) -> DataFrame:
    """Units covered by a window that also stands earlier: rows (doc, t1, t2, spans), spans an array of (from, to) in units.

    ``docs`` has the columns of ``row_name``; rows of one name share their spans. Earlier means in a document of smaller id, and with ``by_start`` also at
    a smaller start of the same document.
    """
    bits = repeated_sides(docs, kind)
    tidy(docs.sparkSession)
    folded = folded_segments(docs, kind, bits, by_start)
    judged = saved(by_group(folded, "route", lambda table: _judge(table, find, by_start), VERDICTS, group_bytes=kind.group_bytes))
    tidy(docs.sparkSession)
    told = placed_segments(docs, kind, bits).join(judged, ["route", "seg"])
    earlier: Column = F.col("first_doc") < F.col("doc")
    if by_start:
        earlier = earlier | ((F.col("first_doc") == F.col("doc")) & (F.col("base") < F.col("start")))
    a, b = F.col("start") + F.col("from"), F.col("start") + F.col("to") + (kind.width - 1)
    spans = told.where(earlier).select("doc", "t1", "t2", F.struct(a.alias("a"), b.alias("b")).alias("span"))
    return spans.groupBy("doc", "t1", "t2").agg(F.collect_set("span").alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans, ascending."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def with_spans(docs: DataFrame, kind: Kind, find: Find, by_start: bool, carry: Sequence[str] = ()) -> DataFrame:
    """Every row of ``docs`` as (doc_id, text, spans, carried0, ...); spans are null where nothing repeats."""
    spans = saved(repeated_spans(docs.select(*row_name()), kind, find, by_start))
    tidy(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *row_name(),
        *[F.col(c).alias(f"carried{i}") for i, c in enumerate(carry)],
    )
    return rows.join(spans, ["doc", "t1", "t2"], "left").drop("doc", "t1", "t2")


__all__ = ["BYTES", "WORDS", "Kind", "merged", "repeated_spans", "verdicts", "with_spans"]

"""MinHash near-duplicates by an inverted join on signature coordinates, confirmed on full shingle sets.

A document's set holds its distinct 5-word shingles. Equal sets fold into one class first, so
copies cost one row. A class has a signature of ``COORDINATES`` minima. Two sets of Jaccard
similarity 0.85 agree in fewer than ``MATCHES`` of them with a probability of 3e-7, so pairs of
``MATCHES`` agreements are candidates. Such a pair agrees at least once in the first
``PREFIX = COORDINATES - MATCHES + 1`` coordinates, hence only those are posted, and the other
agreements are counted from the signatures that the postings carry.

Nothing emits the pairs of a group: a posting list gives a spanning forest of its candidates, and
the sets of each candidate component are compared exactly in memory, which again gives a forest.
Lists and components above a limit are cut into blocks, and each pair of blocks is a group of
its own, so no task holds more than two blocks. Candidates only decide which sets meet; links
come from whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.llm.common import Forest, by_group, components, join_small
from polyspark.llm.text import U64, Texts, grams, mix, slices, words_of
from polyspark.session import discard, saved

WORDS = 5
SIMILARITY = (85, 100)
COORDINATES = 48
MATCHES = 27
PREFIX = COORDINATES - MATCHES + 1
LIST_BLOCK = 2000  # postings of one list compared in one task, before it is cut into blocks
SET_BLOCK = 1024  # sets of one component compared in one task, before it is cut into blocks
SET_BLOCK_BYTES = 16 << 20
NULL_ID = -(1 << 63)

_MULTIPLIERS = mix(np.arange(1, COORDINATES + 1, dtype=U64)) | U64(1)


def shingle_sets(texts: Texts, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, and the offsets of the texts in them.

    A text of 1 to ``size - 1`` words has one shingle, its whole sequence; one without words none.
    """
    words = words_of(texts, lower=True)
    counts = np.diff(words.offs)
    gram = grams(words.hashes, size)
    lengths = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    offs = np.concatenate([[0], np.cumsum(lengths)])
    values = np.empty(int(offs[-1]), U64)
    first = np.ones(len(values), bool)
    for d, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        if a == b:
            continue
        w, n = int(words.offs[d]), int(counts[d])
        if n < size:
            values[a] = grams(words.hashes[w : w + n] + U64(n), n)[0]
            continue
        part = values[a:b]
        part[:] = gram[w : w + n - size + 1]
        part.sort()
        first[a + 1 : b] = part[1:] != part[:-1]
    return values[first], np.concatenate([[0], np.cumsum(first)])[offs]


def set_names(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A 16-byte name per non-empty set (zeros for an empty one): two sums of mixed members."""
    out = np.zeros((len(offs) - 1, 2), U64)
    full = np.flatnonzero(np.diff(offs))
    if len(full):
        at = offs[:-1][full]
        out[full, 0] = np.add.reduceat(mix(values), at)
        out[full, 1] = np.add.reduceat(mix(values ^ U64(0x5851F42D4C957F2D)), at)
    return out


def _rows16(names: np.ndarray) -> pa.Array:
    return fixed(names.view(np.uint8).reshape(len(names), -1))


def fixed(rows: np.ndarray) -> pa.Array:
    """A binary column of equally long rows of bytes."""
    n, width = rows.shape
    offs = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, offs, pa.py_buffer(np.ascontiguousarray(rows))])


def matrix(column: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    """The rows of a binary column of equally long values."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offs[0] : offs[-1]].view(dtype).reshape(len(column), -1)


def signatures(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, th, n_shingles, name, sig): md5 of the text, the set's size, its 16-byte name and its 32-bit minima. Null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            values, offs = shingle_sets(texts)
            sizes = np.diff(offs)
            full = np.flatnonzero(sizes)
            sig = np.full((len(texts), COORDINATES), 0xFFFFFFFF, np.uint32)
            if len(full):
                at = offs[:-1][full]
                for k in range(COORDINATES):
                    sig[full, k] = np.minimum.reduceat(values * _MULTIPLIERS[k], at) >> U64(32)
            names = set_names(values, offs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(sizes, pa.int64()), _rows16(names), fixed(sig.view(np.uint8))],
                ["doc_id", "th", "n_shingles", "name", "sig"],
            )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("th")).mapInArrow(
        run, "doc_id long, th string, n_shingles long, name binary, sig binary"
    )


def postings(classes: DataFrame) -> DataFrame:
    """A row per class and prefix coordinate: key (a hash of coordinate and value), name, size, low bytes of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(PREFIX, dtype=U64) + U64(101))
        for batch in batches:
            if not len(batch):
                continue
            sig = matrix(batch.column("sig"), np.uint32)
            keys = mix(sig[:, :PREFIX].astype(U64) ^ salt).view(np.int64).reshape(-1)
            pick = pa.array(np.repeat(np.arange(len(batch)), PREFIX))
            low = fixed(sig.astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), batch.column("name").take(pick), batch.column("n_shingles").take(pick), low.take(pick)],
                ["key", "name", "n", "low"],
            )

    return classes.select("name", "n_shingles", "sig").mapInArrow(run, "key long, name binary, n long, low binary")


def _close(n: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """Whether set sizes allow the similarity at all."""
    part, whole = SIMILARITY
    return np.minimum(n, m) * whole >= np.maximum(n, m) * part


def _list_forest(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the candidate pairs within whole posting lists."""
    keys = table.column("key").to_numpy()
    n = table.column("n").to_numpy()
    low = matrix(table.column("low"), np.uint8)
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    length = np.diff(cuts)
    forest = Forest(len(keys))
    small = np.repeat(length <= 8, length)
    for d in range(1, 8):
        i = np.flatnonzero((keys[d:] == keys[:-d]) & small[d:])
        i = i[_close(n[i], n[i + d])]
        i = i[(low[i] == low[i + d]).sum(1) >= MATCHES]
        forest.union_all(i, i + d)
    for a, size in zip(cuts[:-1][length > 8].tolist(), length[length > 8].tolist(), strict=True):
        rest = a + np.argsort(n[a : a + size], kind="stable")
        while len(rest):
            queue, rest = [int(rest[0])], rest[1:]
            while queue and len(rest):
                x = queue.pop()
                lo = np.searchsorted(n[rest], -(-n[x] * SIMILARITY[0] // SIMILARITY[1]))
                hi = np.searchsorted(n[rest], n[x] * SIMILARITY[1] // SIMILARITY[0], "right")
                hit = lo + np.flatnonzero((low[rest[lo:hi]] == low[x]).sum(1) >= MATCHES)
                if len(hit):
                    found = rest[hit]
                    forest.union_all(np.full(len(found), x), found)
                    queue += found.tolist()
                    rest = np.delete(rest, hit)
    yield from _edges(table.column("name"), forest.roots())


def _edges(names: pa.ChunkedArray, roots: np.ndarray) -> Iterator[pa.RecordBatch]:
    tied = np.flatnonzero(roots != np.arange(len(roots)))
    if len(tied):
        names = names.combine_chunks()
        yield pa.RecordBatch.from_arrays([names.take(pa.array(tied)), names.take(pa.array(roots[tied]))], ["a", "b"])


def in_blocks(rows: DataFrame, key: str, blocks: str, by: str) -> DataFrame:
    """Gives rows of a large group to every pair of its blocks that holds theirs, under a key of its own.

    ``blocks`` is the number of blocks of the row's group, null or 1 for a group left whole.
    """
    mine = F.pmod(F.xxhash64(by), F.col(blocks))
    other = F.explode(F.when(F.col(blocks) > 1, F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)).otherwise(F.array(F.lit(0).cast("long"))))
    cut = rows.withColumn("_mine", mine).withColumn("_other", other)
    split = F.xxhash64(key, F.least("_mine", "_other"), F.greatest("_mine", "_other"))
    return cut.withColumn(key, F.when(F.col(blocks) > 1, split).otherwise(F.col(key))).drop("_mine", "_other", blocks)


def candidates(classes: DataFrame) -> DataFrame:
    """Candidate links (a, b) between class names: forests of the posting lists."""
    posted = postings(classes)
    hot = posted.groupBy("key").count().where(F.col("count") > LIST_BLOCK)
    hot = saved(hot.select("key", F.ceil(F.col("count") / (LIST_BLOCK // 2)).alias("_blocks")))
    dealt = in_blocks(join_small(posted, hot, "key", "left"), "key", "_blocks", "name")
    return by_group(dealt, "key", _list_forest, "a binary, b binary")


def _set_rows(picked: DataFrame) -> DataFrame:
    """The sets of the classes: rows (key, name, n, members, _blocks) for input (doc_id, text, name, key, _blocks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # a repeated row gives its set once a task
        for batch in batches:
            new = []
            for i, name in enumerate(batch.column("name").to_pylist()):
                if name not in seen:
                    seen.add(name)
                    new.append(i)
            yield from sets(batch.take(pa.array(new, pa.int64())))

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(iter([batch])):
            values, offs = shingle_sets(texts)
            members = pa.BinaryArray.from_buffers(
                pa.binary(), len(texts), [None, pa.py_buffer((offs * 8).astype(np.int32)), pa.py_buffer(values)]
            )
            out = pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("name"), pa.array(np.diff(offs)), members, batch.column("_blocks")],
                ["key", "name", "n", "members", "_blocks"],
            )
            yield out

    return picked.mapInArrow(run, "key long, name binary, n long, members binary, _blocks long")


def similar(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Matrix of which of the sets, laid end to end, reach the similarity."""
    m = len(sizes)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    at = np.cumsum(new) - 1
    held = np.bincount(at) if len(at) else np.zeros(0, np.int64)
    shared = held[at] > 1
    owner, column = owner[shared], (np.cumsum(held > 1) - 1)[at[shared]]
    common = np.zeros((m, m), np.float32)
    width = max(256, (8 << 20) // max(m, 1))
    n_columns = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, n_columns, width):
        i, j = np.searchsorted(column, [a, a + width])
        block = np.zeros((m, min(width, n_columns - a)), np.float32)
        block[owner[i:j], column[i:j] - a] = 1
        common += block @ block.T
    common = common.astype(np.int64)
    part, whole = SIMILARITY
    return whole * common >= part * (sizes[:, None] + sizes[None, :] - common)


def _set_forest(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the links within whole candidate groups, from the full sets."""
    keys = table.column("key").to_numpy()
    names = matrix(table.column("name"), U64)
    n = table.column("n").to_numpy()
    members = table.column("members").combine_chunks()
    offs = np.frombuffer(members.buffers()[1], np.int32)[members.offset : members.offset + len(members) + 1] // 8
    values = np.frombuffer(members.buffers()[2], U64)
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    forest = Forest(len(keys))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a < 2:
            continue
        _, first, back = np.unique(names[a:b], axis=0, return_index=True, return_inverse=True)
        keep = a + first
        forest.union_all(np.arange(a, b), keep[back.reshape(-1)])
        sets = np.concatenate([values[offs[i] : offs[i + 1]] for i in keep.tolist()])
        i, j = np.nonzero(np.triu(similar(sets, n[keep]), 1))
        forest.union_all(keep[i], keep[j])
    yield from _edges(table.column("name"), forest.roots())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Near-duplicate component of every document: doc_id, n_shingles, component_id, kept, group, th.

    Reads doc_id and text. Documents whose sets have a Jaccard similarity of at least 0.85 are
    linked; ``component_id`` is the smallest doc_id reachable over links and ``kept`` marks it.
    ``group`` names the component whatever its ids (null for an empty set), ``th`` is md5 of the
    text and tells rows of one doc_id apart. A
    null or wordless text has an empty set, is linked with nothing and is kept. A null doc_id is
    larger than any other and kept only if its whole component has null ids. Repeated rows come
    out repeated, with equal values. Empty in, empty out.
    """
    signed = saved(signatures(docs))
    classes = saved(
        signed.where("n_shingles > 0").groupBy("name").agg(F.min("doc_id").alias("least"), F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)), "th"))["th"].alias("th"), F.max("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    )
    maybe = components(candidates(classes))
    maybe = saved(maybe.join(classes.select("name", "least", "th", "n_shingles"), F.col("node") == F.col("name")).drop("node"))
    weights = maybe.groupBy("root").agg(F.count("*").alias("_count"), (F.sum("n_shingles") * 8).alias("_bytes"))
    blocks = F.when(
        (F.col("_count") > SET_BLOCK) | (F.col("_bytes") > SET_BLOCK_BYTES),
        F.ceil(F.greatest(F.col("_count") / (SET_BLOCK // 2), F.col("_bytes") / (SET_BLOCK_BYTES // 2))),
    ).otherwise(F.lit(1))
    wanted = saved(
        maybe.join(weights.select("root", blocks.cast("long").alias("_blocks")), "root").select(
            F.coalesce("least", F.lit(NULL_ID)).alias("_id"), F.col("th").alias("_th"), "name", F.xxhash64("root").alias("key"), "_blocks"
        )
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), F.md5(text.cast("binary")).alias("_th"), text.alias("text"))
    sets = _set_rows(join_small(texts, wanted, ["_id", "_th"]).select("text", "name", "key", "_blocks"))
    links = components(by_group(in_blocks(sets, "key", "_blocks", "name"), "key", _set_forest, "a binary, b binary"))
    placed = classes.select("name", "least").join(links, F.col("name") == F.col("node"), "left")
    placed = placed.select("name", "least", F.coalesce("root", "name").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("_component"))
    named = saved(placed.join(smallest, "root").select("name", F.hex("root").alias("group"), "_component"))
    for table in (classes, maybe, wanted):
        discard(table)
    out = signed.select("doc_id", "th", "n_shingles", "name").join(named, "name", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "group", "th")

"""Benchmark decontamination by latent semantic retrieval.

1. Terms are the informative words of the benchmark items: those in at most ``COMMON`` of the
   documents, and of an item with fewer than ``LEAST_TERMS`` such words its rarest ones. Their
   document frequencies are counted over all documents.
2. A randomised SVD of the TF-IDF matrix of all passages: each task adds up its part of
   G times a random matrix (G = transposed matrix times matrix), and the Nystroem form of the
   sum gives singular vectors in one pass. Items count as passages of raised weight, so the
   latent space holds the items themselves.
3. Every passage of every document is projected; a cosine of ``COSINE`` or more with an item makes
   a candidate. There is no cap on candidates.
4. A candidate's words, with as many around the passage as the item is long, must hold a common
   subsequence of ``COVERED`` of the item's words, and of ``ANSWERED`` of its answer, which is
   taken to be the item's last fifth (three words at least).

The benchmark is cut into blocks of bounded size, so what is broadcast and what the driver
decomposes is bounded; each block scans the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.llm.common import by_group
from polyspark.llm.text import U64, Texts, Words, slices, texts_of, words_of

PASSAGE, STRIDE = 48, 24
BLOCK_BYTES = 256 << 10  # of benchmark text searched at once
RANK = 256
COMMON = 0.02
LEAST_TERMS = 6
COSINE = 0.4
COVERED = 0.7
ANSWERED = 0.6
PART = 256  # rows of the sketch that are added up in one group

# letters, digits and all bytes of longer characters make words here, whatever the punctuation
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _words(texts: Texts) -> Words:
    return words_of(texts, lower=True, separators=BREAKS)


@dataclass
class Items:
    """Benchmark items as word hashes, and the terms with their idf."""

    ids: list[int]
    words: list[np.ndarray]
    terms: np.ndarray
    idf: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word among the terms, or -1."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


@dataclass
class Rows:
    """TF-IDF rows of length 1: entry e has ``weight[e]`` of ``term[e]``; row r starts at ``starts[r]`` and is passage ``passage[r]``."""

    term: np.ndarray
    weight: np.ndarray
    starts: np.ndarray
    passage: np.ndarray

    def times(self, matrix: np.ndarray) -> np.ndarray:
        return np.add.reduceat(matrix[self.term] * self.weight[:, None], self.starts, axis=0)


def rows_of(items: Items, passage: np.ndarray, term: np.ndarray) -> Rows:
    """Rows from pairs of passage and term, one pair per occurrence."""
    n = max(len(items.terms), 1)
    both, times = np.unique(passage * n + term, return_counts=True)
    passage, term = both // n, both % n
    weight = (1 + np.log(times)) * items.idf[term]
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]])) if len(passage) else np.zeros(0, np.int64)
    length = np.sqrt(np.add.reduceat(weight**2, starts)) if len(starts) else np.zeros(0)
    weight = weight / np.repeat(length, np.diff(np.concatenate([starts, [len(weight)]])))
    return Rows(term, weight.astype(np.float32), starts, passage[starts])


def passages(words: Words, items: Items, overlap: bool) -> tuple[Rows, np.ndarray, np.ndarray]:
    """Rows of the passages that hold a term, with the first word and the text of every passage.

    Passage j of a text has its words STRIDE * j to STRIDE * j + PASSAGE; without ``overlap``
    passages are every other one, which together hold each word once.
    """
    counts = np.diff(words.offs)
    blocks = -(-counts // STRIDE)
    per = np.maximum(blocks - 1, (counts > 0).astype(np.int64)) if overlap else -(-blocks // 2)
    base = np.concatenate([[0], np.cumsum(per)])
    term = items.find(words.hashes)
    at = np.flatnonzero(term >= 0)
    owner = np.searchsorted(words.offs, at, "right") - 1
    block = (at - words.offs[owner]) // STRIDE
    if overlap:
        this, last = block < per[owner], block > 0
        passage = np.concatenate([(base[owner] + block)[this], (base[owner] + block - 1)[last]])
        term = np.concatenate([term[at][this], term[at][last]])
    else:
        passage, term = base[owner] + block // 2, term[at]
    text = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(int(base[-1])) - base[text]
    return rows_of(items, passage, term), words.offs[text] + nth * STRIDE * (1 if overlap else 2), text


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each word hash occurs, and the number of documents."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items([], [], sent.value, np.zeros(0))
        counts = np.zeros(len(items.terms) + 1, np.int64)
        for _, texts in slices(batches):
            words = _words(texts)
            term = items.find(words.hashes)
            at = np.flatnonzero(term >= 0)
            owner = np.searchsorted(words.offs, at, "right") - 1
            both = np.unique(owner * max(len(items.terms), 1) + term[at])
            counts[:-1] += np.bincount(both % max(len(items.terms), 1), minlength=len(items.terms))
            counts[-1] += len(texts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])

    out = np.zeros(len(terms) + 1, np.int64)
    for row in docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out[:-1], int(out[-1])


def informative(ids: list[int], words: list[np.ndarray], vocabulary: np.ndarray, df: np.ndarray, n: int) -> Items:
    """The items with the terms they are searched by."""
    rare = df <= max(COMMON * n, 2)
    keep = rare.copy()
    for own in words:
        at = np.unique(np.searchsorted(vocabulary, own))
        if np.count_nonzero(rare[at]) < LEAST_TERMS:
            keep[at[np.argsort(df[at], kind="stable")[:LEAST_TERMS]]] = True
    return Items(ids, words, vocabulary[keep], np.log((n + 1) / (df[keep] + 1)) + 1e-3)


def sketch(docs: DataFrame, items: Items, random: np.ndarray) -> tuple[np.ndarray, int]:
    """G times ``random`` over all passages, and the number of passages with a term."""
    sent = docs.sparkSession.sparkContext.broadcast((items, random))
    terms, rank = random.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, random = sent.value
        total, n = np.zeros(random.shape), 0
        for _, texts in slices(batches, limit=1 << 20):
            rows, _, _ = passages(_words(texts), items, overlap=False)
            if not len(rows.starts):
                continue
            n += len(rows.starts)
            z = rows.times(random)
            row = np.repeat(np.arange(len(rows.starts)), np.diff(np.concatenate([rows.starts, [len(rows.term)]])))
            order = np.argsort(rows.term, kind="stable")
            term = rows.term[order]
            cuts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
            total[term[cuts]] += np.add.reduceat(z[row[order]] * rows.weight[order][:, None], cuts, axis=0)
        if n:
            parts = [total[a : a + PART].astype(np.float32).tobytes() for a in range(0, len(total), PART)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary()), pa.array([n] + [0] * (len(parts) - 1), pa.int64())], ["part", "rows", "n"]
            )

    def add(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, rows, n = (table.column(c).to_pylist() for c in ("part", "rows", "n"))
        sums: dict[int, np.ndarray] = {}
        for k, r in zip(keys, rows, strict=True):
            sums[k] = sums.get(k, 0) + np.frombuffer(r, np.float32).astype(np.float64)
        times = {k: sum(x for y, x in zip(keys, n, strict=True) if y == k) for k in sums}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary()), pa.array(list(times.values()), pa.int64())],
            ["part", "rows", "n"],
        )

    out, n = np.zeros((terms, rank)), 0
    schema = "part long, rows binary, n long"
    for row in by_group(docs.select("text").mapInArrow(run, schema), "part", add, schema).collect():
        part = np.frombuffer(row["rows"]).reshape(-1, rank)
        out[row["part"] * PART : row["part"] * PART + len(part)] = part
        n += row["n"]
    return out, n


def singular_vectors(sketched: np.ndarray, random: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors and values of the matrix whose G was sketched (Nystroem form)."""
    q, _ = np.linalg.qr(random)
    shift = 1e-7 * np.linalg.norm(sketched) + 1e-12
    shifted = sketched @ np.linalg.pinv(random.T @ random) @ (random.T @ q) + shift * q  # G times an orthonormal basis of the random matrix
    core = q.T @ shifted
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * values.max()
    half = shifted @ (vectors[:, good] / np.sqrt(values[good]))
    u, s, _ = np.linalg.svd(half, full_matrices=False)
    kept = s**2 - shift > 1e-9 * s[0] ** 2
    return u[:, kept], np.sqrt(np.maximum(s[kept] ** 2 - shift, 0))


def item_rows(items: Items) -> Rows:
    words = np.concatenate(items.words) if items.words else np.zeros(0, U64)
    owner = np.repeat(np.arange(len(items.words)), [len(w) for w in items.words])
    term = items.find(words)
    return rows_of(items, owner[term >= 0], term[term >= 0])


def latent_space(docs: DataFrame, items: Items, seed: int = 11) -> np.ndarray:
    """Terms by latent dimensions."""
    rows = item_rows(items)
    rank = max(1, min(RANK, len(items.terms)))
    random = np.random.default_rng(seed).normal(size=(len(items.terms), rank)).astype(np.float32)
    total, n = sketch(docs, items, random)
    lift = max(n / rank, 1.0)
    z = rows.times(random)
    row = np.repeat(np.arange(len(rows.starts)), np.diff(np.concatenate([rows.starts, [len(rows.term)]])))
    np.add.at(total, rows.term, lift * z[row] * rows.weight[:, None])
    return singular_vectors(total, random)[0].astype(np.float32)


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has a bit per place of each item word."""
    row, full = (1 << size) - 1, (1 << size) - 1
    for w in words:
        mask = masks.get(w)
        if mask is not None:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def search(docs: DataFrame, items: Items, space: np.ndarray) -> DataFrame:
    """Confirmed (doc_id, th, item_id, cosine, covered, answered), the best passage of each document and item."""
    rows = item_rows(items)
    latent = np.zeros((len(items.ids), space.shape[1]), np.float32)
    latent[rows.passage] = rows.times(space)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    sent = docs.sparkSession.sparkContext.broadcast((items, space, latent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, space, latent = sent.value
        answers = [w[-max(3, len(w) // 5) :] for w in items.words]
        whole, tail = [_masks(w) for w in items.words], [_masks(w) for w in answers]
        for batch, texts in slices(batches, limit=1 << 20):
            words = _words(texts)
            rows, begin, text = passages(words, items, overlap=True)
            if not len(rows.starts):
                continue
            z = rows.times(space)
            length = np.linalg.norm(z, axis=1)
            cosine = (z @ latent.T) / np.maximum(length, 1e-12)[:, None]
            found: dict[tuple[int, int], tuple[float, float, float]] = {}
            for r, k in zip(*np.nonzero(cosine >= COSINE), strict=True):
                p = rows.passage[r]
                d, n = int(text[p]), len(items.words[k])
                a = max(int(words.offs[d]), int(begin[p]) - n)
                b = min(int(words.offs[d + 1]), int(begin[p]) + PASSAGE + n)
                near = words.hashes[a:b].tolist()
                covered = common_subsequence(whole[k], n, near) / n
                if covered < COVERED:
                    continue
                answered = common_subsequence(tail[k], len(answers[k]), near) / len(answers[k])
                if answered >= ANSWERED:
                    found[d, k] = max(found.get((d, k), (0.0, 0.0, 0.0)), (covered, answered, float(cosine[r, k])))
            if found:
                at = pa.array([d for d, _ in found], pa.int64())
                columns = list(zip(*found.values(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at),
                        batch.column("th").take(at),
                        pa.array([items.ids[k] for _, k in found], pa.int64()),
                        *(pa.array(columns[i], pa.float64()) for i in (2, 0, 1)),
                    ],
                    ["doc_id", "th", "item_id", "cosine", "covered", "answered"],
                )

    return docs.select("doc_id", "th", "text").mapInArrow(run, "doc_id long, th long, item_id long, cosine double, covered double, answered double")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a benchmark item or a paraphrase: doc_id, item_id, cosine, covered, answered, th.

    Reads doc_id and text of documents, item_id and text of the benchmark. One row per document and
    item, with the best passage's figures; ``th`` is xxhash64 of the text and tells rows of one
    doc_id apart. Null, empty or wordless texts match nothing, on either side. A repeated document
    row is reported again; items of equal text are reported each. Empty in, empty out.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("th"))
    kept = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    found = [spark.createDataFrame([], "doc_id long, th long, item_id long, cosine double, covered double, answered double")]
    for block in range(blocks):
        mine = kept.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).toArrow()
        words = _words(texts_of(mine.column("text")))
        parts = [words.hashes[a:b] for a, b in zip(words.offs[:-1], words.offs[1:], strict=True)]
        full = [i for i, w in enumerate(parts) if len(w)]
        if not full:
            continue
        ids, parts = [mine.column("item_id")[i].as_py() for i in full], [parts[i] for i in full]
        vocabulary = np.unique(np.concatenate(parts))
        df, n = document_frequencies(rows, vocabulary)
        items = informative(ids, parts, vocabulary, df, n)
        found.append(search(rows, items, latent_space(rows, items)))
    return reduce(DataFrame.unionByName, found).select("doc_id", "item_id", "cosine", "covered", "answered", "th")



"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened to arrays.

Statistics come from the whole text and nothing else. Trees are grown level by level on binned
columns by logistic loss; a forest is one set of arrays (column, threshold, children, value), and
scoring moves all documents of a batch down a tree together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.llm.common import held_out
from polyspark.llm.text import Texts, grams, slices, words_of

SAMPLE_ROWS = 20_000  # labelled rows a model is fitted on, at about this many
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAST_ROWS = 8
RIDGE = 1.0

_CLASSES = {
    "letters": [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)],
    "upper": list(range(65, 91)),
    "digits": list(range(48, 58)),
    "stops": [ord(c) for c in ".!?"],
    "commas": [ord(c) for c in ",;:"],
    "symbols": [ord(c) for c in "#$%&*+/<=>@\\^_`{|}~"],
    "bars": [ord("|")],
    "quotes": [ord(c) for c in "\"'()[]"],
    "lines": [10],
    "spaces": [32, 9, 11, 12, 13],
    "wide": list(range(0x80, 0x100)),
    "vowels": [ord(c) for c in "aeiouAEIOU"],
    "controls": [*range(0, 9), *range(14, 32), 127],
}
_LOOKUP = np.zeros((len(_CLASSES), 256), bool)
for _row, _codes in enumerate(_CLASSES.values()):
    _LOOKUP[_row, _codes] = True
COLUMNS = (
    "bytes", "words", *_CLASSES, "word_length", "word_length_spread", "long_words", "short_words", "distinct_words",
    "distinct_pairs", "top_word", "repeated_lines", "line_length", "symbol_words", "sentence_words",
)


def _per_text(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[offs[1:]] - sums[offs[:-1]]


def statistics(texts: Texts) -> np.ndarray:
    """One row of ``COLUMNS`` per text; shares of an empty text are 0."""
    data, offs = texts.data, texts.offs
    size = np.maximum(np.diff(offs), 1)
    words = words_of(texts)
    n = np.diff(words.offs)
    some = np.maximum(n, 1)
    length = (words.ends - words.starts).astype(np.float64)
    out = np.zeros((len(texts), len(COLUMNS)))
    col = {name: i for i, name in enumerate(COLUMNS)}
    out[:, col["bytes"]], out[:, col["words"]] = np.diff(offs), n
    for k, name in enumerate(_CLASSES):
        out[:, col[name]] = _per_text(_LOOKUP[k][data], offs) / size
    mean = _per_text(length, words.offs) / some
    out[:, col["word_length"]] = mean
    out[:, col["word_length_spread"]] = np.sqrt(np.maximum(_per_text(length**2, words.offs) / some - mean**2, 0))
    out[:, col["long_words"]] = _per_text(length > 12, words.offs) / some
    out[:, col["short_words"]] = _per_text(length < 3, words.offs) / some
    symbol = _LOOKUP[list(_CLASSES).index("symbols")]
    if len(words.ends):
        out[:, col["symbol_words"]] = _per_text(symbol[data[words.ends - 1]], words.offs) / some
    out[:, col["sentence_words"]] = n / (1 + _per_text(_LOOKUP[list(_CLASSES).index("stops")][data], offs))
    lines = _per_text(data == 10, offs) + 1
    out[:, col["line_length"]] = np.diff(offs) / lines
    pairs = grams(words.hashes, 2)
    for d in range(len(texts)):
        a, b = int(words.offs[d]), int(words.offs[d + 1])
        if a == b:
            continue
        own = np.sort(words.hashes[a:b])
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
        out[d, col["distinct_words"]] = (len(new) - 1) / (b - a)
        out[d, col["top_word"]] = np.diff(new).max() / (b - a)
        if b - a > 1:
            two = np.sort(pairs[a : b - 1])
            out[d, col["distinct_pairs"]] = (1 + np.count_nonzero(two[1:] != two[:-1])) / (b - a - 1)
        if lines[d] > 1:
            parts = bytes(data[offs[d] : offs[d + 1]]).split(b"\n")
            out[d, col["repeated_lines"]] = 1 - len(set(parts)) / len(parts)
    return out


@dataclass
class Forest:
    """Trees as flat arrays: ``column`` -1 marks a leaf; rows with value <= threshold go left. ``roots`` has each tree's first node."""

    base: float
    column: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(DEPTH):
                column = self.column[node]
                inner = column >= 0
                goes = rows[every, np.maximum(column, 0)] <= self.threshold[node]
                node = np.where(inner, np.where(goes, self.left[node], self.right[node]), node)
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def _best_split(histogram: np.ndarray) -> tuple[float, int, int]:
    """Gain, column and bin of the best split of a node from its (columns, bins, [gradient, hessian, rows]) sums."""
    left = np.cumsum(histogram, axis=1)
    whole = left[:, -1:, :]
    right = whole - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + RIDGE)
    gain = score(left) + score(right) - score(whole)
    gain[(left[..., 2] < LEAST_ROWS) | (right[..., 2] < LEAST_ROWS)] = -1
    at = int(np.argmax(gain))
    return float(gain.reshape(-1)[at]), at // BINS, at % BINS


def grow(rows: np.ndarray, target: np.ndarray) -> Forest:
    """Boosts trees on binned columns; without rows or with one class the forest is its base rate."""
    rate = (target.sum() + 1) / (len(target) + 2)
    base = float(np.log(rate / (1 - rate)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if len(target) >= 2 * LEAST_ROWS and 0 < target.sum() < len(target):
        edges = [np.unique(np.quantile(rows[:, c], np.linspace(0, 1, BINS)[1:-1])) for c in range(rows.shape[1])]
        binned = np.stack([np.searchsorted(e, rows[:, c], "left") for c, e in enumerate(edges)], axis=1)
        columns = rows.shape[1]
        slot = binned + np.arange(columns) * BINS
        total = np.full(len(target), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            gradient, hessian = target - p, p * (1 - p)
            node = np.full(len(target), len(nodes))
            roots.append(len(nodes))
            nodes.append([-1, 0, 0, 0, 0])
            level = [len(nodes) - 1]
            for _ in range(DEPTH):
                below = []
                for at in level:
                    mine = np.flatnonzero(node == at)
                    if len(mine) < 2 * LEAST_ROWS:
                        continue
                    flat = slot[mine].reshape(-1)
                    sums = [np.bincount(flat, np.repeat(w, columns), columns * BINS) for w in (gradient[mine], hessian[mine], np.ones(len(mine)))]
                    gain, c, b = _best_split(np.stack(sums, axis=1).reshape(columns, BINS, 3))
                    if gain <= 1e-9 or b >= len(edges[c]):
                        continue
                    nodes[at][:4] = [c, edges[c][b], len(nodes), len(nodes) + 1]
                    goes = binned[mine, c] <= b
                    node[mine] = np.where(goes, len(nodes), len(nodes) + 1)
                    below += [len(nodes), len(nodes) + 1]
                    nodes += [[-1, 0, 0, 0, 0], [-1, 0, 0, 0, 0]]
                level = below
            for at in range(roots[-1], len(nodes)):
                mine = node == at
                if mine.any():
                    nodes[at][4] = RATE * gradient[mine].sum() / (hessian[mine].sum() + RIDGE)
            total += np.array([x[4] for x in nodes])[node]
    table = np.array(nodes, np.float64).reshape(-1, 5)
    whole = table.astype(np.int64)
    return Forest(base, whole[:, 0], table[:, 1], whole[:, 2], whole[:, 3], table[:, 4], np.array(roots, np.int64))


def fit(docs: DataFrame, labels: DataFrame) -> Forest:
    """Fits to the quality labels of about ``SAMPLE_ROWS`` rows, chosen by a hash of the id; rows held out teach nothing.

    Statistics of the labelled texts are made on the executors, so one short row of numbers per
    sampled document reaches the driver. A doc_id labelled twice counts with its larger label.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    marked = usable.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    share = SAMPLE_ROWS / max(marked.count(), 1)
    draw = (F.xxhash64("doc_id") % 1_000_000_007 + 1_000_000_007) / 2_000_000_014.0
    sample = docs.select("doc_id", "text").join(marked.where(draw < share), "doc_id")
    names = [f"_{c}" for c in COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows = statistics(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_quality"), *(pa.array(c) for c in rows.T)], ["doc_id", "_quality", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got: pd.DataFrame = (
        sample.select("doc_id", F.col("text").cast("string"), F.col("_quality").cast("int"))
        .mapInArrow(run, f"doc_id {kind}, _quality int, " + ", ".join(f"{c} double" for c in names))
        .toPandas()
    )
    got = got.sort_values(["doc_id", *names], kind="stable")
    return grow(got[names].to_numpy(np.float64), got["_quality"].to_numpy(np.float64))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """Quality of every document: doc_id, score (0 to 1).

    Reads doc_id and text only. A null text scores as the empty one. Repeated rows come out
    repeated. Empty in, empty out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.scores(statistics(texts)))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, score double")


__all__ = ["COLUMNS", "Forest", "fit", "grow", "score", "statistics"]

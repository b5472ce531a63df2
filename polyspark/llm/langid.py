"""Language ID: averaged hashed subword embeddings and a linear softmax, trained by SGD in NumPy.

A text's features are its words and their 3- and 4-byte strings (word marks included), hashed to
``BUCKETS`` rows of an embedding. The average of the rows times a matrix gives the logits. As
both steps are linear, a model of fewer languages than dimensions multiplies them out once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.llm.common import held_out, join_small
from polyspark.llm.text import LOWER, U64, Texts, bounds_of_words, range_hashes, ranges, slices, texts_of
from polyspark.session import saved

BUCKETS = 1 << 16
DIMENSIONS = 16
SAMPLE_PER_LANGUAGE = 500  # labelled rows a model is fitted on: about so many of each language,
SAMPLE_ROWS = 20_000  # fewer if there are many languages, but LEAST_PER_LANGUAGE of each
LEAST_PER_LANGUAGE = 20
SAMPLE_BYTES = 64 << 20  # and fewer again if their texts are long: characters of the sample, about
SAMPLE_CHARACTERS = 1 << 16  # longer texts are not drawn for the sample
STEPS = 1500  # gradient steps: whole passes over the sample, at least so many
RATE = 0.5
MANY = 128  # with more languages a gradient is shared by more rows, so steps and rate grow with their number
STEP = 40  # an averaged row moves little by itself
BATCH = 16
ACCEPT = 0.999  # share of rightly predicted calibration texts that rejection must let pass
UNKNOWN = "und"

_TRIGRAM, _FOURGRAM = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all texts, and the text of each."""
    data = np.concatenate([LOWER[texts.data], np.zeros(8, np.uint8)])
    starts, ends, offs = bounds_of_words(texts, data[:-8])
    owner = np.repeat(np.arange(len(texts)), np.diff(offs))
    marked = data.copy()  # separators read as a word mark
    marked[:-8][np.isin(marked[:-8], (0x09, 0x0A, 0x0B, 0x0C, 0x0D))] = 0x20
    n = len(texts.data)
    four = np.ndarray(n, "<u4", marked, 0, (1,)).astype(U64) if n else np.zeros(0, U64)
    at = np.repeat(np.arange(len(texts)), np.diff(texts.offs))
    left = np.repeat(texts.offs[1:], np.diff(texts.offs)) - np.arange(n)
    shift = U64(64 - (BUCKETS.bit_length() - 1))
    three = ((four & U64(0xFFFFFF)) * _TRIGRAM) >> shift
    four = (four * _FOURGRAM) >> shift
    words = range_hashes(data[:-8], starts, ends) >> shift
    ok3, ok4 = left >= 3, left >= 4
    rows = np.concatenate([three[ok3], four[ok4], words]).astype(np.int64)
    return rows, np.concatenate([at[ok3], at[ok4], owner])


@dataclass
class Model:
    """Languages, the row of each feature and the matrix from their average to logits; ``heat`` divides logits, ``least`` is the score below which to reject."""

    languages: list[str]
    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    heat: float
    least: float

    def probabilities(self, texts: Texts) -> np.ndarray:
        rows, owner = features(texts)
        mean = np.empty((len(texts), self.table.shape[1]))
        times = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        for k in range(self.table.shape[1]):
            mean[:, k] = np.bincount(owner, self.table[rows, k], minlength=len(texts)) / times
        return _softmax((mean @ self.weights + self.bias) / self.heat)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: pd.DataFrame, seed: int = 7) -> Model:
    """Fits a model to ``text`` and ``lang``; every fifth row calibrates the softmax and the rejection instead."""
    rows = rows.sort_values(["lang", "text"], kind="stable").reset_index(drop=True)
    languages = sorted(rows["lang"].unique().tolist())
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros(0), 1.0, 0.0)
    target = np.searchsorted(languages, rows["lang"].to_numpy(dtype=str))
    parts = []
    for a in range(0, len(rows), 32):  # a few texts at a time, as each byte makes two features
        feature, owner = features(texts_of(pa.array(rows["text"].iloc[a : a + 32].tolist(), pa.string())))
        both, times = np.unique((owner + a) * BUCKETS + feature, return_counts=True)
        size = np.bincount(owner, minlength=32)
        parts.append(((both % BUCKETS).astype(np.int32), (both // BUCKETS).astype(np.int32), (times / size[both // BUCKETS - a]).astype(np.float32)))
    feature, owner, share = (np.concatenate(x) for x in zip(*parts, strict=True))
    share = share[:, None]
    bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    weights += rng.normal(0, 0.1, weights.shape).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    calibrate = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~calibrate & (np.diff(bounds) > 0))
    more = max(1.0, len(languages) / MANY)
    epochs = -(-int(STEPS * more) // max(1, -(-len(learn) // BATCH)))
    for epoch in range(epochs):
        rate = RATE * more * (1 - epoch / epochs)
        rng.shuffle(learn)
        for a in range(0, len(learn), BATCH):
            batch = learn[a : a + BATCH]
            sizes = bounds[batch + 1] - bounds[batch]
            at = ranges(bounds[batch], sizes)
            picked, weight = feature[at], share[at]
            mean = np.add.reduceat(embedding[picked] * weight, np.cumsum(sizes) - sizes, axis=0)
            p = _softmax(mean @ weights + bias)
            p[np.arange(len(batch)), target[batch]] -= 1
            down = p @ weights.T
            weights -= rate * (mean.T @ p) / len(batch)
            bias -= rate * p.mean(0)
            step = np.repeat(-rate * STEP * down / len(batch), sizes, axis=0) * weight
            for d in range(DIMENSIONS):
                embedding[:, d] += np.bincount(picked, step[:, d], minlength=BUCKETS)
    table, matrix = (embedding @ weights, np.eye(len(languages))) if len(languages) < DIMENSIONS else (embedding, weights)
    model = Model(languages, table.astype(np.float32), matrix.astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    held = np.flatnonzero(calibrate & (np.diff(bounds) > 0))
    if len(held):
        kept = rows["text"].to_numpy()[held]
        chunks = [texts_of(pa.array(kept[a : a + 32].tolist(), pa.string())) for a in range(0, len(held), 32)]
        logits = np.log(np.maximum(np.concatenate([model.probabilities(x) for x in chunks]), 1e-300))
        heats = np.geomspace(0.05, 20, 60)
        loss = [-np.log(np.maximum(_softmax(logits / h)[np.arange(len(held)), target[held]], 1e-12)).mean() for h in heats]
        model.heat = float(heats[int(np.argmin(loss))])
        p = _softmax(logits / model.heat)
        right = p.argmax(1) == target[held]
        if right.any():
            model.least = float(min(np.quantile(p.max(1)[right], 1 - ACCEPT), 1 / len(languages) + 0.25))
    return model


def training_rows(docs: DataFrame) -> DataFrame:
    """About ``SAMPLE_PER_LANGUAGE`` labelled rows of every language, chosen by a hash of the text.

    Each language has an equal part of ``SAMPLE_ROWS`` and ``SAMPLE_BYTES``. Rows held out and texts of more than ``SAMPLE_CHARACTERS`` are left out; whole texts are returned.
    """
    usable = F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARACTERS)
    named = docs.where(usable & ~held_out()).select(
        F.col("text").cast("string"), F.col("lang").cast("string")
    )
    counts = saved(named.groupBy("lang").agg(F.count("*").alias("_n"), F.sum(F.length("text")).alias("_size")))
    languages = max(counts.count(), 1)
    rows = max(min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // languages), LEAST_PER_LANGUAGE)
    share = F.least(rows / F.col("_n"), SAMPLE_BYTES / languages / F.greatest("_size", F.lit(1)))
    least = F.least(F.lit(1.0), 2 / F.col("_n"))  # a language of long texts has some rows all the same
    draw = (F.xxhash64("text") % 1_000_000_007 + 1_000_000_007) / 2_000_000_014.0
    return join_small(named, counts.select("lang", F.greatest(share, least).alias("_share")), "lang").where(draw < F.col("_share")).select("text", "lang")


def fit(docs: DataFrame) -> Model:
    """Fits on a bounded sample: expected size ``SAMPLE_PER_LANGUAGE`` times the number of languages."""
    return train(training_rows(docs).toPandas())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Language of every document: doc_id, lang_pred, score, rejected.

    Reads doc_id and text only. A text that is null or has no letter is ``und`` with score 0 and is
    rejected; so is every text if the model knows no language. Otherwise ``lang_pred`` is the most
    likely language (ties: first by name), ``score`` its calibrated probability, and ``rejected``
    says that the score is below the calibrated threshold. Repeated rows come out repeated. Empty
    in, empty out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch, texts in slices(batches):
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            if model.languages:
                p = model.probabilities(texts)
                best, score = p.argmax(1), p.max(1)
                name = np.array(model.languages, object)[best]
            else:
                score, name = np.zeros(len(texts)), np.full(len(texts), UNKNOWN, object)
                lettered = np.zeros(len(texts), bool)
            name[~lettered] = UNKNOWN
            score = np.where(lettered, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(name, pa.string()), pa.array(score), pa.array(~lettered | (score < model.least))],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    text = F.col("text").cast("string")
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id"), text.alias("text"), lettered.alias("lettered")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    )

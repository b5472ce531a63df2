"""Substring dedup over words: matching statistics against suffix automata of reference shards.

A shard holds the segments of some routes (see ``windows``), the only part of the corpus that the
texts streamed to it can match. Its automaton is built where the shard is, as an automaton of the
whole corpus has no size bound and cannot be broadcast. Streaming a text gives, at every word, the longest
suffix that the shard holds; where that reaches 20 words, the automaton's state for just these 20
words names the window.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from polyspark.llm.text import bounds_of_words, texts_of
from polyspark.llm.windows import WORDS, merged, verdicts, with_spans

WINDOW = 20


class Automaton:
    """Generalised suffix automaton of word sequences, one at a time; state 0 is the root."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = array("q", [-1])
        self.length = array("q", [0])

    def add(self, words: Iterable[int]) -> None:
        """Adds one sequence."""
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for c in words:
            q = nexts[last].get(c)
            if q is not None:  # the shard has this prefix already
                if length[q] == length[last] + 1:
                    last = q
                else:
                    last = self._clone(last, c, q)
                continue
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = new

    def _clone(self, p: int, c: int, q: int) -> int:
        nexts, link = self.next, self.link
        new = len(nexts)
        nexts.append(nexts[q].copy())
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = new
            p = link[p]
        return new

    def states(self, words: Iterable[int], window: int = WINDOW) -> list[int]:
        """At every word, the state of the last ``window`` words, or -1 where the match is shorter."""
        nexts, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for c in words:
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            to = nexts[state].get(c)
            if to is None:
                state = matched = 0
                out.append(-1)
                continue
            state = to
            matched += 1
            if matched < window:
                out.append(-1)
                continue
            while length[link[state]] >= window:
                state = link[state]
            if matched > length[state]:
                matched = length[state]
            out.append(state)
        return out


def find(bodies: pa.Array, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """First places of all windows of the segments: the shard's automaton, then every segment streamed through it."""
    names: dict[bytes, int] = {}
    texts = [[names.setdefault(w, len(names)) for w in body.split(b" ")] for body in bodies.to_pylist()]
    shard = Automaton()
    for words in texts:
        shard.add(words)
    seg, window, group = [], [], []
    for i, words in enumerate(texts):
        states = shard.states(words)[WINDOW - 1 :]
        seg.append(np.full(len(states), i))
        window.append(np.arange(len(states)))
        group.append(states)
    return verdicts(np.concatenate(seg), np.concatenate(window), np.concatenate(group).astype(np.int64), doc, start, by_start=True)


def repeated_words(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every document with its repeated word spans: doc_id, text, spans (array of from, to in words; null if none; may overlap).

    Reads doc_id and text. A span covers windows of 20 words that also start earlier, in a document
    of smaller doc_id or at a smaller word of the same one. A null text has no words; a null doc_id
    is larger than any other; rows of one doc_id count as one document, so repeated rows stand at
    equal places and do not remove each other. Empty in, empty out.
    """
    return with_spans(docs, WORDS, find, by_start=True, carry=carry)


def removed_words(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, kept (remaining words, joined by one space; the text itself if all remain).

    Columns named in ``carry`` follow as they are.
    """
    extra = [f"carried{i}" for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            _, _, offs = bounds_of_words(texts)
            rows = []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text = texts.data[texts.offs[i] : texts.offs[i + 1]].tobytes()
                words = text.translate(_SPACES).split(b" ") if len(text) else []
                words = [w for w in words if w]
                for a, b in reversed(merged(spans) if spans else []):
                    del words[a:b]
                kept = b" ".join(words)
                n = int(offs[i + 1] - offs[i])
                rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), (kept if spans else text).decode()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *(batch.column(c) for c in extra)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", *extra],
            )

    kinds = "".join(f", {e} {docs.schema[c].dataType.simpleString()}" for e, c in zip(extra, carry, strict=True))
    out = repeated_words(docs, carry).mapInArrow(run, f"doc_id long, n_words long, n_removed long, kept_sha256 string, kept string{kinds}")
    return out.withColumnsRenamed(dict(zip(extra, carry, strict=True)))


_SPACES = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))

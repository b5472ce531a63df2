"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text becomes clauses of tokens, and a token one of a few symbols by a lexicon of insults,
threats, targets, negations and reporting verbs. Letter transducers read the symbols: one marks
what stands under a negation, one what is reported speech, one joins insults and threats to their
target. ``compose`` makes them one table of (state, symbol) -> (state, pattern), which all clauses
of a batch walk together. A pattern's weight is the strength of its lexicon entry times the factor
of its kind; a clause's weight is the sum along its path, and a text is scored by its matched
clauses. The lexicon grows by stems that labelled toxic texts hold far more often than others, and
a logistic regression on the clause sums gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.llm.common import crc_rest
from polyspark.llm.text import Texts, range_hashes, slices, texts_of

SAMPLE_ROWS = 20_000  # labelled rows a grammar is fitted on, at about this many
FOLDS = 5
STEM = range(3, 10)  # lengths, in characters, of the stems that are counted
LEAST_TEXTS = 3  # toxic texts a learned stem stands in
LEAST_SHARE = 0.01  # of a text's words, for a stem to count as used in it, and at least
LEAST_TIMES = 2
LEAST_PRECISION = 0.5  # lower confidence bound of the share of toxic texts among those that use a stem
MAX_STEMS = 2_000  # strongest stems kept, part of the fitted model
GAP = 5  # words after which a negation or target no longer reaches
SEED_STRENGTH = 2.0
MATCH = 1.0  # weight from which a clause counts as matched
RIDGE = 0.05

# The seed lexicon, whole words in lower case.
INSULTS = (
    "idiot idiots moron morons imbecile stupid dumb loser losers scum trash filth pathetic worthless disgusting clown "
    "clowns fool fools pig vermin cretin bastard "
    "idiote imbécile crétin ordure salaud dummkopf abschaum arschloch idiota imbécil basura estúpido escoria"
).split()
THREATS = "kill hurt destroy beat crush stab shoot punish tuer frapper töten schlagen matar golpear".split()
TARGETS = "you your yourself u he she they them people everyone tu toi vous du dich ihr sie tú usted ustedes".split()
NEGATIONS = "not no never isn't aren't wasn't don't without pas jamais nicht kein keine nie nunca tampoco".split()
REPORTS = "said says wrote writes quoted reported claims called allegedly dit écrit sagte schrieb dijo escribió".split()

# Symbols of the token classes. A gap stands between tokens more than GAP words apart.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK = range(7)
# Patterns the grammar puts out, and the factor of each.
NONE, PLAIN, DIRECTED, MENACE, DENIED, TOLD = range(6)
FACTORS = np.array([0.0, 1.0, 1.5, 1.5, 0.4, 0.6])


@dataclass
class Transducer:
    """``step[state, symbol]`` is the next state, ``out[state, symbol]`` what is put out; state 0 begins."""

    step: np.ndarray
    out: np.ndarray


def negation() -> Transducer:
    """Reads token symbols; an insult or threat under a negation comes out 7 higher."""
    step = np.zeros((2, 7), int)
    step[:, NEGATION] = 1
    step[1, [INSULT, THREAT, TARGET, REPORT, OTHER]] = 1
    step[1, BREAK] = 0
    out = np.tile(np.arange(7), (2, 1))
    out[1, [INSULT, THREAT]] += 7
    return Transducer(step, out)


def reported() -> Transducer:
    """Reads the symbols of ``negation``; from a reporting verb on insults and threats come out 14 higher."""
    step = np.zeros((2, 14), int)
    step[1] = 1
    step[:, REPORT] = 1
    out = np.tile(np.arange(14), (2, 1))
    for symbol in (INSULT, THREAT, INSULT + 7, THREAT + 7):
        out[1, symbol] += 14
    return Transducer(step, out)


def patterns() -> Transducer:
    """Reads the symbols of ``reported`` and puts out patterns. States: nothing yet, target seen, threat seen."""
    step = np.zeros((3, 28), int)
    out = np.full((3, 28), NONE)
    for state in range(3):
        step[state] = state
        step[state, BREAK] = 0
        step[state, TARGET] = 1
        out[state, INSULT] = DIRECTED if state == 1 else PLAIN
        out[state, THREAT] = MENACE if state == 1 else NONE
        for symbol in (INSULT + 7, THREAT + 7):
            out[state, symbol] = DENIED
        for symbol in (INSULT + 14, THREAT + 14):
            out[state, symbol] = TOLD
        for symbol in (INSULT + 21, THREAT + 21):
            out[state, symbol] = DENIED
    step[0, THREAT] = step[2, THREAT] = 2
    out[2, TARGET] = MENACE
    for symbol in (THREAT + 7, THREAT + 14, THREAT + 21):  # a target after it is no threat to it
        out[1, symbol] = DENIED if symbol != THREAT + 14 else TOLD
        out[0, symbol] = out[2, symbol] = NONE
    return Transducer(step, out)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds what ``first`` puts out to ``second``; states are pairs."""
    a, b = len(first.step), len(second.step)
    left, right = np.divmod(np.arange(a * b), b)
    middle = first.out[left]
    step = first.step[left] * b + second.step[right[:, None], middle]
    return Transducer(step, second.out[right[:, None], middle])


GRAMMAR = compose(compose(negation(), reported()), patterns())


@dataclass
class Lexicon:
    """Hashes of whole words and of stems, sorted, with symbol and strength; the longest stem of a word counts."""

    words: np.ndarray
    word_symbol: np.ndarray
    word_strength: np.ndarray
    stems: np.ndarray
    stem_strength: np.ndarray


def _hash(words: list[str]) -> np.ndarray:
    texts = texts_of(pa.array(words, pa.string()))
    return range_hashes(texts.data, texts.offs[:-1], texts.offs[1:])


def lexicon(stems: dict[str, float]) -> Lexicon:
    words, symbols, strengths = [], [], []
    for symbol, entries in ((INSULT, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
        words += entries
        symbols += [symbol] * len(entries)
        strengths += [SEED_STRENGTH] * len(entries)
    hashes, order = np.unique(_hash(words), return_index=True)
    own = _hash(list(stems))
    by = np.argsort(own)
    return Lexicon(hashes, np.array(symbols)[order], np.array(strengths)[order], own[by], np.array(list(stems.values()), float)[by])


# A letter is an ASCII letter, an apostrophe inside a word or any byte of a longer character except U+2000 to U+2FFF.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), 39, *range(0x80, 0x100)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?;\n"]] = True


@dataclass
class Tokens:
    data: np.ndarray  # lower-cased text
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray  # text of each token
    clause: np.ndarray
    counts: np.ndarray  # tokens of each text


def tokens_of(column: pa.Array) -> Tokens:
    """Words of letters in lower case, and the clauses they stand in: up to a full stop, mark or line break."""
    texts: Texts = texts_of(pc.utf8_lower(pc.fill_null(column.cast(pa.string()), "")))
    data, n = texts.data, len(texts.data)
    none = np.zeros(0, np.int64)
    if not n:
        return Tokens(data, none, none, none, none, np.zeros(len(texts), np.int64))
    letter = _LETTER[data]
    mark = np.flatnonzero(data == 0xE2)  # general punctuation and symbols
    mark = mark[(mark + 2 < n)]
    for k in range(3):
        letter[mark + k] = False
    edge = np.zeros(n + 1, bool)
    edge[texts.offs] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:n]
    last = letter.copy()
    last[:-1] &= ~letter[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    breaks = np.cumsum(_ENDS[data])
    clause = breaks[starts]
    owner = np.searchsorted(texts.offs, starts, "right") - 1
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    return Tokens(data, starts, ends, owner, clause + owner, counts)  # an owner's step keeps texts apart


def _stems(t: Tokens, at: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each stem length: the length, tokens that have it, and the stem's start and end in bytes."""
    begins = np.flatnonzero((t.data & 0xC0) != 0x80)
    picked = np.arange(len(t.starts)) if at is None else at
    place = np.searchsorted(begins, t.starts[picked])
    begins = np.concatenate([begins, [len(t.data)]])
    for k in STEM:
        to = begins[np.minimum(place + k, len(begins) - 1)]
        fits = to <= t.ends[picked]
        picked, place, to = picked[fits], place[fits], to[fits]
        if not len(picked):
            return
        yield k, picked, t.starts[picked], to


def symbols_of(t: Tokens, lex: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and strength of every token."""
    symbol, strength = np.zeros(len(t.starts), np.int64), np.zeros(len(t.starts))
    if not len(t.starts):
        return symbol, strength
    if len(lex.stems):
        for _, token, a, b in _stems(t):
            h = range_hashes(t.data, a, b)
            at = np.minimum(np.searchsorted(lex.stems, h), len(lex.stems) - 1)
            hit = lex.stems[at] == h
            symbol[token[hit]] = INSULT
            strength[token[hit]] = np.maximum(strength[token[hit]], lex.stem_strength[at[hit]])
    h = range_hashes(t.data, t.starts, t.ends)
    at = np.minimum(np.searchsorted(lex.words, h), len(lex.words) - 1)
    hit = np.flatnonzero((lex.words[at] == h) & (symbol == OTHER))
    symbol[hit], strength[hit] = lex.word_symbol[at[hit]], lex.word_strength[at[hit]]
    return symbol, strength


def clause_weights(t: Tokens, lex: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and weight of every clause that has a pattern, and the number of its patterns.

    Only tokens with a symbol are walked, with a break between those far apart; all clauses take
    their next symbol together.
    """
    symbol, strength = symbols_of(t, lex)
    at = np.flatnonzero(symbol != OTHER)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    clause = t.clause[at]
    new = np.concatenate([[True], clause[1:] != clause[:-1]])
    far = np.concatenate([[False], np.diff(at) > GAP]) & ~new
    begin = np.flatnonzero(new)
    length = np.diff(np.concatenate([begin, [len(at)]]))
    state = np.zeros(len(begin), np.int64)
    weight, found = np.zeros(len(begin)), np.zeros(len(begin), np.int64)
    threat = np.zeros(len(begin))  # strength of the threat that awaits its target
    order = np.argsort(-length, kind="stable")
    alive = np.searchsorted(-length[order], -np.arange(length.max()), "left")  # clauses longer than k
    for k in range(int(length.max())):
        c = order[: alive[k]]
        i = begin[c] + k
        s = np.where(far[i], GRAMMAR.step[state[c], BREAK], state[c])
        read = symbol[at[i]]
        out = GRAMMAR.out[s, read]
        own = strength[at[i]]
        own = np.where((out == MENACE) & (read == TARGET), threat[c], own)
        threat[c] = np.where(read == THREAT, strength[at[i]], threat[c])
        weight[c] += own * FACTORS[out]
        found[c] += out != NONE
        state[c] = GRAMMAR.step[s, read]
    some = found > 0
    return t.owner[at[begin]][some], weight[some], found[some]


FEATURES = ("weight", "density", "strongest", "matched")


def clause_sums(column: pa.Array, lex: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` per text: total weight, weight per 100 words, heaviest clause, clauses of weight ``MATCH`` and more; all as log(1 + x)."""
    t = tokens_of(column)
    owner, weight, _ = clause_weights(t, lex)
    n = len(column)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = np.bincount(owner, weight, n)
    out[:, 1] = 100 * out[:, 0] / np.maximum(t.counts, 20)
    np.maximum.at(out[:, 2], owner, weight)
    out[:, 3] = np.bincount(owner[weight >= MATCH], minlength=n)
    return np.log1p(out)


@dataclass
class Grammar:
    """A lexicon and the logistic weights of the clause sums."""

    lex: Lexicon
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    bias: float = 0.0

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-(clause_sums(column, self.lex) @ self.weights + self.bias)))


def _counted(column: pa.Array) -> Iterator[tuple[int, bytes]]:
    """(text, stem) for every stem that makes up ``LEAST_SHARE`` of a text's words."""
    t = tokens_of(column)
    for _, token, a, b in _stems(t):
        h = range_hashes(t.data, a, b)
        order = np.lexsort((h, t.owner[token]))
        own, h, a, b = t.owner[token][order], h[order], a[order], b[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])]))
        times = np.diff(np.concatenate([new, [len(h)]]))
        often = new[times >= np.maximum(LEAST_TIMES, LEAST_SHARE * t.counts[own[new]])]
        for i in often.tolist():
            yield int(own[i]), bytes(t.data[a[i] : b[i]])


def stem_strengths(counts: pd.DataFrame, toxic: float, clean: float) -> dict[str, float]:
    """Strengths (log odds over the base rate) of stems from the toxic and clean texts that use them: columns stem, toxic, clean.

    Of a stem and a longer one that begins with it the one with the larger odds times toxic texts
    is kept, the longer if they are nearly equal, as it fits fewer words by chance.
    """
    use = counts[counts["toxic"] >= LEAST_TEXTS]
    n = (use["toxic"] + use["clean"]).to_numpy(float)
    p = use["toxic"].to_numpy(float) / np.maximum(n, 1)
    z = 1.64
    low = (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    use = use.assign(low=low)[low >= LEAST_PRECISION]
    odds = np.log((use["toxic"] + 0.5) / (toxic + 1)) - np.log((use["clean"] + 0.5) / (clean + 1))
    use = use.assign(odds=odds).sort_values(["toxic", "stem"], ascending=[False, True]).head(4 * MAX_STEMS)
    kept: dict[str, tuple[int, float]] = {}
    by_length = use.sort_values("stem", key=lambda s: s.map(len), kind="stable")
    for stem, n_toxic, strength in zip(by_length["stem"], by_length["toxic"], by_length["odds"], strict=True):
        inside = [stem[:k] for k in range(STEM.start, len(stem)) if stem[:k] in kept]
        if inside and 0.9 * kept[inside[-1]][0] * kept[inside[-1]][1] <= n_toxic * strength:
            del kept[inside[-1]]
            inside.pop()
        if not inside:
            kept[stem] = (n_toxic, float(strength))
    top = sorted(kept.items(), key=lambda x: (-x[1][0] * x[1][1], x[0]))[:MAX_STEMS]
    return {stem: strength for stem, (_, strength) in top}


def _regress(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps with a ridge on the weights; one class gives its base rate."""
    rate = (y.sum() + 1) / (len(y) + 2)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(rate / (1 - rate))
    if not 0 < y.sum() < len(y):
        return w[:-1], float(w[-1])
    full = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([RIDGE * len(y) ** 0.5] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (y - p) - ridge @ w
        curve = (full * (p * (1 - p))[:, None]).T @ full + ridge
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Grammar:
    """Fits to the toxic labels of about ``SAMPLE_ROWS`` rows, chosen by a hash of the id; held-out rows teach nothing.

    Stems are counted by Spark over the sample, by fold, so the regression sees each text through a
    lexicon that was learned without it. The driver gets the stems that ``LEAST_TEXTS`` toxic texts
    use, mostly alone, and one short row of sums per sampled document. A doc_id labelled twice
    counts with its larger label.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_rest("doc_id", 4) != 2))
    marked = usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    share = SAMPLE_ROWS / max(marked.count(), 1)
    draw = (F.xxhash64("doc_id") % 1_000_000_007 + 1_000_000_007) / 2_000_000_014.0
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    sample = docs.select("doc_id", "text").join(marked.where(draw < share), "doc_id")
    sample = sample.select(F.col("text").cast("string").alias("text"), F.col("_toxic").cast("int").alias("toxic"), fold.alias("fold"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in slices(batches):
            found = list(_counted(batch.column("text")))
            row = pa.array([i for i, _ in found], pa.int64())
            stems = pa.array([s for _, s in found], pa.binary())
            yield pa.RecordBatch.from_arrays([stems, batch.column("toxic").take(row), batch.column("fold").take(row)], ["stem", "toxic", "fold"])

    by_fold = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == v), 1).otherwise(0)).alias(f"n{v}{f}") for f in range(FOLDS) for v in (0, 1)]
    totals = lambda v: sum((F.col(f"n{v}{f}") for f in range(FOLDS)), F.lit(0))
    counted = sample.mapInArrow(count, "stem binary, toxic int, fold int").groupBy("stem").agg(*by_fold)
    got = counted.where((totals(1) >= LEAST_TEXTS) & (totals(1) >= totals(0))).toPandas()
    got["stem"] = [bytes(s).decode("utf-8", "replace") for s in got["stem"]]
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}

    def learn(folds: list[int]) -> Lexicon:
        sums = pd.DataFrame({"stem": got["stem"], **{name: sum((got[f"n{v}{f}"] for f in folds), 0 * got["n00"]) for v, name in ((1, "toxic"), (0, "clean"))}})
        return lexicon(stem_strengths(sums, *(sum(sizes.get((f, v), 0) for f in folds) for v in (1, 0))))

    every = list(range(FOLDS))
    others = sample.sparkSession.sparkContext.broadcast([learn([f for f in every if f != out]) for out in every])
    names = [f"_{c}" for c in FEATURES]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in slices(batches):
            sums = np.zeros((len(batch), len(FEATURES)))
            folds = batch.column("fold").to_numpy()
            for f in np.unique(folds).tolist():
                mine = np.flatnonzero(folds == f)
                sums[mine] = clause_sums(batch.column("text").take(pa.array(mine)), others.value[f])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(c) for c in sums.T)], ["toxic", *names])

    rows = sample.mapInArrow(measure, "toxic int, " + ", ".join(f"{c} double" for c in names)).toPandas()
    rows = rows.sort_values(["toxic", *names], kind="stable")
    weights, bias = _regress(rows[names].to_numpy(np.float64), (rows["toxic"].to_numpy(np.float64) > 0).astype(float))
    return Grammar(learn(every), weights, bias)


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Toxicity of every document: doc_id, score (0 to 1).

    Reads doc_id and text only, the whole text. A null text scores as the empty one, which has no
    clause; so does a text without letters. Repeated rows come out repeated, a null id stays.
    Empty in, empty out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.scores(batch.column("text")))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, score double")


__all__ = ["GRAMMAR", "Grammar", "compose", "fit", "lexicon", "score"]

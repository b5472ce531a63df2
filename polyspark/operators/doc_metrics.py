"""Metrics of one document: choices, ROUGE, SARI, perplexity parts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyspark.functions.stem import stem
from polyspark.functions.text import char_ngrams, count_bytes, count_words, ngrams, rouge_tokens

# --- ranked choice --------------------------------------------------------------------------


def pick_choice(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Per document: pred, target, acc and acc_norm from its scored choices.

    The first of equal scores wins, as does a NaN. acc_norm divides by the number of
    characters of the choice. A target that is no choice is an error.
    """
    first = -F.col("req_idx")
    # a division by no characters is infinite, or NaN for zero, as in floating-point arithmetic
    endless = F.when(F.col("ll") == 0, F.lit(float("nan"))).otherwise(F.signum("ll") * F.lit(float("inf")))
    by_length = F.when(F.length("choice") == 0, endless).otherwise(F.try_divide("ll", F.length("choice")))
    is_target = F.col("choice") == F.col("target")
    one = scored.groupBy(*keys).agg(
        F.max_by("choice", F.struct(F.col("ll"), first)).alias("pred"),
        F.max_by("req_idx", F.struct(by_length, first)).alias("_norm_idx"),
        F.first("target").alias("target"),
        F.min(F.when(is_target, F.col("req_idx"))).alias("_target_idx"),
    )
    known = F.when(
        F.col("_target_idx").isNull(), F.raise_error(F.lit("a target is not among its choices")).cast("double")
    )
    return one.select(
        *keys,
        "pred",
        "target",
        known.otherwise((F.col("pred") == F.col("target")).cast("double")).alias("acc"),
        known.otherwise((F.col("_norm_idx") == F.col("_target_idx")).cast("double")).alias("acc_norm"),
    )


def long_metrics(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Wide per-document metrics as rows (metric, value)."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*keys, F.inline(rows))


# --- n-gram overlaps ------------------------------------------------------------------------


def _f_measure(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def _tagged(side: Column, n: int, number: int, chars: bool) -> Column:
    """The n-grams of a side, each with the side's number and its sequence's place there."""
    grams = lambda s: char_ngrams(s, n) if chars else ngrams(s, n)
    row = lambda g, place: F.struct(F.lit(n).alias("n"), g.alias("gram"), F.lit(number).alias("_side"), place.cast("int").alias("_place"))
    return F.flatten(F.transform(side, lambda s, place: F.transform(grams(s), lambda g: row(g, place))))


def _spelled(side: Column, chars: bool) -> Column:
    """The sequences of a side as strings: a space before each token, so that no tokens and an empty one differ."""
    if chars:
        return side
    return F.transform(side, lambda s: F.array_join(F.transform(s, lambda t: F.concat(F.lit(" "), t)), ""))


def _grams(text: str, n: int, chars: bool):
    if chars:
        return [text[i : i + n] for i in range(len(text) - n + 1)]
    tokens = text.split(" ")[1:]
    return tokens if n == 1 else zip(*(tokens[i:] for i in range(n)))


def joint_counts(sides: list[list[str]], orders: list[int], chars: bool, best: list[bool]) -> Iterator[tuple[int, ...]]:
    """For each order: (n, how often an n-gram is on each side, how many n-grams are that often there)."""
    for n in orders:
        counts = []
        for texts, highest in zip(sides, best):
            side = Counter()
            for text in texts:
                if highest:
                    side |= Counter(_grams(text, n, chars))
                else:
                    side.update(_grams(text, n, chars))
            counts.append(side)
        every = set().union(*counts)
        yield (n, *[0] * len(sides), 1)
        for figures, times in Counter(zip(*(map(c.get, every, repeat(0)) for c in counts))).items():
            yield (n, *figures, times)


def _joint_counts(names: list[str], orders: list[int], chars: bool, best: list[bool]) -> Callable[..., Column]:
    """``joint_counts`` over columns with the texts of each side."""
    fields = ["n", *names, "grams"]

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in fields])))
    def run(*columns: pa.Array) -> pa.Array:
        ends, rows = [0], []
        for sides in zip(*(c.to_pylist() for c in columns)):
            rows += joint_counts(list(sides), orders, chars, best)
            ends.append(len(rows))
        flat = np.array(rows, np.int64).reshape(-1, len(fields))
        structs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)

    return run


def gram_counts(
    pairs: DataFrame, keys: list[str], sides: dict[str, Column], orders: list[int], chars: bool = False, best: Iterable[str] = ()
) -> DataFrame:
    """How often n-grams occur on each side: ``keys``, n, one count column per side, and ``grams``.

    ``grams`` is how many n-grams occur that often on the sides, so a pair is a few rows. A side is an array of token
    arrays (of texts, if ``chars``); their counts add up, or the highest counts for a side in ``best``. Every
    (keys, n) has a row of zeros, so empty texts stay. The pairs are shuffled once, as texts, by their keys. A row
    that has its keys for itself is counted where it is; the grams of rows with equal keys are exploded and grouped.
    """
    names, highest = list(sides), [name in set(best) for name in sides]
    at = [f"_side_{i}" for i in range(len(names))]
    known = [F.col(c).isNotNull() & ~F.exists(c, lambda s: s.isNull()) for c in at]
    rows = pairs.select(*keys, *[column.alias(c) for c, column in zip(at, sides.values())])
    if 1 in orders:
        rows = rows.where(reduce(Column.__and__, known))
    rows = rows.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    one_row = _joint_counts(names, orders, chars, highest)
    alone = rows.where(F.col("_rows") == 1).select(*keys, F.inline(one_row(*[_spelled(F.col(c), chars) for c in at])))
    zeros = [F.struct(F.lit(n).alias("n"), F.lit(None).cast("string").alias("gram"), F.lit(-1).alias("_side"), F.lit(0).alias("_place")) for n in orders]
    parts = [F.array(*zeros)]
    for n in orders:
        parts += [_tagged(F.col(c), n, i, chars) for i, c in enumerate(at)]
    found = [*keys, "n", "gram"]
    flat = rows.where(F.col("_rows") > 1).select(*keys, F.inline(F.concat(*parts)))
    per_place = flat.groupBy(*found, "_side", "_place").agg(F.count(F.lit(1)).alias("_c"))
    of = lambda i: F.coalesce((F.max if highest[i] else F.sum)(F.when(F.col("_side") == i, F.col("_c"))), F.lit(0))
    shared = per_place.groupBy(*found).agg(*[of(i).alias(name) for i, name in enumerate(names)])
    return alone.unionByName(shared.select(*keys, F.col("n").cast("bigint").alias("n"), *names, F.lit(1).cast("bigint").alias("grams")))


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pd.Series) -> pd.Series:
    """Stems the tokens of more than three letters."""
    return tokens.map(lambda row: None if row is None else [stem(t) if len(t) > 3 else t for t in row])


def tokens_for_rouge(text: Column, stemmed: bool) -> Column:
    tokens = rouge_tokens(text)
    return stem_tokens(tokens) if stemmed else tokens


def rouge_n(
    pairs: DataFrame,
    keys: list[str],
    orders: list[int] = [1, 2],
    ref: str = "reference",
    pred: str = "prediction",
    stemmed: bool = True,
) -> DataFrame:
    """ROUGE-N per pair: ``keys``, n, precision, recall, fmeasure."""
    tokens = pairs.select(
        *keys,
        tokens_for_rouge(F.col(ref), stemmed).alias("_ref"),
        tokens_for_rouge(F.col(pred), stemmed).alias("_pred"),
    )
    counts = gram_counts(tokens, keys, {"in_ref": F.array("_ref"), "in_pred": F.array("_pred")}, orders)
    sums = counts.groupBy(*keys, "n").agg(
        F.sum(F.least("in_ref", "in_pred") * F.col("grams")).alias("hits"),
        F.sum(F.col("in_ref") * F.col("grams")).alias("n_ref"),
        F.sum(F.col("in_pred") * F.col("grams")).alias("n_pred"),
    )
    p = F.col("hits") / F.greatest("n_pred", F.lit(1))
    r = F.col("hits") / F.greatest("n_ref", F.lit(1))
    return sums.select(*keys, F.col("n").cast("int").alias("n"), p.alias("precision"), r.alias("recall"), _f_measure(p, r).alias("fmeasure"))


def _codes(tokens_a: list[str], tokens_b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    ids: dict[str, int] = {}
    return tuple(np.array([ids.setdefault(t, len(ids)) for t in side], dtype=np.int64) for side in (tokens_a, tokens_b))


class LcsRows:
    """Rows of the table of common subsequence lengths of all prefixes, each as the bits of one integer.

    Along a row the length rises by one or stays; bit j is set if it stays at token j of ``b``. A row follows from the
    one before by a few operations on integers. Every ``stride``-th row is kept and those between are made again when
    asked for, so a pair of n and m tokens takes about 2 m sqrt(n) bits, not n m numbers.
    """

    def __init__(self, a, b) -> None:
        self.a, self.full = a, (1 << len(b)) - 1
        self.where: dict = {}
        for j, token in enumerate(b):
            self.where[token] = self.where.get(token, 0) | (1 << j)
        self.stride = math.isqrt(len(a)) + 1
        self.kept = [self.full]
        self.last = self.full
        for i, token in enumerate(a, 1):
            self.last = self._next(self.last, token)
            if i % self.stride == 0:
                self.kept.append(self.last)
        self.block, self.rows = -1, []

    def _next(self, row: int, token) -> int:
        taken = row & self.where.get(token, 0)
        return ((row + taken) | (row - taken)) & self.full

    def row(self, i: int) -> int:
        """The row after ``i`` tokens of ``a``; cheap if asked for in falling order."""
        block, at = divmod(i, self.stride)
        if block != self.block:
            self.block, self.rows = block, [self.kept[block]]
            for token in self.a[block * self.stride : (block + 1) * self.stride - 1]:
                self.rows.append(self._next(self.rows[-1], token))
        return self.rows[at]


def _rises(row: int, j: int) -> int:
    """The length a row stands for after ``j`` tokens."""
    return j - (row & ((1 << j) - 1)).bit_count()


def lcs_length(a, b) -> int:
    return _rises(LcsRows(a, b).last, len(b))


def lcs_positions(a, b) -> set[int]:
    """Positions of ``a`` in one longest common subsequence with ``b``; ties go to the later token of ``b``."""
    table = LcsRows(a, b)
    i, j, found = len(a), len(b), set()
    here, above = table.last, table.row(i - 1) if i else 0
    while i and j:
        match = a[i - 1] == b[j - 1]
        if match:
            found.add(i - 1)
            j -= 1
        elif _rises(here, j - 1) > _rises(above, j):
            j -= 1
            continue
        i -= 1
        here, above = above, table.row(i - 1) if i else 0
    return found


def _scores(hits: int, n_ref: int, n_pred: int) -> tuple[float, float, float]:
    if not n_ref or not n_pred:
        return 0.0, 0.0, 0.0
    p, r = hits / n_pred, hits / n_ref
    return p, r, (2 * p * r / (p + r) if p + r > 0 else 0.0)


def rouge_l_pair(ref: list[str], pred: list[str]) -> tuple[float, float, float]:
    a, b = _codes(ref, pred)
    return _scores(lcs_length(a.tolist(), b.tolist()), len(ref), len(pred))


def rouge_lsum_pair(ref: list[list[str]], pred: list[list[str]]) -> tuple[float, float, float]:
    """Union of the common subsequences of each reference sentence with all predicted ones."""
    flat_ref, flat_pred = [t for s in ref for t in s], [t for s in pred for t in s]
    if not flat_ref or not flat_pred:
        return 0.0, 0.0, 0.0
    a, b = _codes(flat_ref, flat_pred)
    cut = lambda codes, sents: [part.tolist() for part in np.split(codes, np.cumsum([len(s) for s in sents])[:-1])]
    left_ref = np.bincount(a, minlength=len(a) + len(b))
    left_pred = np.bincount(b, minlength=len(a) + len(b))
    hits = 0
    for sentence in cut(a, ref):
        union = set().union(*[lcs_positions(sentence, other) for other in cut(b, pred)])
        for at in sorted(union):
            token = sentence[at]
            if left_ref[token] > 0 and left_pred[token] > 0:
                hits += 1
                left_ref[token] -= 1
                left_pred[token] -= 1
    return _scores(hits, len(a), len(b))


TRIPLE = T.StructType([T.StructField(f, T.DoubleType()) for f in ("precision", "recall", "fmeasure")])


def _rouge_lcs(stemmed: bool) -> Callable[..., Column]:
    """Both figures of a pair; a text is its sentences as lines of tokens, which is far less to hand over than arrays."""

    def tokens(text: str) -> list[list[str]]:
        lines = [line.split() for line in text.split("\n")]
        return [[stem(t) if len(t) > 3 else t for t in line] for line in lines] if stemmed else lines

    @F.pandas_udf(T.StructType([T.StructField(k, TRIPLE) for k in ("rougeL", "rougeLsum")]))
    def run(ref: pd.Series, pred: pd.Series) -> pd.DataFrame:
        rows = []
        names = ("precision", "recall", "fmeasure")
        for r, p in zip(ref, pred):
            r, p = tokens(r), tokens(p)
            whole = rouge_l_pair([t for s in r for t in s], [t for s in p for t in s])
            rows.append((dict(zip(names, whole)), dict(zip(names, rouge_lsum_pair(r, p)))))
        return pd.DataFrame(rows, columns=["rougeL", "rougeLsum"])

    return run


def sentences(text: Column) -> Column:
    """Pieces after each full stop and at line breaks, without the empty ones."""
    return F.filter(F.split(F.replace(text, F.lit("."), F.lit(".\n")), "\n"), lambda s: s != "")


def rouge_l(
    pairs: DataFrame, keys: list[str], ref: str = "reference", pred: str = "prediction", stemmed: bool = True
) -> DataFrame:
    """ROUGE-L and ROUGE-Lsum per pair, as structs of precision, recall, fmeasure."""

    def tokenised(text: Column) -> Column:
        return F.array_join(F.transform(sentences(text), lambda s: F.array_join(rouge_tokens(s), " ")), "\n")

    scored = pairs.select(*keys, _rouge_lcs(stemmed)(tokenised(F.col(ref)), tokenised(F.col(pred))).alias("_both"))
    return scored.select(*keys, "_both.rougeL", "_both.rougeLsum")


def rouge_multi_ref(scores: DataFrame, keys: list[str], ref_idx: str = "ref_idx") -> DataFrame:
    """Averages, over each left-out reference, the score of the best other reference.

    Only the best two references matter: the best is taken each time but when it is
    left out itself. ``scores`` has ``keys``, ``ref_idx``, precision, recall, fmeasure.
    """
    ranked = scores.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(
                F.struct((-F.col("fmeasure")).alias("f"), F.col(ref_idx), "precision", "recall", "fmeasure")
            )
        ).alias("_r")
    )
    m = F.size("_r")
    best, second = F.element_at("_r", 1), F.try_element_at("_r", F.lit(2))
    mean = lambda f: F.when(m == 1, best[f]).otherwise(((m - 1) * best[f] + second[f]) / m)
    return ranked.select(*keys, *[mean(f).alias(f) for f in ("precision", "recall", "fmeasure")])


def rouge(pairs: DataFrame, keys: list[str], refs: str = "references", pred: str = "prediction", stemmed: bool = True) -> DataFrame:
    """The twelve ROUGE figures per pair with one or more references, as wide columns."""
    one = pairs.select(*keys, pred, F.posexplode(refs).alias("ref_idx", "reference"))
    per_ref = [*keys, "ref_idx"]
    n_scores = rouge_n(one, per_ref, [1, 2], "reference", pred, stemmed).select(
        *per_ref, F.concat(F.lit("rouge"), F.col("n").cast("string")).alias("kind"), "precision", "recall", "fmeasure"
    )
    l_scores = rouge_l(one, per_ref, "reference", pred, stemmed).select(
        *per_ref,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("kind"), *[F.col(f"{k}.{f}").alias(f) for f in ("precision", "recall", "fmeasure")])
                    for k in ("rougeL", "rougeLsum")
                ]
            )
        ),
    )
    mean = rouge_multi_ref(n_scores.unionByName(l_scores), [*keys, "kind"])
    return mean.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("kind") == k, F.col(f))).alias(f"{k}_{f}")
            for k in ("rouge1", "rouge2", "rougeL", "rougeLsum")
            for f in ("precision", "recall", "fmeasure")
        ]
    )


def max_over_refs(scores: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The best score of a prediction over its references."""
    return scores.groupBy(*keys).agg(F.max(value).alias(value))


# --- SARI -----------------------------------------------------------------------------------


def _ratio(total: Column, count: Column) -> Column:
    return F.when(count > 0, total / count).otherwise(F.lit(0.0))


def sari(
    rows: DataFrame, keys: list[str], source: str = "source", pred: str = "prediction", refs: str = "references"
) -> DataFrame:
    """SARI per row: keep F, delete precision and add F, averaged over n = 1..4, divided by 3."""
    split = lambda c: F.split(F.lower(c), " ")
    tokens = rows.select(
        *keys,
        split(F.col(source)).alias("_s"),
        split(F.col(pred)).alias("_c"),
        F.transform(refs, split).alias("_refs"),
        F.size(refs).alias("_m"),
    )
    with_m = [*keys, "_m"]

    sides = {"s": F.array("_s"), "c": F.array("_c"), "r": F.col("_refs")}
    counts = gram_counts(tokens, with_m, sides, [1, 2, 3, 4])
    s, c, r = F.col("s") * F.col("_m"), F.col("c") * F.col("_m"), F.col("r")
    keep, keep_all = F.least(s, c), F.least(s, r)
    keep_good = F.least(keep, r)
    drop = F.greatest(s - c, F.lit(0))
    drop_good = F.greatest(drop - r, F.lit(0))
    added = (F.col("c") > 0) & (F.col("s") == 0)
    wanted = (F.col("r") > 0) & (F.col("s") == 0)
    share = lambda good, of: F.sum(F.when(of > 0, good / of * F.col("grams")))
    number = lambda which: F.sum(F.when(which, F.col("grams")).otherwise(0))
    per_n = counts.groupBy(*with_m, "n").agg(
        _ratio(share(keep_good, keep), number(keep > 0)).alias("keep_p"),
        _ratio(share(keep_good, keep_all), number(keep_all > 0)).alias("keep_r"),
        _ratio(share(drop_good, drop), number(drop > 0)).alias("del_p"),
        _ratio(number(added & wanted).cast("double"), number(added)).alias("add_p"),
        _ratio(number(added & wanted).cast("double"), number(wanted)).alias("add_r"),
    )
    total = (
        _f_measure(F.col("keep_p"), F.col("keep_r")) + F.col("del_p") + _f_measure(F.col("add_p"), F.col("add_r"))
    )
    return per_n.groupBy(*keys).agg((F.sum(total) / 4 / 3).alias("sari"))


# --- perplexity -----------------------------------------------------------------------------


def text_sizes(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds words and bytes of the text: all that perplexity needs of it."""
    return df.withColumns({"words": count_words(F.col(text)), "bytes": count_bytes(F.col(text))})


def perplexity_parts(df: DataFrame, text: str | None = "text", ll: str = "ll") -> DataFrame:
    """Adds words, bytes and the three figures of a single document.

    A figure per byte of an empty text is null. With ``text`` None the rows have words and bytes
    already (``text_sizes``), so that a score need not be joined to a text.
    """
    df = df if text is None else text_sizes(df, text)
    per_word, per_byte = (F.try_divide(F.col(ll), F.col(size)) for size in ("words", "bytes"))
    return df.withColumns(
        {
            "word_perplexity_instance": F.exp(-per_word),
            "byte_perplexity_instance": F.exp(-per_byte),
            "bits_per_byte_instance": -per_byte / F.log(F.lit(2.0)),
        }
    )


def perplexity_pairs(df: DataFrame, keys: list[str], ll: str = "ll") -> DataFrame:
    """Rows (metric, value, weight) for the weighted aggregates."""
    row = lambda metric, weight: F.struct(
        F.lit(metric).alias("metric"), F.col(ll).alias("value"), F.col(weight).cast("double").alias("weight")
    )
    return df.select(
        *keys,
        F.inline(F.array(row("word_perplexity", "words"), row("byte_perplexity", "bytes"), row("bits_per_byte", "bytes"))),
    )

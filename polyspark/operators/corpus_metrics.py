"""Corpus BLEU, chrF and TER: per-pair sums first, then a closed form over their totals."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyspark.functions.text import tokens_13a, words
from polyspark.operators.doc_metrics import gram_counts

# N-gram orders and weights of the published metrics.
BLEU_ORDERS = [1, 2, 3, 4]
CHRF_ORDERS = [1, 2, 3, 4, 5, 6]
CHRF_BETA = 2
LOG_OF_ZERO = -9999999999.0


def bleu_stats(
    pairs: DataFrame,
    keys: list[str],
    pred: str = "prediction",
    refs: str = "references",
    tokenize=tokens_13a,
) -> DataFrame:
    """Per pair: correct_1..4 (clipped by the best reference), total_1..4, sys_len, ref_len.

    ref_len is the reference length closest to the prediction's, the shorter on a tie.
    """
    tokens = pairs.select(
        *keys, tokenize(F.col(pred)).alias("_p"), F.transform(refs, lambda r: tokenize(r)).alias("_r")
    )
    size = F.size("_p")
    closest = F.array_min(
        F.transform("_r", lambda r: F.struct(F.abs(F.size(r) - size).alias("off"), F.size(r).alias("len")))
    )["len"]
    # the lengths ride along as keys, so that no join is needed
    sized = tokens.withColumns({"sys_len": size.cast("bigint"), "ref_len": closest.cast("bigint")})
    pair = [*keys, "sys_len", "ref_len"]
    counts = gram_counts(sized, pair, {"p": F.array("_p"), "r": F.col("_r")}, BLEU_ORDERS, best=["r"])
    of = lambda n, c: F.sum(F.when(F.col("n") == n, c * F.col("grams")).otherwise(0))
    return counts.groupBy(*pair).agg(
        *[of(n, F.least("p", "r")).alias(f"correct_{n}") for n in BLEU_ORDERS],
        *[of(n, F.col("p")).alias(f"total_{n}") for n in BLEU_ORDERS],
    )


BLEU_SUMS = [f"{kind}_{n}" for kind in ("correct", "total") for n in BLEU_ORDERS] + ["sys_len", "ref_len"]


def bleu_score() -> Column:
    """BLEU from summed statistics, with exponential smoothing of orders without a match."""
    correct = [F.col(f"correct_{n}").cast("double") for n in BLEU_ORDERS]
    total = [F.col(f"total_{n}").cast("double") for n in BLEU_ORDERS]
    logs = F.lit(0.0)
    halvings = F.lit(0)
    alive = F.lit(True)
    for c, t in zip(correct, total):
        alive = alive & (t > 0)
        halvings = halvings + F.when(alive & (c == 0), 1).otherwise(0)
        value = (
            F.when(~alive, F.lit(LOG_OF_ZERO))
            .when(c == 0, F.log(F.lit(100.0) / (F.pow(F.lit(2.0), halvings) * t)))
            .otherwise(F.log(100.0 * c / t))
        )
        logs = logs + value
    short = F.col("sys_len") < F.col("ref_len")
    penalty = F.when(short & (F.col("sys_len") > 0), F.exp(1 - F.col("ref_len") / F.col("sys_len"))).otherwise(
        F.when(short, 0.0).otherwise(1.0)
    )
    matched = correct[0] + correct[1] + correct[2] + correct[3]
    return F.when(matched == 0, F.lit(0.0)).otherwise(penalty * F.exp(logs / 4))


def bleu(stats: DataFrame, by: list[str]) -> DataFrame:
    return stats.groupBy(*by).agg(*[F.sum(c).alias(c) for c in BLEU_SUMS]).select(*by, bleu_score().alias("bleu"))


def chrf_stats(pairs: DataFrame, keys: list[str], pred: str = "prediction", refs: str = "references") -> DataFrame:
    """Per pair: hyp_1..6, ref_1..6, match_1..6 of the character n-grams without white space.

    With several references, those of the reference with the best score are kept.
    """
    squeezed = lambda text: F.array_join(words(text), "")
    one = pairs.select(*keys, F.col(pred).alias("_pred"), F.posexplode(refs).alias("ref_idx", "_one"))
    per_ref = [*keys, "ref_idx"]
    tokens = one.select(*per_ref, squeezed(F.col("_pred")).alias("_p"), squeezed(F.col("_one")).alias("_r"))
    counts = gram_counts(tokens, per_ref, {"p": F.array("_p"), "r": F.array("_r")}, CHRF_ORDERS, chars=True)
    of = lambda n, c: F.sum(F.when(F.col("n") == n, c * F.col("grams")).otherwise(0))
    sums = counts.groupBy(*per_ref).agg(
        *[of(n, F.col("p")).alias(f"_hyp_{n}") for n in CHRF_ORDERS],
        *[of(n, F.col("r")).alias(f"ref_{n}") for n in CHRF_ORDERS],
        *[of(n, F.least("p", "r")).alias(f"match_{n}") for n in CHRF_ORDERS],
    )
    # a prediction's n-grams count only where the reference has n-grams of that order
    full = sums.withColumns(
        {f"hyp_{n}": F.when(F.col(f"ref_{n}") > 0, F.col(f"_hyp_{n}")).otherwise(0) for n in CHRF_ORDERS}
    )
    best = F.max_by(F.struct(*CHRF_SUMS), F.struct(chrf_score(), -F.col("ref_idx")))
    return full.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


CHRF_SUMS = [f"{kind}_{n}" for kind in ("hyp", "ref", "match") for n in CHRF_ORDERS]


def chrf_score() -> Column:
    """chrF from summed statistics: averages over the orders both sides have, F with beta 2."""
    precision, recall, orders = F.lit(0.0), F.lit(0.0), F.lit(0)
    for n in CHRF_ORDERS:
        hyp, ref, match = (F.col(f"{kind}_{n}").cast("double") for kind in ("hyp", "ref", "match"))
        both = (hyp > 0) & (ref > 0)
        precision = precision + F.when(both, match / hyp).otherwise(0.0)
        recall = recall + F.when(both, match / ref).otherwise(0.0)
        orders = orders + F.when(both, 1).otherwise(0)
    p, r = precision / F.greatest(orders, F.lit(1)), recall / F.greatest(orders, F.lit(1))
    factor = float(CHRF_BETA**2)
    return F.when(p + r > 0, 100.0 * (1 + factor) * p * r / (factor * p + r)).otherwise(0.0)


def chrf(stats: DataFrame, by: list[str]) -> DataFrame:
    return stats.groupBy(*by).agg(*[F.sum(c).alias(c) for c in CHRF_SUMS]).select(*by, chrf_score().alias("chrf"))


# --- TER ------------------------------------------------------------------------------------

# Limits of the published shift search.
MAX_SHIFT_SIZE = 10
MAX_SHIFT_DISTANCE = 50
MAX_SHIFT_CANDIDATES = 1000


class EditRows:
    """Rows of the table of word edits from prefixes of ``hyp`` to prefixes of ``ref``, as bits of two integers.

    Along a row the number of edits rises by one (a bit of the first), falls by one (a bit of the second) or stays; the
    row after i words of ``hyp`` begins with i edits.
    """

    def __init__(self, hyp: list[str], ref: list[str]) -> None:
        self.hyp, self.ref, self.full = hyp, ref, (1 << len(ref)) - 1
        self.where: dict[str, int] = {}
        for j, word in enumerate(ref):
            self.where[word] = self.where.get(word, 0) | (1 << j)
        self.rows = [(self.full, 0)]
        for word in hyp:
            self.rows.append(self._next(self.rows[-1], word))
        self.edits = self._value(self.rows[-1], len(hyp), len(ref))

    def _next(self, row: tuple[int, int], word: str) -> tuple[int, int]:
        up, down = row
        same = self.where.get(word, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        rise, fall = down | (self.full & ~(horizontal | up)), up & horizontal
        rise, fall = (rise << 1) | 1, fall << 1
        return (fall | ~(vertical | rise)) & self.full, rise & vertical & self.full

    @staticmethod
    def _value(row: tuple[int, int], i: int, j: int) -> int:
        mask = (1 << j) - 1
        return i + (row[0] & mask).bit_count() - (row[1] & mask).bit_count()

    def path(self) -> str:
        """The edits in order: ``=`` same, ``s`` swap, ``d`` drop from hyp, ``i`` insert; on a tie in that order."""
        path, i, j, left = [], len(self.hyp), len(self.ref), self.edits
        while i and j:
            same = self.hyp[i - 1] == self.ref[j - 1]
            if self._value(self.rows[i - 1], i - 1, j - 1) + (not same) == left:
                path.append("=" if same else "s")
                i, j, left = i - 1, j - 1, left - (not same)
            elif self._value(self.rows[i - 1], i - 1, j) + 1 == left:
                path.append("d")
                i, left = i - 1, left - 1
            else:
                path.append("i")
                j, left = j - 1, left - 1
        return "i" * j + "d" * i + "".join(reversed(path))

    def edits_of(self, moved: list[str], low: int, high: int) -> int:
        """Edits of a list that differs from ``hyp`` between ``low`` and ``high`` only.

        Rows before are known, and once a row after equals that of ``hyp`` all later ones do.
        """
        row = self.rows[low]
        for i in range(low, len(moved)):
            if i >= high and row == self.rows[i]:
                return self.edits
            row = self._next(row, moved[i])
        return self._value(row, len(moved), len(self.ref))


def _alignment(path: str) -> tuple[list[int], list[bool], list[bool]]:
    """For each ref word the hyp position it aligns to, and which hyp and ref words are wrong."""
    at, hyp_wrong, ref_wrong, hyp_pos = [], [], [], -1
    for step in path:
        if step != "i":
            hyp_pos += 1
            hyp_wrong.append(step != "=")
        if step != "d":
            at.append(hyp_pos)
            ref_wrong.append(step != "=")
    return at, hyp_wrong, ref_wrong


def _best_shift(table: EditRows, tried: int):
    """The block move that saves most edits; ties: longer block, then earlier source and target."""
    hyp, ref = table.hyp, table.ref
    at, hyp_wrong, ref_wrong = _alignment(table.path())
    starts: dict[str, list[int]] = {}
    for j, word in enumerate(ref):
        starts.setdefault(word, []).append(j)
    best = None
    for i in range(len(hyp)):
        for j in starts.get(hyp[i], ()):
            if abs(j - i) > MAX_SHIFT_DISTANCE:
                continue
            size = 0
            while size < MAX_SHIFT_SIZE and i + size < len(hyp) and j + size < len(ref) and hyp[i + size] == ref[j + size]:
                size += 1
                if not any(hyp_wrong[i : i + size]) or not any(ref_wrong[j : j + size]):
                    continue
                if i <= at[j] < i + size:
                    continue
                targets = {at[j - 1] + 1 if j else 0} | {at[j + k] + 1 for k in range(size)}
                for to in sorted(t for t in targets if not i <= t < i + size):
                    block, rest = hyp[i : i + size], hyp[:i] + hyp[i + size :]
                    place = to if to < i else to - size
                    moved = rest[:place] + block + rest[place:]
                    saved = table.edits - table.edits_of(moved, min(i, place), max(i, place) + size)
                    candidate = (saved, size, -i, -to, moved)
                    best = max(best, candidate) if best else candidate
                    tried += 1
                if tried >= MAX_SHIFT_CANDIDATES:
                    return best, tried
    return best, tried


def ter_edits(hyp: list[str], ref: list[str]) -> int:
    """Shifts plus word edits that turn ``hyp`` into ``ref``, found greedily."""
    if not ref:
        return len(hyp)
    shifts, tried = 0, 0
    table = EditRows(hyp, ref)
    while tried < MAX_SHIFT_CANDIDATES:
        best, tried = _best_shift(table, tried)
        if best is None or best[0] <= 0:
            break
        shifts += 1
        table = EditRows(best[4], ref)
    return shifts + table.edits


TER_PAIR = T.StructType([T.StructField(c, T.DoubleType()) for c in ("edits", "ref_len")])


@F.pandas_udf(TER_PAIR)
def _ter_pair(pred: pd.Series, refs: pd.Series) -> pd.DataFrame:
    rows = []
    for p, rs in zip(pred, refs):
        p, rs = list(p), [list(r) for r in rs]
        rows.append((float(min(ter_edits(p, r) for r in rs)), sum(len(r) for r in rs) / len(rs)))
    return pd.DataFrame(rows, columns=["edits", "ref_len"])


TER_SUMS = ["edits", "ref_len"]


def ter_stats(pairs: DataFrame, keys: list[str], pred: str = "prediction", refs: str = "references") -> DataFrame:
    """Per pair: fewest edits over the references, and their mean length, in lower-case words."""
    tokens = lambda c: words(F.lower(c))
    scored = pairs.select(*keys, _ter_pair(tokens(F.col(pred)), F.transform(refs, tokens)).alias("_t"))
    return scored.select(*keys, "_t.edits", "_t.ref_len")


def ter_score() -> Column:
    ref, edits = F.col("ref_len"), F.col("edits")
    return F.when(ref > 0, 100.0 * edits / ref).when(edits > 0, F.lit(100.0)).otherwise(F.lit(0.0))


def ter(stats: DataFrame, by: list[str]) -> DataFrame:
    return stats.groupBy(*by).agg(*[F.sum(c).alias(c) for c in TER_SUMS]).select(*by, ter_score().alias("ter"))

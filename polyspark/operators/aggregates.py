"""Aggregated metrics and their standard errors. ``by`` names at least one column throughout."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyspark.functions.hashing import hash_hex, hash_int
from polyspark.functions.joins import null_safe_join
from polyspark.functions.ranks import cut_in_order, position_by_hash, running_total
from polyspark.functions.resample import resampled_sums
from polyspark.operators import corpus_metrics as cm

# --- means ----------------------------------------------------------------------------------


def sample_stddev(value: Column) -> Column:
    """Sample standard deviation; 0 for a single value."""
    return F.coalesce(F.stddev_samp(value), F.when(F.count(value) == 1, F.lit(0.0)))


def mean_stderr(value: Column) -> Column:
    return sample_stddev(value) / F.sqrt(F.count(value))


def mean_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("pop_stddev"),
        sample_stddev(v).alias("sample_stddev"),
        mean_stderr(v).alias("mean_stderr"),
        F.count(v).alias("n"),
    )


def median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Element n div 2 of the sorted values of each group.

    Equal values are counted first, so a value that a third of the rows share is one row.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_all"))
    cut = cut_in_order(counts, value, "_cut")
    placed = running_total(cut, by, ["_cut"], [F.col(value)], F.col("_n"), "_before")
    middle = F.floor(F.col("_all") / 2)
    return null_safe_join(placed, totals, by).where((F.col("_before") <= middle) & (middle < F.col("_before") + F.col("_n"))).select(
        *by, F.col(value).cast("double").alias("median")
    )


# --- classification -------------------------------------------------------------------------


def confusion(df: DataFrame, by: list[str], gold: str, pred: str) -> DataFrame:
    """Counts per (gold, pred) cell."""
    return df.groupBy(*by, F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def matthews_from_cells(cells: DataFrame, by: list[str], weight: str = "n") -> DataFrame:
    """Matthews correlation for any number of classes; 0 where it is undefined."""
    w = F.col(weight).cast("double")
    side = lambda name: cells.groupBy(*by, F.col(name).alias("_class")).agg(F.sum(w).alias(f"_{name}"))
    both = null_safe_full(side("gold"), side("pred"), [*by, "_class"])
    g, p = F.coalesce("_gold", F.lit(0.0)), F.coalesce("_pred", F.lit(0.0))
    sides = both.groupBy(*by).agg(
        F.sum(g * p).alias("_gp"), F.sum(g * g).alias("_gg"), F.sum(p * p).alias("_pp"), F.sum(g).alias("_n")
    )
    right = cells.groupBy(*by).agg(F.sum(F.when(F.col("gold") == F.col("pred"), w).otherwise(0.0)).alias("_right"))
    joined = null_safe_join(sides, right, by)
    n = F.col("_n")
    below = F.sqrt((n * n - F.col("_gg")) * (n * n - F.col("_pp")))
    return joined.select(
        *by,
        F.when(below > 0, (F.col("_right") * n - F.col("_gp")) / below).otherwise(F.lit(0.0)).alias("matthews_corrcoef"),
    )


def null_safe_full(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two count tables by stacking them, so null keys meet."""
    a = left.select(*keys, *[c for c in left.columns if c not in keys])
    stacked = a.unionByName(right, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])


def matthews_corrcoef(df: DataFrame, by: list[str], gold: str, pred: str) -> DataFrame:
    return matthews_from_cells(confusion(df, by, gold, pred), by)


def f1_from_sums(tp: Column, fp: Column, fn: Column) -> Column:
    below = 2 * tp + fp + fn
    return F.when(below > 0, 2 * tp / below).otherwise(F.lit(0.0))


def f1_score(df: DataFrame, by: list[str], gold: str, pred: str) -> DataFrame:
    """F1 of the positive class, 1."""
    g, p = F.col(gold) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(
        f1_from_sums(F.count_if(g & p), F.count_if(~g & p), F.count_if(g & ~p)).alias("f1")
    )


# --- grouped answers ------------------------------------------------------------------------


def _all_right(df: DataFrame, groups: list[str], label: str, pred: str) -> DataFrame:
    right = (F.col(label) == 1).eqNullSafe(F.col(pred).cast("boolean"))
    return df.groupBy(*groups).agg(F.bool_and(right).cast("double").alias("_all"))


def acc_all(df: DataFrame, by: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """Share of (paragraph, question) groups whose answers are all right."""
    groups = _all_right(df, [*by, "paragraph", "question"], label, pred)
    return groups.groupBy(*by).agg(F.avg("_all").alias("acc_all"))


def acc_all_stderr(df: DataFrame, by: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """Standard error over groups of the question alone, whatever the paragraph."""
    groups = _all_right(df, [*by, "question"], label, pred)
    return groups.groupBy(*by).agg(mean_stderr(F.col("_all")).alias("acc_all_stderr"))


def parity(df: DataFrame, by: list[str], idx: str = "idx", pred: str = "prediction") -> DataFrame:
    """Share of (even, even + 1) pairs with equal predictions, and its standard error; 0 without pairs."""
    pairs = df.groupBy(*by, F.floor(F.col(idx) / 2).alias("_pair")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.struct(F.col(idx), F.col(pred).alias("p")))["p"].eqNullSafe(
            F.max(F.struct(F.col(idx), F.col(pred).alias("p")))["p"]
        ).cast("double").alias("_same"),
    )
    same = F.when(F.col("_n") == 2, F.col("_same"))
    return pairs.groupBy(*by).agg(
        F.coalesce(F.avg(same), F.lit(0.0)).alias("parity"),
        F.coalesce(mean_stderr(same), F.lit(0.0)).alias("parity_stderr"),
        F.count(same).alias("pairs"),
    )


# --- perplexity -----------------------------------------------------------------------------


def perplexity(value: Column) -> Column:
    return F.exp(-F.avg(value))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value) / F.sum(weight)


def weighted_perplexity(value: Column, weight: Column) -> Column:
    return F.exp(-weighted_mean(value, weight))


def bits_per_byte(value: Column, weight: Column) -> Column:
    return -weighted_mean(value, weight) / F.log(F.lit(2.0))


# --- bootstrap ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Resampled:
    """A metric as weighted sums of per-row columns and a closed form over those sums."""

    sums: dict[str, Column]
    score: Callable[[], Column]


def mean_of(value: str) -> Resampled:
    return Resampled({"_v": F.col(value).cast("double"), "_w": F.lit(1.0)}, lambda: F.try_divide("_v", "_w"))


def perplexity_of(value: str) -> Resampled:
    return Resampled({"_v": F.col(value).cast("double"), "_w": F.lit(1.0)}, lambda: F.exp(-F.try_divide("_v", "_w")))


def f1_of(gold: str, pred: str) -> Resampled:
    g, p = F.col(gold) == 1, F.col(pred) == 1
    as_number = lambda c: c.cast("double")
    return Resampled(
        {"_tp": as_number(g & p), "_fp": as_number(~g & p), "_fn": as_number(g & ~p)},
        lambda: f1_from_sums(F.col("_tp"), F.col("_fp"), F.col("_fn")),
    )


def chrf_of() -> Resampled:
    return Resampled({c: F.col(c).cast("double") for c in cm.CHRF_SUMS}, cm.chrf_score)


def ter_of() -> Resampled:
    return Resampled({c: F.col(c).cast("double") for c in cm.TER_SUMS}, cm.ter_score)


CHUNK = 1000
SMALL_METRIC_ROUNDS = 1000
BOOTSTRAP_ROUNDS = 100_000


def rounds_used(iters: int) -> int:
    """Rounds are made in chunks of at most 1000; what does not fill a chunk is left out."""
    chunk = min(CHUNK, iters)
    return iters // chunk * chunk


def index_draws(df: DataFrame, by: list[str], id_col: str, iters: int, seed: int) -> DataFrame:
    """For every round, how often each row is drawn: ``by``, round, ``id_col``, times.

    As many draws as rows, with replacement. Draws are counted before the join, and
    each task makes its own draws, so nothing but counts is shuffled.
    """
    placed = position_by_hash(
        df.select(*by, id_col).withColumn("_h", hash_hex(seed, F.col(id_col))), by, "_h", [F.col(id_col)], "_i"
    ).drop("_h")
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    rows = null_safe_join(placed, sizes, by)
    drawn = (
        rows.select(*by, "_i", "_n", F.explode(F.sequence(F.lit(0), F.lit(rounds_used(iters) - 1))).alias("round"))
        .withColumn("_i", hash_int(seed, F.col("round"), F.col("_i")) % F.col("_n"))
        .groupBy(*by, "round", "_i")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return null_safe_join(drawn, placed, [*by, "_i"]).drop("_i")


def bootstrap_stderr(
    df: DataFrame,
    by: list[str],
    metric: Resampled,
    id_col: str,
    iters: int,
    seed: int = 0,
    method: str = "poisson",
) -> DataFrame:
    """Standard deviation of the metric over resamples with replacement: ``by``, stderr.

    ``poisson`` lets each row count Poisson(1) times in a round; a task adds its rows up and sends
    one sum a round. ``index`` draws exactly as many rows as there are and shuffles the draws,
    rows times rounds, so it is for small groups.
    """
    names = list(metric.sums)
    if method == "index":
        draws = index_draws(df, by, id_col, iters, seed)
        rows = df.select(*by, id_col, *[c.alias(n) for n, c in metric.sums.items()])
        weighted = null_safe_join(draws, rows, [*by, id_col])
        rounds = weighted.groupBy(*by, "round").agg(*[F.sum(F.col("times") * F.col(n)).alias(n) for n in names])
    elif method == "poisson":
        rounds = resampled_sums(df, by, metric.sums, id_col, rounds_used(iters), seed)
    else:
        raise ValueError(f"unknown method {method!r}")
    return rounds.select(*by, metric.score().alias("_score")).groupBy(*by).agg(
        sample_stddev(F.col("_score")).alias("stderr")
    )


def bootstrap_matthews(
    df: DataFrame, by: list[str], gold: str, pred: str, id_col: str, iters: int, seed: int = 0, method: str = "poisson"
) -> DataFrame:
    """Bootstrap of the Matthews correlation: what is drawn is summed into confusion cells per round."""
    rows = df.select(*by, id_col, F.col(gold).alias("gold"), F.col(pred).alias("pred"))
    if method == "index":
        draws = index_draws(df, by, id_col, iters, seed)
        cells = null_safe_join(draws, rows, [*by, id_col]).groupBy(*by, "round", "gold", "pred").agg(F.sum("times").alias("n"))
    else:
        cells = resampled_sums(rows, [*by, "gold", "pred"], {"n": F.lit(1)}, id_col, rounds_used(iters), seed)
    scores = matthews_from_cells(cells, [*by, "round"])
    return scores.groupBy(*by).agg(sample_stddev(F.col("matthews_corrcoef")).alias("stderr"))


def bootstrap_median(df: DataFrame, by: list[str], value: str, id_col: str, iters: int, seed: int = 0) -> DataFrame:
    """Bootstrap of the median: equal values are merged per round, then the middle draw is found."""
    draws = index_draws(df, by, id_col, iters, seed)
    rows = df.select(*by, id_col, F.col(value).cast("double").alias("_v"))
    counts = null_safe_join(draws, rows, [*by, id_col]).groupBy(*by, "round", "_v").agg(F.sum("times").alias("_n"))
    group = [*by, "round"]
    totals = counts.groupBy(*group).agg(F.sum("_n").alias("_all"))
    placed = running_total(cut_in_order(counts, "_v", "_cut", 16), group, ["_cut"], [F.col("_v")], F.col("_n"), "_before")
    middle = F.floor(F.col("_all") / 2)
    hit = null_safe_join(placed, totals, group).where(
        (F.col("_before") <= middle) & (middle < F.col("_before") + F.col("_n"))
    )
    return hit.groupBy(*by).agg(sample_stddev(F.col("_v")).alias("stderr"))


# Where the standard error of an aggregate comes from; BLEU and weighted ones have none.
STDERR_SOURCE = {
    "median": "bootstrap",
    "matthews_corrcoef": "bootstrap",
    "f1_score": "bootstrap",
    "perplexity": "bootstrap",
    "chrf": "bootstrap",
    "ter": "bootstrap",
    "mean": "mean_stderr",
    "acc_all": "acc_all_stderr",
    "parity": "parity_stderr",
}
FEWER_ROUNDS = {"bleu", "chrf", "ter"}


def bootstrap_rounds(metric: str, iters: int = BOOTSTRAP_ROUNDS) -> int:
    return min(iters, SMALL_METRIC_ROUNDS) if metric in FEWER_ROUNDS else iters


def stderr_for(
    aggregate: str,
    df: DataFrame,
    by: list[str],
    id_col: str,
    columns: dict[str, str],
    iters: int = BOOTSTRAP_ROUNDS,
    seed: int = 0,
    method: str = "poisson",
) -> DataFrame | None:
    """``by``, stderr of an aggregate, or None where it has no standard error.

    ``columns`` names the input columns: value, or gold and pred, or idx and prediction. The
    median, which is no function of sums, is always drawn by index.
    """
    source = STDERR_SOURCE.get(aggregate)
    rounds = bootstrap_rounds(aggregate, iters)
    if source is None:
        return None
    if source == "mean_stderr":
        return df.groupBy(*by).agg(mean_stderr(F.col(columns["value"]).cast("double")).alias("stderr"))
    if source == "acc_all_stderr":
        return acc_all_stderr(df, by, **columns).withColumnRenamed("acc_all_stderr", "stderr")
    if source == "parity_stderr":
        return parity(df, by, **columns).select(*by, F.col("parity_stderr").alias("stderr"))
    if aggregate == "median":
        return bootstrap_median(df, by, columns["value"], id_col, rounds, seed)
    if aggregate == "matthews_corrcoef":
        return bootstrap_matthews(df, by, columns["gold"], columns["pred"], id_col, rounds, seed, method)
    metric = {
        "f1_score": lambda: f1_of(columns["gold"], columns["pred"]),
        "perplexity": lambda: perplexity_of(columns["value"]),
        "chrf": chrf_of,
        "ter": ter_of,
    }[aggregate]()
    return bootstrap_stderr(df, by, metric, id_col, rounds, seed, method)


# --- dispatch -------------------------------------------------------------------------------

# Figures made for each metric tag of a template, their aggregate and direction.
ROUGE_FIGURES = [
    f"{kind}_{f}" for kind in ("rouge1", "rouge2", "rougeL", "rougeLsum") for f in ("precision", "recall", "fmeasure")
]
FIGURES_OF_TAG = {"Accuracy": ["acc", "acc_norm"], "BLEU": ["bleu"], "ROUGE": ROUGE_FIGURES, "SARI": ["sari"]}
AGGREGATE_OF = {
    **{m: "mean" for m in ["acc", "acc_norm", *ROUGE_FIGURES, "sari"]},
    "bleu": "bleu",
    "word_perplexity": "weighted_perplexity",
    "byte_perplexity": "weighted_perplexity",
    "bits_per_byte": "bits_per_byte",
}
LOWER_IS_BETTER = {"word_perplexity", "byte_perplexity", "bits_per_byte"}


def aggregate_results(
    long: DataFrame, by: list[str], extra: dict[str, str] | None = None, rounds: int | None = None, id_col: str = "doc_id", seed: int = 0
) -> DataFrame:
    """One row per group and metric: value, stderr, n, higher_is_better.

    ``long`` has ``by``, metric, value and, for weighted metrics, weight, for BLEU its ``sums``
    (a struct, see ``metric_tags``). All metrics are made in one pass. ``extra`` adds metric names
    and their aggregate. Means have a closed standard error, BLEU and weighted metrics none; that
    of the others is a bootstrap of ``rounds`` rounds over the rows, if rounds are given.
    """
    of = {**AGGREGATE_OF, **(extra or {})}
    weight = F.col("weight") if "weight" in long.columns else F.lit(None).cast("double")
    has_sums = "sums" in long.columns
    sums = long.groupBy(*by, "metric").agg(
        F.avg("value").alias("_mean"),
        mean_stderr(F.col("value")).alias("_se"),
        weighted_mean(F.col("value"), weight).alias("_ratio"),
        F.count(F.coalesce("value", F.col("sums.sys_len").cast("double")) if has_sums else F.col("value")).alias("n"),
        *[F.sum(f"sums.{c}").alias(c) for c in cm.BLEU_SUMS if has_sums],
    )

    def named(kind: str) -> Column:
        return F.col("metric").isin([m for m, a in of.items() if a == kind])

    value = (
        F.when(named("mean"), F.col("_mean"))
        .when(named("perplexity"), F.exp(-F.col("_mean")))
        .when(named("weighted_mean"), F.col("_ratio"))
        .when(named("weighted_perplexity"), F.exp(-F.col("_ratio")))
        .when(named("bits_per_byte"), -F.col("_ratio") / F.log(F.lit(2.0)))
        .when(named("bleu"), cm.bleu_score() if has_sums else F.raise_error(F.lit("bleu needs its sums")).cast("double"))
        .otherwise(F.raise_error(F.concat(F.lit("no aggregate for metric "), F.col("metric"))).cast("double"))
    )
    out = sums.select(
        *by,
        "metric",
        value.alias("value"),
        F.when(named("mean"), F.col("_se")).alias("stderr"),
        "n",
        (~F.col("metric").isin(sorted(LOWER_IS_BETTER))).alias("higher_is_better"),
    )
    drawn = [m for m, a in of.items() if a == "perplexity"]
    if not rounds or not drawn:
        return out
    rows = long.where(F.col("metric").isin(drawn))
    errors = bootstrap_stderr(rows, [*by, "metric"], perplexity_of("value"), id_col, rounds, seed)
    both = null_safe_join(out, errors.withColumnRenamed("stderr", "_drawn"), [*by, "metric"], "left")
    return both.withColumn("stderr", F.coalesce("stderr", "_drawn")).drop("_drawn")

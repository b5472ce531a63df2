"""Mixing sources to target weights: hash-random order, prefix sums of sizes, exact budgets, whole epochs.

DataFrame functions only. The one shuffle of rows is by (source, key bucket), so a source that
holds a third of all documents is spread over ``BUCKETS`` groups; only bucket and source totals,
one small row each, meet in windows of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyspark.session import saved

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BUCKET_HEX = 3  # leading hex digits of the key: 4096 buckets a source
WORD = r"[^\x20\x09-\x0D]+"


def size_in_words(text: str = "text") -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Target words of every source from its total: rows (_source, source_size, target).

    ``sizes`` has one row per source (a table as small as the mix has sources). Sources in order
    of ``_source`` take the weights in turn and share all words; where a share exceeds
    ``max_repeats`` times the source, the source gets just that and the excess goes to the others
    by weight. In order of cap / weight the capped sources come first, so one running sum finds
    the level at which all words are given out.
    """
    whole = Window.partitionBy()
    n = F.row_number().over(Window.orderBy("_source"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((n - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.select("_source", "source_size", w.cast("long").alias("_w"), (F.col("source_size") * max_repeats).alias("_cap"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_source")
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.select(
        "*", (F.sum("source_size").over(whole) - before).alias("_left"), rest.alias("_rest"), F.row_number().over(order).alias("_n")
    )
    wide = "decimal(38,0)"
    free = F.col("_cap").cast(wide) * F.col("_rest").cast("decimal(18,0)") > F.col("_left").cast(wide) * F.col("_w").cast("decimal(18,0)")
    first = F.min(F.when(free, F.struct("_n", "_left", "_rest"))).over(whole)
    share = F.col("_first._left") * F.col("_w") / F.col("_first._rest")
    return levels.withColumn("_first", first).select(
        "_source",
        "source_size",
        F.when(F.col("_n") >= F.col("_first._n"), share).otherwise(F.col("_cap").cast("double")).alias("target"),
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "", carry: Sequence[str] = ()
) -> DataFrame:
    """How many words of each document the mix takes.

    Input columns doc_id, text, source; others are ignored. One row per input row: doc_id, source,
    size, source_size, target, taken, before (words of the source that come earlier in the
    random order), and the columns named in ``carry``. Each source's ``taken`` sums to its target rounded down: all its documents as
    often as the target holds the whole source, then in hash order up to the exact budget, where
    the last document is taken in part.

    The order within a source is md5(id and seed), so reruns agree; equal ids are ordered by size, then by a hash of the text.
    Null text has size 0 and takes nothing; a null source is a source of its own, last in order; a
    null id is hashed as the empty string; a repeated row is a document of its own. Empty in,
    empty out.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed)).cast("binary"))
    source = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))
    carried = [F.col(c).alias(f"_carried{i}") for i, c in enumerate(carry)]
    full = docs.select(
        "doc_id", "source", source.alias("_source"), size_in_words().alias("size"), key.alias("_key"), F.xxhash64(F.col("text").cast("string")).alias("_th"), *carried
    ).withColumn("_bucket", F.substring("_key", 1, BUCKET_HEX))
    rows = saved(full.drop(*[f"_carried{i}" for i in range(len(carried))]))
    buckets = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_size"))
    targets = source_targets(buckets.groupBy("_source").agg(F.sum("_size").alias("source_size")), weights, max_repeats)
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("_source", "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")).join(targets, "_source")
    inside = Window.partitionBy("_source", "_bucket").orderBy("_key", "doc_id", "size", "_th").rowsBetween(Window.unboundedPreceding, -1)
    placed = (full if carried else rows).withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["_source", "_bucket"])
    budget, whole = F.floor("target"), F.greatest("source_size", F.lit(1))
    before = F.col("_start") + F.col("_inside")
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget % whole - before))
    taken = F.expr("cast(floor(target) as bigint) div greatest(source_size, 1L)") * F.col("size") + part
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), before.alias("before"),
        *[F.col(f"_carried{i}").alias(c) for i, c in enumerate(carry)],
    )

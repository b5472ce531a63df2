"""Token counts, packing into fixed-size blocks, holdout, perplexity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyspark.functions.hashing import hash_int
from polyspark.functions.ranks import position_by
from polyspark.operators.prompts import shuffle_limit

# Block size without a setting, and rows packed together.
DEFAULT_BLOCK = 1024
PACK_ROWS = 1000
HOLDOUT_PERCENT = 5


def count_tokens(df: DataFrame, by: list[str], tokens: str = "input_ids") -> DataFrame:
    """Tokens per group, with subtotals and the total (null keys; ``level`` tells them apart)."""
    return df.rollup(*by).agg(
        F.sum(F.size(tokens)).cast("bigint").alias("tokens"),
        F.count(F.lit(1)).alias("rows"),
        F.grouping_id().cast("bigint").alias("level"),
    )


def block_size_for(block_size: int | None, model_max: int) -> int:
    return min(model_max, DEFAULT_BLOCK) if block_size is None else min(block_size, model_max)


def pack_blocks(
    df: DataFrame,
    id_col: str,
    block_size: int,
    columns: tuple[str, ...] = ("input_ids",),
    by: list[str] | None = None,
    rows_per_batch: int = PACK_ROWS,
) -> DataFrame:
    """Blocks of ``block_size`` tokens: ``by``, batch, block, ``columns``, labels.

    Rows are taken in order of the numeric ``id_col``, ``rows_per_batch`` at a time. A
    batch loses its remainder if it fills a block; else it stays as one short block.
    Only ids and lengths are ordered; the tokens move twice, to their offset and to
    their blocks.
    """
    by = by or []
    lengths = df.select(*by, id_col, F.size(columns[0]).cast("bigint").alias("_n"))
    placed = position_by(lengths, by, id_col, "_row").withColumn("batch", F.floor(F.col("_row") / rows_per_batch))
    in_batch = Window.partitionBy(*by, "batch")
    before = in_batch.orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(in_batch)
    spans = (
        placed.withColumns({"_off": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_total": total})
        .withColumn(
            "_end",
            F.when(F.col("_total") >= block_size, F.floor(F.col("_total") / block_size) * block_size).otherwise(
                F.col("_total")
            ),
        )
        .withColumn("_stop", F.least(F.col("_off") + F.col("_n"), F.col("_end")))
        .where(F.col("_stop") > F.col("_off"))
        .select(*by, id_col, "batch", "_off", "_stop")
    )
    size = F.lit(block_size).cast("bigint")
    touched = F.sequence(F.floor(F.col("_off") / size), F.floor((F.col("_stop") - 1) / size))
    pieces = df.select(*by, id_col, *columns).join(spans, [*by, id_col]).withColumn("block", F.explode(touched))
    low = F.greatest(F.col("_off"), F.col("block") * size)
    high = F.least(F.col("_stop"), (F.col("block") + 1) * size)
    start, length = (low - F.col("_off") + 1).cast("int"), (high - low).cast("int")
    cut = pieces.select(*by, "batch", "block", low.alias("_low"), *[F.slice(c, start, length).alias(c) for c in columns])
    blocks = cut.groupBy(*by, "batch", "block").agg(
        F.array_sort(F.collect_list(F.struct("_low", *columns))).alias("_parts")
    )
    # a field of an array of structs is the array of that field
    joined = [F.flatten(F.col("_parts").getField(c)).alias(c) for c in columns]
    return blocks.select(*by, "batch", "block", *joined).withColumn("labels", F.col(columns[0]))


def holdout_split(df: DataFrame, id_col: str, percent: int = HOLDOUT_PERCENT, seed: int = 0) -> DataFrame:
    """Adds ``split``: validation for about ``percent`` of the rows, by a hash of the id."""
    held = hash_int(seed, F.col(id_col)) % 100 < percent
    return df.withColumn("split", F.when(held, F.lit("validation")).otherwise(F.lit("train")))


def limit_samples(df: DataFrame, id_col: str, caps: dict[str, int | None], seed: int = 0) -> DataFrame:
    """At most ``caps[split]`` rows of each split, the first of a seeded shuffle."""
    out = None
    for split, cap in caps.items():
        part = df.where(F.col("split") == split)
        if cap is not None:
            part = shuffle_limit(part, ["split"], id_col, seed, cap).drop("position")
        out = part if out is None else out.unionByName(part)
    return out


def corpus_perplexity(loss: Column) -> Column:
    """exp of the mean loss; too large a mean gives infinity."""
    return F.exp(F.avg(loss))

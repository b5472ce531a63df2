"""Labelled task data: one table for all languages and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyspark.functions.hashing import hash_int

# Order in which a split stands in for a missing one.
EVAL_ORDER = ["test", "validation"]
FEWSHOT_ORDER = ["train", "validation", "test"]


def read_task(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Reads ``root`` laid out as lang=.../split=..., so both prune the files read."""
    return spark.read.format(fmt).load(root)


def choose_split(df: DataFrame, order: list[str], by: list[str]) -> DataFrame:
    """Keeps, per ``by`` group, the rows of the first split of ``order`` that has any.

    Which splits a group has is a small aggregate, so the rows are not shuffled by group.
    """
    rank = F.coalesce(*[F.when(F.col("split") == name, F.lit(i)) for i, name in enumerate(order)])
    ranked = df.withColumn("_rank", rank).where("_rank is not null")
    best = ranked.groupBy(*by).agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, [*by, "_rank"], "left_semi").drop("_rank")


def eval_docs(df: DataFrame, by: list[str]) -> DataFrame:
    """The test split, else validation."""
    return choose_split(df, EVAL_ORDER, by)


def fewshot_docs(df: DataFrame, by: list[str]) -> DataFrame:
    """The train split, else validation, else test."""
    return choose_split(df, FEWSHOT_ORDER, by)


def hash_splits(df: DataFrame, shares: dict[str, int], seed: int, id_col: str = "doc_id") -> DataFrame:
    """Adds ``split`` by a hash of the id; ``shares`` are percentages that sum to 100."""
    if sum(shares.values()) != 100:
        raise ValueError("shares must sum to 100")
    bucket = hash_int(seed, F.col(id_col)) % 100
    split, low = None, 0
    for name, share in shares.items():
        low += share
        split = F.when(bucket < low, F.lit(name)) if split is None else split.when(bucket < low, F.lit(name))
    return df.withColumn("split", split)

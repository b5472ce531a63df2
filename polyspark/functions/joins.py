"""Joins that keep null keys and survive one key holding a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyspark.session import saved

def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null; keeps one copy of the keys."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def skew_safe_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    weight: str,
    spread: list[Column],
    how: str = "inner",
    partitions: int | None = None,
) -> DataFrame:
    """Joins ``facts`` to ``dim`` (one row per key) when some keys are very common.

    ``weight`` is a column of ``dim`` saying how common its key is. A key with more than one
    partition's share of the total weight is hot; it is spread over twice as many salts as it
    has shares, fact rows by a hash of ``spread``, dim rows by repetition. So no partition gets
    much more than its share, and fewer keys than ``partitions`` (default: the shuffle
    partitions) are hot, which bounds the broadcast list. The list is saved, as both sides use it.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins")
    spark = facts.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = F.col(weight) * parts / dim.agg(F.sum(weight).alias("_total")).scalar()
    hot = dim.where(share > 1).groupBy(*keys).agg(F.ceil(2 * F.max(share)).cast("int").alias("_salts"))
    hot = F.broadcast(saved(hot))
    salt = F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int")
    left = facts.join(hot, keys, "left").withColumn("_salt", F.coalesce(salt, F.lit(0)))
    right = dim.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return left.drop("_salts").join(right.drop("_salts"), [*keys, "_salt"], how).drop("_salt")

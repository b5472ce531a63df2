"""Running totals and positions within large groups, without one task per group.

A plain window puts each group into one task. Here the rows of a group are first
cut into buckets that follow the order; windows run inside buckets, and the small
table of bucket totals gives each bucket its start.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyspark.functions.joins import null_safe_join

CUTS = 256


def running_total(
    df: DataFrame,
    keys: list[str],
    buckets: list[str],
    order: list[Column],
    value: Column,
    out: str,
) -> DataFrame:
    """Adds the sum of ``value`` over the rows before this one within ``keys``.

    The order is (buckets, order), so bucket columns must follow the wanted order.
    Several bucket columns are levels: only the values of the first, per key, meet in
    one task.
    """
    columns = df.columns
    df = df.withColumn("_value", value.cast("bigint"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = before.partitionBy(*keys, *buckets).orderBy(*order)
    totals = df.groupBy(*keys, *buckets).agg(F.sum("_value").alias("_total"))
    if len(buckets) == 1:
        across = before.partitionBy(*keys).orderBy(*buckets)
        starts = totals.withColumn("_start", F.coalesce(F.sum("_total").over(across), F.lit(0)))
    else:
        *outer, last = buckets
        starts = running_total(totals, keys, outer, [F.col(last)], F.col("_total"), "_start")
    starts = starts.drop("_total")
    rows = df.withColumn("_within", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    total = (F.col("_start") + F.col("_within")).cast("bigint")
    return null_safe_join(rows, starts, [*keys, *buckets]).select(*columns, total.alias(out))


def cut_in_order(df: DataFrame, column: str, out: str, cuts: int | None = None) -> DataFrame:
    """Adds a bucket number that grows with ``column`` and holds about 1/cuts of the rows.

    There are at least as many buckets as shuffle partitions, unless given. The cut
    points are one row of at most ``cuts`` numbers, fetched once, so that a retried
    task sees the same buckets.
    """
    cuts = cuts or max(CUTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / cuts for i in range(1, cuts)]
    points = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, 10 * cuts)).first()[0] or []
    splits = [float("-inf"), *sorted(set(points)), float("inf")]
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0.0))
    as_double = df.withColumn("_as_double", F.col(column).cast("double"))
    bucketed = Bucketizer(splits=splits, inputCol="_as_double", outputCol=out, handleInvalid="keep").transform(as_double)
    return bucketed.drop("_as_double")


def position_by(df: DataFrame, keys: list[str], order: str, out: str, cuts: int | None = None) -> DataFrame:
    """0-based position of a row within ``keys`` by a numeric, unique ``order`` column."""
    cut = cut_in_order(df, order, "_bucket", cuts)
    return running_total(cut, keys, ["_bucket"], [F.col(order)], F.lit(1), out).drop("_bucket")


def position_by_hash(df: DataFrame, keys: list[str], hex_column: str, tie: list[Column], out: str) -> DataFrame:
    """0-based position within ``keys`` by a hash in hex; equal hashes fall back to ``tie``."""
    prefixed = df.withColumn("_prefix", F.substring(hex_column, 1, 3))
    return running_total(prefixed, keys, ["_prefix"], [F.col(hex_column), *tie], F.lit(1), out).drop("_prefix")

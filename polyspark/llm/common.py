"""What several operators share: streaming over whole groups, components of links, held-out rows."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polyspark.session import discard, saved

GROUP_BYTES = 8 << 20
MAX_ROUNDS = 60


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_rest(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no label may be learned from: crc32 of the id as text, modulo 5, is 0; a null id counts as ''."""
    return crc_rest(doc_id, 5) == 0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps, which it does once their plans are collected as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def by_group(
    df: DataFrame,
    key: str,
    fn: Callable[[pa.Table], Iterable[pa.RecordBatch]],
    schema: str,
    partitions: int | None = None,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Gives ``fn`` the rows of whole groups of the long column ``key``, several groups at a time.

    Unlike one call per group this costs little when groups are small, and a task holds about
    ``group_bytes`` or one group, not its whole partition.
    """
    dealt = df.repartition(partitions or shuffle_partitions(df.sparkSession), key).sortWithinPartitions(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, full = 0, group_bytes
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.nbytes
            if size < full:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from fn(table.slice(0, cut))
                rest = table.slice(cut)
                held = rest.to_batches()
                size, full = rest.nbytes, group_bytes
            else:
                full = 2 * size  # one group larger than the limit: whole, and not copied at each batch
        if held:
            yield from fn(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


class Forest:
    """Union-find over 0..n-1 that keeps the smallest index as the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    def union(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def union_all(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins many pairs by repeated minimum over the pairs, without a loop per pair."""
        while len(a):
            parent = self.parent
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            self.parent = parent
            ra, rb = parent[a], parent[b]
            differ = ra != rb
            if not differ.any():
                return
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))

    def roots(self) -> np.ndarray:
        parent = self.parent
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                self.parent = parent
                return parent
            parent = up


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node that has an edge: rows (node, root), roots included.

    ``edges`` has columns a, b of one orderable type; order, repetition, self-links and nulls do
    not matter (a null end is no link). Rounds of large-star and small-star: every node hangs its
    larger neighbours, then its smaller ones, on the least node of its neighbourhood. A
    neighbourhood is never gathered: its least member is a partially aggregated minimum, joined
    back to the edges.
    """
    u, v = F.greatest("a", "b"), F.least("a", "b")
    now = saved(edges.where("a <> b").select(u.alias("u"), v.alias("v")).distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        ways = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(ways).select("u", F.least("u", "m").alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct())
        least = _least(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(large)
        discard(now)
        now = after
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("links did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


BROADCAST_ROWS = 200_000


def join_small(large: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join whose narrow right side is broadcast only if it has at most ``most`` rows, else shuffled.

    The right side is counted first, so pass a saved table.
    """
    few = small.limit(most + 1).count() <= most
    return large.join(F.broadcast(small) if few else small, on, how)

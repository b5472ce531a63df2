"""Poisson bootstrap by partial sums: every row weighs Poisson(1) in each round, and a task sends one sum a round.

The weight of a row in a round is a hash of both, so retried tasks agree and any engine can make
the same weights (``draw_sql``). Nothing of rows times rounds leaves a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyspark.functions.hashing import hash_int

STEP, FACTOR = 0x9E3779B97F4A7C15, 0x9FB21C651E98DF25  # odd multipliers of the weight's hash
BLOCK = 1 << 20  # weights made at once
SENT = 10_000  # rounds of a batch that leaves a task


def _steps() -> np.ndarray:
    """Distribution function of Poisson(1), in units of 2**-53, up to where it is 1."""
    out, term, total = [], math.exp(-1), 0.0
    for k in range(1, 20):
        total += term
        out.append(min(int(total * 2**53), 2**53))
        term /= k
    return np.array(out, np.uint64)


STEPS = _steps()


def weights(seeds: np.ndarray, first: int, count: int) -> np.ndarray:
    """Weights of rows (columns) in rounds first, first + 1, ... (rows of the result)."""
    rounds = np.arange(first, first + count, dtype=np.uint64) * np.uint64(STEP)
    x = seeds[None, :] + rounds[:, None]
    x ^= x >> np.uint64(32)
    x *= np.uint64(FACTOR)
    x ^= x >> np.uint64(29)
    x >>= np.uint64(11)
    return np.searchsorted(STEPS, x, "right")


def draw_sql(seed: str, round_: str) -> str:
    """The hash behind a weight in SQL with 128-bit integers, for a seed of 60 bits."""
    cut = lambda x: f"(({x}) % {2**64}::uhugeint)::ubigint"
    a = cut(f"({seed})::uhugeint + ({round_})::uhugeint * {STEP}::uhugeint")
    b = cut(f"(xor({a}, {a} >> 32))::uhugeint * {FACTOR}::uhugeint")
    return f"xor({b}, {b} >> 29) >> 11"


def weight_sql(draw: str) -> str:
    """The weight in SQL, from the column with its hash."""
    return " + ".join(f"({draw} >= {step})::int" for step in STEPS.tolist())


def resampled_sums(df: DataFrame, by: list[str], sums: dict[str, Column], id_col: str, rounds: int, seed: int = 0) -> DataFrame:
    """Weighted sums of each round and group: ``by``, round, and the sums. A null counts as 0.

    Groups are sorted inside the partitions they come in, so a task holds the sums of one group;
    it sends one row for each of its groups and rounds.
    """
    names = list(sums)
    values = [F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in sums.items()]
    rows = df.select(*by, hash_int(seed, F.col(id_col)).alias("_seed"), *values).sortWithinPartitions(*by)
    schema = T.StructType([*(rows.schema[k] for k in by), T.StructField("round", T.IntegerType()), *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the first row of the group being summed
        total = np.zeros((rounds, len(names)))

        def flush() -> Iterator[pa.RecordBatch]:
            for a in range(0, rounds, SENT):
                b = min(a + SENT, rounds)
                keys = [held.column(k).take(pa.array(np.zeros(b - a, np.int64))) for k in by]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(np.arange(a, b, dtype=np.int32)), *(pa.array(c) for c in total[a:b].T)], [*by, "round", *names])

        for batch in batches:
            if not len(batch):
                continue
            keys = list(zip(*(batch.column(k).to_pylist() for k in by), strict=True))
            starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            seeds = batch.column("_seed").to_numpy().astype(np.uint64)
            columns = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
            for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
                own = batch.slice(a, 1)
                if held is None or keys[a] != tuple(held.column(k)[0].as_py() for k in by):
                    if held is not None:
                        yield from flush()
                    held, total[:] = own, 0.0
                size = max(1, BLOCK // (b - a))
                for first in range(0, rounds, size):
                    count = min(size, rounds - first)
                    total[first : first + count] += weights(seeds[a:b], first, count).astype(np.float64) @ columns[a:b]
        if held is not None:
            yield from flush()

    partial = rows.mapInArrow(run, schema)
    return partial.groupBy(*by, "round").agg(*[F.sum(n).alias(n) for n in names])

"""Hard negatives by an STR-packed R-tree over labelled integer vectors.

Sort-tile-recursive packing: a bounded sample gives the cut points of the upper levels, first by
label, then by the coordinates that vary most; every row falls into a tile, a tile is one or more
packs, and a pack is packed the same way into leaves by the task that holds it. A box of least and
greatest coordinates bounds the inner products with an anchor coordinate by coordinate. For each
anchor a best-first queue takes the box of the highest bound next, and drops boxes that lie outside
all score windows still open or strictly below the last of the best so far.

Anchors meet packs in blocks, so a task holds a block and a pack, and sends on at most k rows for
each anchor (and window) and pack. Boxes only bound: results are exact, whatever the sample.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyspark.llm.common import by_group, join_small, shuffle_partitions
from polyspark.session import discard, saved

SAMPLE = 8192  # rows that place the upper cut points
SAMPLE_BYTES = 64 << 20
SAMPLE_TILE = 8  # sampled rows a tile has at least
PACK = 4096  # rows of a pack, fewer if vectors are long
PACK_BYTES = 4 << 20
LEAF = 256
FANOUT = 8
BLOCK = 512  # anchors searched together
LIMIT = 1 << 26  # a component beyond this counts as this, so that products of 2,048 components stay in 64 bits
LAST_ID = (1 << 63) - 1

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(vectors: DataFrame, label: Column, anchors: Column) -> DataFrame:
    """Rows that take part: row, vec_id, id (null last), label, anchor, dims, q (floor(256 x) of every component)."""
    whole = F.col("embedding").cast("array<double>")
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floor = F.transform(whole, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), 256 * x))).cast("int"))
    usable = vectors.where(label.isNotNull() & F.col("embedding").isNotNull()).where(finite & (F.size("embedding") > 0))
    return usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        label.cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.size("embedding").alias("dims"),
        floor.alias("q"),
    )


# Packing


def str_order(columns: list[np.ndarray], leaf: int) -> np.ndarray:
    """Order of rows in which each run of ``leaf`` is a tile: sorted by one column, cut into slabs, each sorted by the next."""

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        rows = rows[np.argsort(columns[depth][rows], kind="stable")]
        rest = len(columns) - depth - 1
        pages = -(-len(rows) // leaf)
        if not rest or pages <= 1:
            return [rows]
        slabs = int(np.ceil(pages ** (1 / (rest + 1))))
        size = -(-pages // slabs) * leaf
        return [part for at in range(0, len(rows), size) for part in tile(rows[at : at + size], depth + 1)]

    every = np.arange(len(columns[0]))
    return np.concatenate(tile(every, 0)) if len(every) else every


def widest(q: np.ndarray, most: int = 2) -> list[int]:
    """The coordinates that vary most."""
    return np.argsort(-q.astype(np.float64).var(0), kind="stable")[:most].tolist() if len(q) else list(range(min(most, q.shape[1])))


@dataclass
class Cuts:
    """Upper levels of the tree: slabs of labels, and in each slab cuts by two coordinates."""

    labels: np.ndarray
    axes: list[int]
    first: list[np.ndarray]  # of each slab
    second: list[list[np.ndarray]]  # of each part of each slab
    begin: list[np.ndarray]  # tile number of each part of each slab

    def slab(self, label: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.labels, label, "right")

    def tiles(self, label: np.ndarray, q: np.ndarray) -> np.ndarray:
        slab, out = self.slab(label), np.zeros(len(label), np.int64)
        for s in np.unique(slab).tolist():
            mine = np.flatnonzero(slab == s)
            part = np.searchsorted(self.first[s], q[mine, self.axes[0]], "right")
            for p in np.unique(part).tolist():
                of = mine[part == p]
                out[of] = self.begin[s][p] + np.searchsorted(self.second[s][p], q[of, self.axes[-1]], "right")
        return out


def _quantiles(values: np.ndarray, parts: int) -> np.ndarray:
    """Cut points for about ``parts`` equal parts; equal values are never cut."""
    if not len(values) or parts < 2:
        return values[:0]
    ordered = np.sort(values)
    return np.unique(ordered[(np.arange(1, parts) * len(ordered)) // parts])


def plan_cuts(label: np.ndarray, q: np.ndarray, rows: int, pack: int) -> Cuts:
    """Cuts for ``rows`` rows of which ``label`` and ``q`` are a sample."""
    tiles = max(1, min(-(-rows // pack), len(label) // SAMPLE_TILE))
    axes = widest(q)
    values = np.unique(label)
    labels = values[1:] if len(values) <= 64 else _quantiles(label, 64)
    slab = np.searchsorted(labels, label, "right")
    cuts = Cuts(labels, axes, [], [], [])
    at = 0
    for s in range(len(labels) + 1):
        mine = q[slab == s]
        own = max(1, round(tiles * len(mine) / max(len(label), 1)))
        parts = int(np.ceil(own**0.5))
        first = _quantiles(mine[:, axes[0]], parts)
        part = np.searchsorted(first, mine[:, axes[0]], "right")
        second = [_quantiles(mine[part == p][:, axes[-1]], -(-own // parts)) for p in range(len(first) + 1)]
        ends = at + np.cumsum([len(x) + 1 for x in second])
        cuts.first.append(first)
        cuts.second.append(second)
        cuts.begin.append(np.concatenate([[at], ends[:-1]]))
        at = int(ends[-1])
    return cuts


# Searching


class Tree:
    """A pack's rows in STR order, and boxes a level: leaves first, the root last."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = str_order([labels, *(q[:, c] for c in widest(q))], LEAF)
        self.q, self.ids, self.labels, self.rows = q[order].astype(np.int64), ids[order], labels[order], rows[order]
        at = np.arange(0, len(order), LEAF)
        low, high = np.minimum.reduceat(self.q, at), np.maximum.reduceat(self.q, at)
        least, most = np.minimum.reduceat(self.labels, at), np.maximum.reduceat(self.labels, at)
        lows, highs, leasts, mosts, self.children = [low], [high], [least], [most], [None] * len(at)
        below = 0
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            self.children += [range(below + a, below + min(a + FANOUT, len(low))) for a in at.tolist()]
            below += len(low)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            lows.append(low)
            highs.append(high)
            leasts.append(least)
            mosts.append(most)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.least, self.most = np.concatenate(leasts), np.concatenate(mosts)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of every anchor with any vector of every box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def best(
        self, anchor: np.ndarray, skip: list[bool], bounds: tuple[list[int], list[int]], windows: list[tuple[int, int]], k: int, own: int, label: int, same: bool
    ) -> list[list[tuple[int, int, int]]]:
        """For each window (least, greatest score) the first k rows in it: (-score, id, row), best first.

        Only rows of the anchor's label, its own left out, if ``same``, else only rows of other
        labels. ``skip`` marks boxes without any.
        """
        found: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        floors = [low for low, _ in windows]
        ceiling = max((high for _, high in windows), default=0)
        lows, highs = bounds
        spans = list(range(len(windows)))
        root = len(self.children) - 1
        queue = [(-min(highs[root], ceiling), root)]
        while queue:
            _, node = heapq.heappop(queue)
            low, high = lows[node], highs[node]
            if skip[node] or not any(high >= floors[w] and low <= windows[w][1] and floors[w] <= windows[w][1] for w in spans):
                continue
            below = self.children[node]
            if below is not None:
                for child in below:
                    heapq.heappush(queue, (-min(highs[child], ceiling), child))
                continue
            part = slice(node * LEAF, (node + 1) * LEAF)
            score = self.q[part] @ anchor
            right = (self.labels[part] == label) & (self.rows[part] != own) if same else self.labels[part] != label
            for w, (_, most) in enumerate(windows):
                hit = np.flatnonzero(right & (score >= floors[w]) & (score <= most))
                if not len(hit):
                    continue
                if len(hit) > k:
                    hit = hit[np.lexsort((self.rows[part][hit], self.ids[part][hit], -score[hit]))[:k]]
                own_rows = zip((-score[hit]).tolist(), self.ids[part][hit].tolist(), self.rows[part][hit].tolist(), strict=True)
                found[w] = sorted([*found[w], *own_rows])[:k]
                if len(found[w]) == k:
                    floors[w] = max(floors[w], -found[w][-1][0])
        return found


# The distributed search

GROUP = "n long, q binary, ids binary, labels binary, rows binary, low binary, high binary"


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _grouped(rows: DataFrame, key: str) -> DataFrame:
    """One row per group of ``key`` with its rows as arrays; ``rows`` has key, dims, slab, row, id, label, q and may have low and high."""
    windows = [c for c in ("low", "high") if c in rows.columns]

    def run(table: pa.Table) -> Iterable[pa.RecordBatch]:
        keys = table.column(key).to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(keys)], strict=True):
            part = table.slice(a, b - a)
            dims = part.column("dims")[0].as_py()
            blobs = [_matrix(part.column("q"), dims).astype(np.int32).tobytes()]
            blobs += [part.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label", "row")]
            for c in ("low", "high"):
                blobs.append(part.column(c).combine_chunks().flatten().to_numpy().astype(np.int64).tobytes() if c in windows else b"")
            values = [int(keys[a]), dims, int(part.column("slab")[0].as_py()), b - a, *blobs]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6], strict=True)], [key, "dims", "slab", "n", "q", "ids", "labels", "rows", "low", "high"])

    chosen = rows.select(key, "dims", "slab", "row", "id", "label", "q", *windows)
    return by_group(chosen, key, run, f"{key} long, dims int, slab long, {GROUP}")


def _unpack(batch: pa.RecordBatch, i: int, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    dims = batch.column("dims")[i].as_py()
    get = lambda c, kind: np.frombuffer(batch.column(prefix + c)[i].as_buffer(), kind)
    return get("q", np.int32).reshape(-1, dims), get("ids", np.int64), get("labels", np.int64), get("rows", np.int64)


def _search(blocks: DataFrame, packs: DataFrame, first: Column, last: Column, k: int, same: bool) -> DataFrame:
    """Best rows of each pack from ``first`` to ``last`` for the anchors of each block: anchor (its row), w, score, id, row.

    A block is sent to every pack it meets; the pack's key spreads them, so no task holds more
    than one block and one pack at a time.
    """
    mine = blocks.select("dims", *[F.col(c).alias(f"b_{c}") for c in ("q", "ids", "labels", "rows", "low", "high")], F.explode(F.sequence(first, last)).alias("pack"))
    theirs = packs.select("pack", F.col("dims").alias("_dims"), *[F.col(c).alias(f"p_{c}") for c in ("q", "ids", "labels", "rows")])
    met = mine.repartition(shuffle_partitions(blocks.sparkSession), "pack").join(theirs.hint("merge"), "pack").where("dims = _dims").drop("_dims")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            for i in range(len(batch)):
                if held != batch.column("pack")[i].as_py():
                    held, tree = batch.column("pack")[i].as_py(), Tree(*_unpack(batch, i, "p_"))
                q, _, labels, rows = _unpack(batch, i, "b_")
                anchors = q.astype(np.int64)
                if same:
                    low, high = np.full((len(q), 1), -LAST_ID), np.full((len(q), 1), LAST_ID)
                else:
                    low, high = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64).reshape(len(q), -1) for c in ("b_low", "b_high"))
                lows, highs = tree.bounds(anchors)
                out: list[tuple[int, int, int, int, int]] = []
                for a in range(len(q)):
                    label = int(labels[a])
                    skip = ((tree.least > label) | (tree.most < label) if same else (tree.least == label) & (tree.most == label)).tolist()
                    windows = list(zip(low[a].tolist(), high[a].tolist(), strict=True))
                    best = tree.best(anchors[a], skip, (lows[a].tolist(), highs[a].tolist()), windows, k, int(rows[a]), label, same)
                    out += [(int(rows[a]), w, -score, vec, row) for w, each in enumerate(best) for score, vec, row in each]
                columns = np.array(out, np.int64).reshape(-1, 5).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "w", "score", "id", "row"])

    return met.mapInArrow(run, "anchor long, w long, score long, id long, row long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "w").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _numbered(counts: list, size: dict[int, int], key: str) -> tuple[list[tuple], int]:
    """Numbers for groups of at most about ``size`` rows: (dims, key, first number, groups); and how many there are."""
    out, at = [], 0
    for r in sorted(counts, key=lambda r: (r["dims"], r["slab"], r[key])):
        n = -(-r["n"] // size[r["dims"]])
        out.append((r["dims"], r[key], at, n))
        at += n
    return out, at


def mine(
    vectors: DataFrame, label: Column, anchors: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95
) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Input columns vec_id, embedding and what ``label`` and ``anchors`` read; others are ignored.
    ``anchors`` marks the anchor rows (null: none). Scores are inner products of floor(256 x).
    Positives are the first ``positives`` other rows of an anchor's label; negatives the first
    ``negatives`` rows of other labels with ``least`` percent of the positive's score <= score <=
    ``most`` percent of it, so a negative positive score has none. Higher scores come first, then
    smaller ids.

    Rows with a null label, a null or empty vector or a null or non-finite component take no part;
    only vectors of one length are compared. A null id is larger than any other and no
    anchor by itself; repeated rows are rows of their own, so each can be a positive of the other,
    and as anchors they give repeated rows. A component beyond 2**18 counts as 2**18. Empty in,
    empty out.
    """
    spark = vectors.sparkSession
    rows = saved(quantised(vectors, label, anchors))
    sizes = {r["dims"]: r["n"] for r in rows.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], RESULT)
    pack = {d: max(64, min(PACK, PACK_BYTES // (4 * d))) for d in sizes}
    share = min(SAMPLE, SAMPLE_BYTES // (8 * max(sizes))) / sum(sizes.values())
    draw = (F.xxhash64("row", F.lit("sample")) % 1_000_000_007 + 1_000_000_007) / 2_000_000_014.0
    sample = rows.where(draw < share).select("dims", "label", "q").toPandas().sort_values("label", kind="stable")
    cuts: dict[int, Cuts] = {}
    for dims, n in sizes.items():
        own = sample[sample["dims"] == dims]
        q = np.stack(own["q"].to_numpy()) if len(own) else np.zeros((0, dims), np.int64)
        cuts[dims] = plan_cuts(own["label"].to_numpy(np.int64), q, n, pack[dims])
    sent = spark.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, label = batch.column("dims").to_numpy(), batch.column("label").to_numpy()
            slab, tile = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for d in np.unique(dims).tolist():
                of = np.flatnonzero(dims == d)
                q = _matrix(batch.column("q").take(pa.array(of)), d)
                slab[of], tile[of] = sent.value[d].slab(label[of]), sent.value[d].tiles(label[of], q)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slab), pa.array(tile)], [*batch.schema.names, "slab", "tile"])

    placed = saved(rows.mapInArrow(place, "row long, vec_id long, id long, label long, anchor boolean, dims int, q array<int>, slab long, tile long"))
    discard(rows)
    spread = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    counts = placed.groupBy("dims", "slab", "tile").agg(F.count("*").alias("n")).collect()
    packed, _ = _numbered(counts, pack, "tile")
    table = spark.createDataFrame(packed, "dims int, tile long, first long, times long")
    with_pack = placed.join(F.broadcast(table), ["dims", "tile"]).withColumn("pack", F.col("first") + spread("times"))
    packs = saved(_grouped(with_pack, "pack"))
    of_slab: dict[tuple[int, int], list[int]] = {}
    slab_of = {(r["dims"], r["tile"]): r["slab"] for r in counts}
    for dims, tile, first, times in packed:
        low, high = of_slab.get((dims, slab_of[dims, tile]), (first, first))
        of_slab[dims, slab_of[dims, tile]] = [min(low, first), max(high, first + times - 1)]
    of_dims = {d: (min(v[0] for k, v in of_slab.items() if k[0] == d), max(v[1] for k, v in of_slab.items() if k[0] == d)) for d in sizes}
    groups = placed.where("anchor").groupBy("dims", "slab").agg(F.count("*").alias("n")).collect()
    blocked, _ = _numbered(groups, {d: BLOCK for d in sizes}, "slab")
    meets = [(d, s, first, times, *of_slab[d, s], *of_dims[d]) for d, s, first, times in blocked]
    table = F.broadcast(spark.createDataFrame(meets, "dims int, slab long, first long, times long, lo long, hi long, lo_all long, hi_all long"))
    asked = placed.where("anchor").join(table, ["dims", "slab"]).withColumn("block", F.col("first") + spread("times"))
    blocks = saved(_grouped(asked, "block")).join(table, ["dims", "slab"])
    found = saved(_first(_search(blocks, packs, F.col("lo"), F.col("hi"), positives, same=True), positives))
    low, high = F.expr(f"(score * {least}L + 99) div 100"), F.expr(f"(score * {most}L) div 100")
    windows = found.where("score >= 0").select("anchor", "rank", low.alias("_low"), high.alias("_high"))
    # a window for every positive, in order; an anchor with fewer has empty ones
    ends = [F.coalesce(F.max(F.when(F.col("rank") == i + 1, F.col(c))), F.lit(none)) for c, none in (("_low", 1), ("_high", 0)) for i in range(positives)]
    wide = windows.groupBy("anchor").agg(F.array(*ends[:positives]).alias("low"), F.array(*ends[positives:]).alias("high"))
    again = join_small(asked.withColumn("anchor", F.col("row")), saved(wide), "anchor")
    second = saved(_grouped(again, "block")).join(table, ["dims", "slab"])
    others = _first(_search(second, packs, F.col("lo_all"), F.col("hi_all"), negatives, same=False), negatives)
    names = placed.where("anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    null = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    pairs = found.select("anchor", (F.col("rank") - 1).cast("long").alias("w"), null("id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = others.select("anchor", "w", "rank", null("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = chosen.join(pairs, ["anchor", "w"]).join(names, "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


__all__ = ["Tree", "mine", "plan_cuts", "quantised", "str_order"]

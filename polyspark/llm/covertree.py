"""Embedding near-duplicates by dual traversal of cover trees: all pairs of one label with cosine >= 0.93, exactly.

On unit vectors a cosine bound is a bound on distance, so a pair of tree nodes is skipped when
their centres lie farther apart than both covering radii and that bound together.

1. Equal vectors of a label fold into one class with a count.
2. A label with more than ``BLOCK`` classes is cut into cells around pivots, the first level
   of a cover tree of a bounded sample. A class visits a foreign cell only if its distance to the pivot is within
   that cell's covering radius plus the bound. Cells of more than ``BLOCK`` classes are cut into
   blocks. A pair of blocks is one group of rows, whatever the label's share of the table.
3. A group builds a cover tree per block (nested levels, radii halving) and traverses the two
   trees together. It returns link counts and a spanning forest, never the pairs.

In many dimensions spread-out vectors leave little to prune, and the work is that of all pairs of
a label in blocks; dense clusters and copies are what the bounds and the folding skip.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.llm.common import Forest, by_group, components, join_small
from polyspark.session import saved

COSINE = 0.93
BOUND = float(np.sqrt(2 - 2 * COSINE))
SLACK = 1e-6  # distances of unit vectors are right to about 1e-8
BLOCK = 1024
PIVOTS = 64
SAMPLE = 1024
ASSIGNED = 8192  # rows that share one copy of the pivots


def distances(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


def net(points: np.ndarray, radius: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy net from point 0 on: centres more than ``radius`` apart, each point's nearest centre and its distance.

    With ``most``, centres are taken farthest first and at most so many.
    """
    nearest = np.zeros(len(points), np.int64)
    gap = distances(points @ points[0])
    centres = [0]
    while most is None or len(centres) < most:
        if most is None:
            far = np.flatnonzero(gap > radius)
            if not len(far):
                break
            at = int(far[0])
        else:
            at = int(np.argmax(gap))
            if gap[at] <= radius:
                break
        d = distances(points @ points[at])
        d[at] = 0
        closer = d < gap
        nearest[closer], gap[closer] = len(centres), d[closer]
        nearest[at], gap[at] = len(centres), 0
        centres.append(at)
    return np.array(centres), nearest, gap


@dataclass
class Node:
    """A ball: its centre, the distance of its farthest member, its members, and children of half the radius."""

    centre: int
    radius: float
    members: np.ndarray
    level: float
    children: list[Node] = field(default_factory=list)
    centres: np.ndarray | None = None
    radii: np.ndarray | None = None


LEAF = 32


def tree(points: np.ndarray) -> Node:
    """Cover tree of unit vectors: the children of a node are a net of its members at half its radius, its centre first."""
    gap = distances(points @ points[0])
    root = Node(0, float(gap.max()), np.arange(len(points)), float(gap.max()))
    open_ = [root]
    while open_:
        node = open_.pop()
        if len(node.members) <= LEAF or node.radius <= SLACK:
            continue
        own = node.members[node.members != node.centre]
        members = np.concatenate([[node.centre], own])
        level = node.level / 2
        centres, nearest, gap = net(points[members], level)
        order = np.argsort(nearest, kind="stable")
        for k, part in enumerate(np.split(order, np.cumsum(np.bincount(nearest, minlength=len(centres)))[:-1])):
            child = Node(int(members[centres[k]]), float(gap[part].max()), members[part], level)
            node.children.append(child)
            open_.append(child)
        node.centres = np.array([c.centre for c in node.children])
        node.radii = np.array([c.radius for c in node.children])
    return root


def _parts(node: Node) -> tuple[list[Node] | None, np.ndarray, np.ndarray]:
    """Children with centres and radii; the members of a leaf stand for balls of radius 0."""
    if node.children:
        return node.children, node.centres, node.radii
    return None, node.members, np.zeros(len(node.members))


def traverse(a: Node, x: np.ndarray, b: Node, y: np.ndarray, cosine: float = COSINE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of index pairs (i, j) with x[i] . y[j] >= cosine, each once; for one tree with itself, both orders and i = j too."""
    bound = float(np.sqrt(2 - 2 * cosine)) + SLACK
    open_ = [(a, b)]
    while open_:
        p, q = open_.pop()
        kids_p, at_p, radius_p = _parts(p)
        kids_q, at_q, radius_q = _parts(q)
        dots = x[at_p] @ y[at_q].T
        if kids_p is None and kids_q is None:
            i, j = np.nonzero(dots >= cosine)
            if len(i):
                yield at_p[i], at_q[j]
            continue
        near = distances(dots) <= radius_p[:, None] + radius_q[None, :] + bound
        single_p = np.ones(len(at_p), bool) if kids_p is None else np.array([len(k.members) == 1 for k in kids_p])
        single_q = np.ones(len(at_q), bool) if kids_q is None else np.array([len(k.members) == 1 for k in kids_q])
        ends = single_p[:, None] & single_q[None, :]
        i, j = np.nonzero((dots >= cosine) & ends)
        if len(i):
            yield at_p[i], at_q[j]
        for i, j in zip(*np.nonzero(near & ~ends), strict=True):
            left = kids_p[i] if kids_p is not None else Node(int(at_p[i]), 0.0, at_p[i : i + 1], 0.0)
            right = kids_q[j] if kids_q is not None else Node(int(at_q[j]), 0.0, at_q[j : j + 1], 0.0)
            open_.append((left, right))


def _groups(keys: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def _points(table: pa.Table, a: int, b: int) -> np.ndarray:
    part = table.column("v").slice(a, b - a).combine_chunks()
    return part.flatten().to_numpy().reshape(b - a, -1)


def _link(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links of whole groups (pairs of blocks): a class, the root of its tree of links, the rows it links with."""
    keys, block = table.column("key").to_numpy(), table.column("block").to_numpy()
    size = table.column("size").to_numpy()
    forest, links = Forest(len(keys)), np.zeros(len(keys), np.int64)
    for a, b in _groups(keys):
        if b - a < 2:
            continue
        points, mine = _points(table, a, b), block[a:b]
        first = np.flatnonzero(mine == mine[0])
        other = np.flatnonzero(mine != mine[0])
        # both orders of a pair come when a block meets itself, which counts each side once
        sides = [(first, other)] if len(other) else [(first, first)]
        if table.column("alone")[a].as_py() is False and not len(other):
            continue  # the other block sent nothing
        for p, q in sides:
            x, y = points[p], points[q]
            left = tree(x)
            right = left if p is q else tree(y)
            for i, j in traverse(left, x, right, y):
                i, j = a + p[i], a + q[j]
                if p is q:
                    differ = i != j
                    i, j = i[differ], j[differ]
                np.add.at(links, i, size[j])
                if p is not q:
                    np.add.at(links, j, size[i])
                forest.union_all(i, j)
    roots = forest.roots()
    at = np.flatnonzero(links)
    names = table.column("name").combine_chunks()
    yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), names.take(pa.array(roots[at])), pa.array(links[at])], ["a", "b", "links"])


def _choose(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pivots of whole shards from their samples, farthest first."""
    keys = table.column("key").to_numpy()
    for a, b in _groups(keys):
        points = _points(table, a, b)
        most = int(table.column("pivots")[a].as_py())
        centres, _, _ = net(points, 0.0, most)
        values = pa.array(points[centres].tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(centres), keys[a])), values], ["shard", "v"])


def _assign(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Nearest pivot of each class, and its distances to all pivots, for groups that hold both."""
    keys, pivot = table.column("key").to_numpy(), table.column("is_pivot").to_numpy()
    for a, b in _groups(keys):
        points, is_pivot = _points(table, a, b), pivot[a:b].astype(bool)
        rows = a + np.flatnonzero(~is_pivot)
        if not len(rows):
            continue
        centres = points[is_pivot]
        centres = centres[np.lexsort(centres.T[::-1])]  # one numbering in all groups of a shard
        gaps = distances(points[~is_pivot] @ centres.T)
        part = table.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays(
            [
                *(part.column(c).combine_chunks() for c in ("shard", "name", "size", "v")),
                pa.array(gaps.argmin(1)),
                pa.array(gaps.tolist(), pa.list_(pa.float64())),
            ],
            ["shard", "name", "size", "v", "cell", "gaps"],
        )


def _cells(classes: DataFrame) -> DataFrame:
    """Classes of large shards with their cells: rows (key, name, size, v, block, alone), one per pair of blocks."""
    sampled = classes.where((F.xxhash64("name") % 1_000_000_007 + 1_000_000_007) / 2_000_000_014.0 < SAMPLE / F.col("n"))
    pivots = F.least(F.lit(PIVOTS), F.ceil(F.col("n") / BLOCK)).cast("long")
    chosen = by_group(sampled.select(F.col("shard").alias("key"), "v", pivots.alias("pivots")), "key", _choose, "shard long, v array<double>")
    salts = F.ceil(F.col("n") / ASSIGNED)
    shards = saved(classes.groupBy("shard").agg(F.max(salts).alias("salts")))
    copies = join_small(chosen, shards, "shard").select(
        "shard", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    )
    rows = classes.select("shard", "name", "size", "v", F.pmod(F.xxhash64("name"), salts).alias("salt"), F.lit(0).alias("is_pivot"))
    both = rows.unionByName(copies.withColumn("is_pivot", F.lit(1)), allowMissingColumns=True)
    placed = saved(
        by_group(
            both.select(F.xxhash64("shard", "salt").alias("key"), "shard", "name", "size", "v", "is_pivot"),
            "key",
            _assign,
            "shard long, name string, size long, v array<double>, cell long, gaps array<double>",
        )
    )
    stats = placed.groupBy("shard", "cell").agg(F.max(F.element_at("gaps", (F.col("cell") + 1).cast("int"))).alias("radius"), F.count("*").alias("n"))
    cells = saved(stats.groupBy("shard").agg(F.collect_list(F.struct("cell", "radius", F.ceil(F.col("n") / BLOCK).alias("blocks"))).alias("cells")))
    near = F.filter("cells", lambda c: F.element_at("gaps", (c["cell"] + 1).cast("int")) <= c["radius"] + BOUND + SLACK)
    blocks = F.filter("cells", lambda c: c["cell"] == F.col("cell"))[0]["blocks"]
    home = join_small(placed, cells, "shard").select(
        "shard", "name", "size", "v", (F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("name"), blocks)).alias("block"), F.explode(near).alias("to")
    )
    met = home.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("to.blocks") - 1)).alias("at"))
    other = F.col("to.cell") * (1 << 32) + F.col("at")
    return met.select(
        F.xxhash64("shard", F.least("block", other), F.greatest("block", other)).alias("key"), "name", "size", "v", "block", (F.col("block") == other).alias("alone")
    )


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Links of every vector: vec_id, n_links, component_id, kept.

    Reads vec_id, embedding, label. Vectors of equal label and length with cosine >= 0.93 in double
    precision are linked. A null label, and a vector that is null, empty, zero or holds null or
    non-finite numbers, links with nothing. Equal vectors of a label are linked, so repeated rows link with each other. A null vec_id
    is larger than any other and kept only if its component has no other id. Empty in, empty out.
    """
    raw = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    limit = F.lit(float("inf"))
    fine = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists("raw", lambda x: x != 0)
    good = F.coalesce(F.col("label").isNotNull() & fine, F.lit(False))
    name = F.concat(F.hex(F.xxhash64("label", "raw")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "raw", "label")))
    rows = vectors.select("vec_id", "label", raw.alias("raw")).withColumn("name", F.when(good, name))
    named = saved(rows)
    folded = named.where(F.col("name").isNotNull()).groupBy("name", F.xxhash64("label", F.size("raw")).alias("shard")).agg(
        F.first("raw").alias("raw"), F.min("vec_id").alias("least"), F.count("*").alias("size")
    )
    # scaled by the largest number first, so that squares neither overflow nor vanish
    top = F.array_max(F.transform("raw", F.abs))
    scaled = F.transform("raw", lambda x: x / F.col("top"))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    folded = folded.withColumn("top", top).withColumn("scaled", scaled).withColumn("norm", norm)
    classes = saved(folded.select("name", "shard", "least", "size", F.transform("scaled", lambda x: x / F.col("norm")).alias("v")))
    counts = saved(classes.groupBy("shard").agg(F.count("*").alias("n")))
    sized = join_small(classes, counts, "shard")
    small = sized.where(F.col("n") <= BLOCK).select(
        F.col("shard").alias("key"), "name", "size", "v", F.lit(0).cast("long").alias("block"), F.lit(True).alias("alone")
    )
    groups = small.unionByName(_cells(sized.where(F.col("n") > BLOCK)))
    linked = saved(by_group(groups, "key", _link, "a string, b string, links long"))
    totals = linked.groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(linked.select("a", "b"))
    placed = classes.join(roots, F.col("name") == F.col("node"), "left").select("name", "least", "size", F.coalesce("root", "name").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component"))
    told = placed.join(smallest, "root").join(totals, F.col("name") == F.col("a"), "left")
    told = saved(told.select("name", "component", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    component = F.when(F.col("name").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return named.join(told, "name", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

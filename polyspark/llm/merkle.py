"""Merkle manifest of a dataset: a tree a source, a tree over the sources, and a proof for every row.

Nodes are numbered by position, so a tree is a table of (tree, position, digest) a level. Of these
only every second level is stored: checkpoints. Between two of them lie aligned subtrees of
``RUN ** STEP`` stored nodes. A proof goes up through the checkpoints; in each subtree it passes, the
missing level is computed again from the stored nodes, its siblings are read off, and it is
dropped. Proofs never travel: those of a subtree's 256 leaves share their upper part, which is one
row, and are put together and hashed where the leaves are.

All of it is DataFrame work: a range sort by (tree, order) gives positions, and every level is one
grouping of at most 256 digests a row, whatever the size of a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyspark.llm.common import join_small, shuffle_partitions
from polyspark.session import discard, saved

RUN = 16  # nodes that become one
STEP = 2  # levels between checkpoints
SUBTREE = RUN**STEP
SIBLINGS = "array<struct<left:string,right:string>>"


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case; all other characters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf_digest(text: str | Column = "text") -> Column:
    """Digest of a row of documents."""
    text = F.col(text) if isinstance(text, str) else text
    return sha(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text))


def number(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds ``pos``, the 0-based position of a row in its tree by ``order``, and ``n``, the rows of the tree.

    The rows are range-sorted by (tree, order), which splits a large tree over many partitions;
    rows are counted inside a partition, and partition totals, a row for each tree and each
    partition, give the starts. Rows must be told apart by ``order``.
    """
    parts = shuffle_partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(parts, tree, *order).withColumn("_part", F.spark_partition_id())
    kept = saved(dealt.sortWithinPartitions(tree, *order))
    totals = kept.groupBy(tree, "_part").agg(F.count("*").alias("_n"))
    of_tree = Window.partitionBy(tree)
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(totals.select(tree, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(of_tree).alias("n")))
    inside = F.row_number().over(Window.partitionBy(tree, "_part").orderBy(*order)) - 1
    placed = join_small(kept.withColumn("_in", inside), starts, [tree, "_part"])
    out = saved(placed.withColumn("pos", F.col("_start") + F.col("_in")).drop("_start", "_in", "_part"))
    discard(starts)
    discard(kept)
    return out


def _height(n: Column) -> Column:
    """Levels above the leaves: the least h with RUN ** h >= n."""
    return sum((F.when(n > F.lit(RUN**h), 1).otherwise(0) for h in range(15)), F.lit(0))


def _subtrees(nodes: DataFrame, tree: str, extra: list[str]) -> DataFrame:
    """One row per aligned subtree of stored nodes: tree, block, height left, the nodes in order and the level between.

    ``h`` are the digests of the stored nodes, ``mid`` those of the level above, computed here and
    written nowhere.
    """
    struct = F.struct("pos", "digest", *extra)
    grouped = nodes.groupBy(tree, "n", "left", F.expr(f"pos div {SUBTREE}").alias("block")).agg(F.array_sort(F.collect_list(struct)).alias("nodes"))
    h = F.transform("nodes", lambda x: x["digest"])
    runs = F.transform(F.sequence(F.lit(0), F.expr(f"cast((size(h) - 1) div {RUN} as int)")), lambda r: F.sha2(F.array_join(F.slice(F.col("h"), r * RUN + 1, RUN), "").cast("binary"), 256))
    return grouped.withColumn("h", h).withColumn("mid", F.when(F.col("left") > 0, runs).otherwise(F.array().cast("array<string>")))


def _root_of(subtree: DataFrame) -> Column:
    """Digest of a subtree: of its middle level, or the middle node or the only leaf where the tree ends there."""
    return F.when(F.col("left") >= STEP, F.sha2(F.array_join("mid", "").cast("binary"), 256)).when(F.col("left") == 1, F.col("mid")[0]).otherwise(F.col("h")[0])


def checkpoints(leaves: DataFrame, tree: str) -> list[DataFrame]:
    """Stored levels of every tree, from the leaves up: tables of (tree, n, left, pos, digest).

    ``leaves`` has tree, n, pos and digest. ``left`` counts the levels still above a node. The last
    table holds the roots.
    """
    levels = [leaves.withColumn("left", _height(F.col("n")))]
    most = levels[0].agg(F.max("left")).first()[0]
    for _ in range(math.ceil((most or 0) / STEP)):
        below = levels[-1]
        blocks = _subtrees(below.select(tree, "n", "left", "pos", "digest"), tree, [])
        up = blocks.select(tree, "n", F.greatest(F.col("left") - STEP, F.lit(0)).alias("left"), F.col("block").alias("pos"), _root_of(blocks).alias("digest"))
        levels.append(saved(up))
    return levels


def _beside(array: str, i: str, keep: str) -> str:
    """SQL of the siblings of the ``i``-th of an array: those of its run before and after it, joined."""
    start = f"({i} div {RUN}) * {RUN}"
    left = f"array_join(slice({array}, cast({start} + 1 as int), cast({i} % {RUN} as int)), '')"
    right = f"array_join(slice({array}, cast({i} + 2 as int), cast({RUN} - 1 - {i} % {RUN} as int)), '')"
    return f"case when {keep} then named_struct('left', {left}, 'right', {right}) end"


def _paths(i: str) -> str:
    """SQL of the siblings of node ``i`` of a subtree, at the stored level and the one above; fewer where the tree ends."""
    return f"filter(array({_beside('h', i, '`left` >= 1')}, {_beside('mid', f'({i} div {RUN})', f'`left` >= {STEP}')}), s -> s is not null)"


def extract(levels: list[DataFrame], tree: str, top: DataFrame, extra: list[str]) -> DataFrame:
    """A row for every leaf with its siblings, from its own run up to and including those of ``top``.

    ``top`` has (tree, path, and columns to carry): what lies above a tree's root. Rows: the tree,
    pos, digest, ``extra`` columns of the leaves, path, and the carried ones.
    """
    carried = [c for c in top.columns if c not in (tree, "path")]
    above = top.withColumn("pos", F.lit(0).cast("long"))
    for k in range(len(levels) - 1, -1, -1):
        last = k == 0
        own = levels[k].select(tree, "n", "left", "pos", "digest", *(extra if last else []))
        blocks = _subtrees(own, tree, extra if last else []).join(above.withColumnRenamed("pos", "block"), [tree, "block"])
        rows = blocks.select(tree, "nodes", "h", "mid", "left", "path", *carried, F.posexplode(F.col("nodes")).alias("_i", "_node"))
        path = F.concat(F.expr(_paths("_i")), F.col("path"))
        if last:
            return rows.select(tree, "_node.*", path.alias("path"), *carried)
        above = saved(rows.select(tree, F.col("_node.pos").alias("pos"), path.alias("path"), *carried))
    raise ValueError("no levels")


def proof_digest(path: str = "path") -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]).cast("binary"), 256))


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """Root, subroot and proof of every row, and whether a row's present text still leads to the root.

    Input columns doc_id, source, lang, n_chars, text; others are ignored. Where ``tampered`` holds
    (null counts as false) the text's A-Z are taken to be in lower case now. One row per input row:
    doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified.

    A null source is a tree of its own, first in order. In a tree null ids come last; rows of
    one id are ordered by their digest, so repeated rows, which are leaves of their own, get the
    same results in any order. A tree of one leaf has that leaf as subroot, and a dataset of one
    source has its subroot as root. Empty in, empty out.
    """
    changed = F.coalesce(tampered, F.lit(False))
    source = F.col("source").cast("string")
    rows = saved(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.concat(F.lit("1"), source), F.lit("0")).alias("_tree"),
            F.col("doc_id").isNull().alias("_null"),
            leaf_digest().alias("digest"),
            F.when(changed, leaf_digest(lower_ascii(F.col("text").cast("string")))).alias("now"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    leaves = number(rows, "_tree", ["_null", "doc_id", "digest", "_row"])
    discard(rows)
    levels = checkpoints(leaves, "_tree")
    roots = levels[-1].select(F.col("_tree").alias("_sub"), "digest")
    sources = number(roots.withColumn("_all", F.lit(0)), "_all", ["_sub"])
    upper = checkpoints(sources, "_all")
    root = upper[-1].select("_all", F.array().cast(SIBLINGS).alias("path"), F.col("digest").alias("root"))
    tops = extract(upper, "_all", root, ["_sub"])
    above = saved(tops.select(F.col("_sub").alias("_tree"), "path", F.col("digest").alias("subroot"), "root"))
    proofs = extract(levels, "_tree", above, ["doc_id", "source", "now"])
    folded = fold(F.coalesce("now", "digest"))
    out = proofs.select("doc_id", "source", F.col("digest").alias("leaf"), "subroot", "root", proof_digest().alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


__all__ = ["checkpoints", "extract", "fold", "leaf_digest", "manifest", "number", "proof_digest"]

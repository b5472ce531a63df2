"""From raw documents to a training mix, in five stages of the operators in ``polyspark.llm``.

A stage takes the documents that its predecessor kept and returns the documents it keeps, with their
columns; the last adds what the mix takes of each. Rows are told apart by id and a hash of the
text, so repeated ids do not stand for each other.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polyspark.llm import automaton, decontam, langid, minhash, mixing
from polyspark.llm.common import BROADCAST_ROWS, read_table
from polyspark.session import saved, tune

LAST_ID = (1 << 63) - 1
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _tuned(stage: Stage) -> Stage:
    """A stage that applies the library's session settings first (batch sizes among them), whoever calls it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(tune(spark), docs, sf_dir)

    return run


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def _name(docs: DataFrame) -> Column:
    """128 bits of a row's text: what a stage decides on a text holds for all rows that have it."""
    return F.md5(_text(docs).cast("binary"))


def _small(table: DataFrame) -> DataFrame:
    """A saved table, marked to be broadcast if it has few rows."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose text's name is not in the saved table ``gone`` (name)."""
    return docs.join(_small(gone), _name(docs) == gone["name"], "left_anti")


@_tuned
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not told with confidence: no letters, or a score below the calibrated threshold.

    A null or empty text has no letters and goes. Repeated rows stay or go together, whatever their
    ids, which may be null. Empty in, empty out.
    """
    rows = docs.select(_name(docs).alias("doc_id"), docs["text"])
    judged = langid.identify(rows, langid.fit(docs))
    return _without(docs, saved(judged.where("rejected").select(F.col("doc_id").alias("name")).distinct()))


@_tuned
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near-duplicates; a repeated row stays once.

    Documents without words are no duplicates and stay, repeated or not. A null id is larger than
    any other. Empty in, empty out.
    """
    order = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), "th")
    grouped = saved(
        minhash.near_duplicates(docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))))
        .where(F.col("group").isNotNull())
        .select("group", order.alias("row"))
    )
    first = grouped.groupBy("group").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    times = grouped.groupBy("row").agg(F.count("*").alias("times"), F.first("group").alias("group"))
    firsts = first.select(F.col("row").alias("_first"))
    dropped = saved(times.join(firsts, F.col("row") == F.col("_first"), "left_anti").select("row.doc", "row.th"))
    again = saved(times.join(firsts, F.col("row") == F.col("_first"), "left_semi").where("times > 1").select("row.doc", "row.th"))
    doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID))
    is_in = lambda table: (doc == table["doc"]) & (_name(docs) == table["th"])
    kept = docs.join(_small(dropped), is_in(dropped), "left_anti")
    if again.isEmpty():
        return kept
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    once = kept.join(_small(again), is_in(again), "left_semi").groupBy(doc.alias("doc"), _name(docs).alias("th")).agg(F.first(row).alias("row"))
    return kept.join(_small(again), is_in(again), "left_anti").unionByName(once.select("row.*"))


@_tuned
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages of 20 words and more out of the texts; every document stays, if with an empty text.

    Words that stay in a changed text are joined by one space, so its line breaks go; ``n_chars`` is
    its new length. A null text comes out empty; rows of one id count as one document, null ids
    too. Empty in, empty out.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = automaton.removed_words(docs, carry=others)
    changed = {"text": F.col("kept")}
    if "n_chars" in others:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*docs.columns)


@_tuned
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item or a paraphrase of one.

    Null and empty texts hold none and stay; repeated rows stay or go together, whatever their ids,
    which may be null. Empty in, empty out.
    """
    text = _text(docs)
    first, second = F.xxhash64(F.lit("first"), text), F.xxhash64(text)  # with ``th``, 128 bits
    found = decontam.contaminated(docs.select(first.alias("doc_id"), text.alias("text")), read_table(spark, sf_dir, "benchmark"))
    gone = saved(found.select(F.col("doc_id").alias("a"), F.col("th").alias("b")).distinct())
    return docs.join(_small(gone), (first == gone["a"]) & (second == gone["b"]), "left_anti")


@_tuned
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words: their columns, size, source_size, target, taken.

    A null or wordless text has no words to take and goes; a null source is a source of its own, a
    null id an id like any other; repeated rows are documents of their own. Input columns of the
    four names are replaced. Empty in, empty out.
    """
    added = ("size", "source_size", "target", "taken")
    own = [c for c in docs.columns if c not in added]
    mixed = mixing.mix_sources(docs, carry=[c for c in own if c not in ("doc_id", "source")])
    return mixed.where("taken > 0").select(*own, *added)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs

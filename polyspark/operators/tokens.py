"""Text to token ids under a vocabulary table."""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyspark.functions.text import words
from polyspark.session import saved

WORD_START = "▁"
# Largest vocabulary that is sent to every task, in pieces and in bytes of pieces; beyond it, words are joined.
BROADCAST_PIECES = 1_000_000
BROADCAST_BYTES = 32 << 20
CACHED_WORDS = 200_000
# Texts of a block and pieces of a bucket, about: a Python group holds one of either.
BLOCK_BYTES = 16 << 20
BUCKET_PIECES = 500_000


def merge_word(word: str, score_of) -> list[str]:
    """Splits a word by repeatedly joining the adjacent pair whose joined piece scores highest; ties: leftmost."""
    symbols: list[str | None] = list(word)
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    queue: list[tuple[float, int, str, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0:
            joined = symbols[i] + symbols[j]
            score = score_of(joined)
            if score is not None:
                heapq.heappush(queue, (-score, i, joined, j))

    for i in range(len(symbols) - 1):
        offer(i)
    while queue:
        _, i, joined, j = heapq.heappop(queue)
        if symbols[i] is None or symbols[j] is None or after[i] != j or symbols[i] + symbols[j] != joined:
            continue
        symbols[i], symbols[j] = joined, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s in symbols if s is not None]


def ids_of(pieces: list[str], id_of, unk: int) -> list[int]:
    """Ids of pieces; an unknown piece becomes its byte pieces if the vocabulary has them, else unknown."""
    out = []
    for piece in pieces:
        known = id_of(piece)
        if known is not None:
            out.append(known)
            continue
        as_bytes = [id_of(f"<0x{b:02X}>") for b in piece.encode("utf-8")]
        out += [unk] if None in as_bytes else as_bytes
    return out


def _tokenize_by_table(df: DataFrame, rows: pd.DataFrame, keys: list[str], text: str, mode: str, unk: int) -> DataFrame:
    """The vocabulary goes to every task; each task splits a word once. No shuffle."""
    spark = df.sparkSession
    table = spark.sparkContext.broadcast(dict(zip(rows["piece"], zip(rows["id"].tolist(), rows["score"].tolist()))))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = table.value
        id_of = lambda p: known[p][0] if p in known else None
        score_of = lambda p: known[p][1] if p in known else None
        cache: dict[str, list[int]] = {}

        def ids(word: str) -> list[int]:
            found = cache.get(word)
            if found is None:
                marked = WORD_START + word
                pieces = [marked] if mode == "word" else merge_word(marked, score_of)
                found = ids_of(pieces, id_of, unk)
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                cache[word] = found
            return found

        for batch in batches:
            yield batch.map(lambda row: None if row is None else [i for w in row for i in ids(w)])

    return df.select(*keys, encode(words(F.col(text))).alias("input_ids"))


def _bytes_pieces(vocab: DataFrame) -> DataFrame:
    """The pieces that stand for bytes: at most 256."""
    return vocab.where(F.col("piece").rlike("^<0x[0-9A-F]{2}>$")).select("piece", "id", "score")


def _split_words(df: DataFrame, vocab: DataFrame, text: str, unk: int, max_length: int) -> DataFrame:
    """Each distinct word with its ids; it is split once, knowing only the pieces it may use."""
    distinct = df.select(F.explode(words(F.col(text))).alias("_word")).distinct()
    marked = F.concat(F.lit(WORD_START), F.col("_word"))
    starts = distinct.select("_word", marked.alias("_m"), F.explode(F.sequence(F.lit(1), F.length(marked))).alias("_i"))
    longest = F.least(F.lit(max_length), F.length("_m") - F.col("_i") + 1)
    parts = starts.select(
        "_word",
        "_i",
        "_m",
        F.explode(F.sequence(F.lit(1), longest)).alias("_l"),
    ).select("_word", F.expr("substring(_m, _i, _l)").alias("piece"))
    bytes_used = starts.select(
        "_word", F.explode(F.split(F.regexp_replace(F.hex(F.encode(F.substring("_m", F.col("_i"), F.lit(1)), "UTF-8")), "(..)", "$1 "), " ")).alias("_b")
    ).where("_b <> ''").select("_word", F.concat(F.lit("<0x"), F.col("_b"), F.lit(">")).alias("piece"))
    # without any, no word is taken apart for them
    as_bytes = F.broadcast(_bytes_pieces(vocab))
    pieces = vocab.select("piece", "id", "score")
    known = parts.distinct().join(pieces, "piece").unionByName(bytes_used.join(as_bytes, "piece").distinct())
    usable = known.groupBy("_word").agg(
        F.collect_list(F.struct("piece", "id", "score")).alias("_known")
    )

    @F.pandas_udf("array<int>")
    def split(word: pd.Series, known: pd.Series) -> pd.Series:
        out = []
        for w, rows in zip(word, known):
            table = {} if rows is None else {r["piece"]: (r["id"], r["score"]) for r in rows}
            id_of = lambda p: table[p][0] if p in table else None
            score_of = lambda p: table[p][1] if p in table else None
            out.append(ids_of(merge_word(WORD_START + w, score_of), id_of, unk))
        return pd.Series(out)

    return distinct.join(usable, "_word", "left").select("_word", split("_word", "_known").alias("_ids"))


def _dealt_words(bodies: Iterable[str | None], buckets: int) -> tuple[list[str], np.ndarray]:
    """The distinct words of a block by bucket, then code point, and their buckets."""
    # without an argument, str.split splits where ``functions.text.words`` does
    distinct: set[str] = set()
    for body in bodies:
        distinct.update((body or "").split())
    found = sorted(distinct)
    bucket = np.fromiter((crc32(w.encode()) % buckets for w in found), np.int32, len(found))
    at = np.argsort(bucket, kind="stable")
    return [found[i] for i in at], bucket[at]


def _lists(values: pa.Array, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


def _asks(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """What a block asks: a row for each bucket that holds words of it."""

    def run(docs: pa.Table) -> pa.Table:
        found, bucket = _dealt_words(_strings(docs["_body"]), buckets)
        names, starts = np.unique(bucket, return_index=True)
        return pa.table(
            {
                "_block": pa.array(np.full(len(names), docs["_block"][0].as_py()), pa.int32()),
                "_bucket": pa.array(names, pa.int32()),
                "words": _lists(pa.array(found, pa.string()), np.append(starts, len(found))),
            }
        )

    return run


def _answers(as_bytes: dict[str, int], unk: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ids of the words asked of a bucket, in the order asked; words without any are bytes or unknown."""

    def run(asked: pa.Table, table: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.Table.from_pylist([], ANSWERED)
        lists = asked["words"].combine_chunks()
        asked_words, known = lists.flatten(), table["_ids"].combine_chunks()
        at = pc.index_in(asked_words, value_set=table["_word"].combine_chunks())
        absent = asked_words.filter(at.is_null())
        distinct = absent.unique()
        rest = pa.array([ids_of([WORD_START + w], as_bytes.get, unk) for w in distinct.to_pylist()], pa.list_(pa.int32()))
        at = pc.replace_with_mask(at, at.is_null(), pc.add(pc.index_in(absent, value_set=distinct), pa.scalar(len(known), pa.int32())))
        ids = pa.concat_arrays([known.cast(rest.type), rest]).take(at)
        sizes = ids.value_lengths()
        cuts = np.append(0, np.cumsum(lists.value_lengths()))
        ends = np.append(0, np.cumsum(sizes))
        return pa.Table.from_arrays(
            [asked["_block"], asked["_bucket"], _lists(sizes, cuts), _lists(ids.flatten(), ends[cuts])], schema=ANSWERED
        )

    return run


ASKED_SCHEMA = "_block int, _bucket int, words array<string>"
ANSWER_SCHEMA = "_block int, _bucket int, sizes array<int>, ids array<int>"
ANSWERED = pa.schema(
    {"_block": pa.int32(), "_bucket": pa.int32(), "sizes": pa.list_(pa.int32()), "ids": pa.list_(pa.int32())}
)


def _strings(column: pa.ChunkedArray) -> Iterator[str | None]:
    """The texts of a column; few of them are Python strings at a time."""
    for chunk in column.chunks:
        for start in range(0, len(chunk), 1000):
            yield from chunk.slice(start, 1000).to_pylist()


def _encoded(buckets: int, keys: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ids of each text of a block, from the answers to the block."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        found, _ = _dealt_words(_strings(docs["_body"]), buckets)
        answers = answers.sort_by("_bucket")
        sizes, ids = (answers[c].combine_chunks().flatten().to_numpy() for c in ("sizes", "ids"))
        lists = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] if len(sizes) else []
        ids_of_word = dict(zip(found, lists, strict=True))
        out, ends = array("i"), [0]
        for body in _strings(docs["_body"]):
            out.extend(chain.from_iterable(map(ids_of_word.__getitem__, (body or "").split())))
            ends.append(len(out))
        none = docs["_body"].combine_chunks().is_null()
        values = pa.array(np.frombuffer(out, np.int32) if out else np.empty(0, np.int32))
        rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=none)
        return docs.select([*keys, "_copies"]).append_column("input_ids", rows)

    return run


def _tokenize_by_join(
    df: DataFrame, vocab: DataFrame, keys: list[str], text: str, mode: str, unk: int, max_length: int, n_pieces: int
) -> DataFrame:
    """For a vocabulary of any size: texts are dealt over blocks of about ``BLOCK_BYTES``.

    A block asks once for each distinct word in it; the answers come in the order asked and need
    no words. So each text is shuffled once and no row is a word of a text. Rows of equal keys
    and text, which meet in a block, are one there.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    n_bytes = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n = max(least, -(-n_bytes // BLOCK_BYTES))
    buckets = max(n, -(-n_pieces // BUCKET_PIECES))
    if mode == "word":
        as_bytes = {r["piece"]: r["id"] for r in _bytes_pieces(vocab).collect()}
        whole = vocab.where(F.col("piece").startswith(WORD_START))
        table = whole.select(F.substr("piece", F.lit(len(WORD_START) + 1)).alias("_word"), F.array(F.col("id").cast("int")).alias("_ids"))
    else:
        as_bytes = {}  # they are among the pieces of each word
        table = _split_words(df, vocab, text, unk, max_length)
    bucket = F.pmod(F.crc32(F.col("_word").cast("binary")), F.lit(buckets)).cast("int")

    rows = df.select(*keys, F.col(text).alias("_body"))
    block = F.pmod(F.xxhash64(*keys, "_body"), F.lit(n)).cast("int")
    blocks = (
        rows.select(block.alias("_block"), "*")
        .repartition(n, "_block")
        .groupBy("_block", *keys, "_body")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    asked = blocks.select("_block", "_body").groupBy("_block").applyInArrow(_asks(buckets), ASKED_SCHEMA)
    answers = (
        asked.groupBy("_bucket")
        .cogroup(table.select(bucket.alias("_bucket"), "_word", "_ids").groupBy("_bucket"))
        .applyInArrow(_answers(as_bytes, unk), ANSWER_SCHEMA)
    )
    schema = T.StructType([df.schema[k] for k in keys]).add("_copies", "long").add("input_ids", T.ArrayType(T.IntegerType()))
    encoded = blocks.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(_encoded(buckets, keys), schema)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_copy")
    return encoded.select(*keys, "input_ids", copies).drop("_copy")


def tokenize(
    df: DataFrame,
    vocab: DataFrame,
    keys: list[str],
    text: str = "text",
    mode: str = "bpe",
    special: tuple[int | None, int | None] | None = None,
    unk: int = 0,
    broadcast_pieces: int = BROADCAST_PIECES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``keys`` and ``input_ids``; every other column is dropped.

    ``bpe`` joins pieces by score, ``word`` looks whole words up. ``special`` is the
    ids put before and after each text. A vocabulary of at most ``broadcast_pieces`` and
    ``broadcast_bytes`` is sent to the tasks, which needs no shuffle; for a larger one,
    distinct words are split once and looked up. Both ways give the same ids.
    """
    if mode not in ("bpe", "word"):
        raise ValueError(f"unknown mode {mode!r}")
    vocab = saved(vocab)  # it is read several times
    size = vocab.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("piece")).alias("bytes"), F.max(F.length("piece")).alias("longest")
    ).first()
    if size["n"] <= broadcast_pieces and (size["bytes"] or 0) <= broadcast_bytes:
        out = _tokenize_by_table(df, vocab.select("piece", "id", "score").toPandas(), keys, text, mode, unk)
    else:
        out = _tokenize_by_join(df, vocab, keys, text, mode, unk, size["longest"] or 1, size["n"])
    if special is None:
        return out
    ends = [F.array(F.lit(i)) if i is not None else F.array().cast("array<int>") for i in special]
    return out.withColumn("input_ids", F.concat(ends[0], "input_ids", ends[1]))

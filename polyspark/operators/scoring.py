"""Data work around a model call: windows, batches, deduplication, cache, scorers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyspark.functions.hashing import hash_hex, hash_unit
from polyspark.functions.joins import skew_safe_join
from polyspark.functions.ranks import running_total
from polyspark.functions.text import cut_at_stops
from polyspark.operators.prompts import GENERATION
from polyspark.session import saved
from polyspark.sources.sinks import path_exists

# --- token windows --------------------------------------------------------------------------


def rolling_windows(
    df: DataFrame, tokens: str, max_len: int, ctx_len: int, prefix: Column, keys: list[str]
) -> DataFrame:
    """Windows that predict every token once: window_idx, ctx, cont.

    The first window starts with ``prefix``; later ones keep as much context as fits.
    """
    if not 1 <= ctx_len <= max_len:
        raise ValueError("need 1 <= ctx_len <= max_len")
    step = max_len - ctx_len + 1
    n = F.size(tokens)
    first = F.least(F.lit(max_len), n)
    last = F.when(n > first, F.ceil((n - first) / F.lit(step))).otherwise(F.lit(0)).cast("int")
    start = F.when(F.col("window_idx") == 0, 0).otherwise(first + (F.col("window_idx") - 1) * step)
    end = F.least(n, first + F.col("window_idx") * step)
    ctx = F.when(
        F.col("window_idx") == 0, F.concat(F.array(prefix), F.slice(tokens, 1, first - 1))
    ).otherwise(F.slice(tokens, end - max_len, F.lit(max_len)))
    return (
        df.where(n > 0)
        .select(*keys, tokens, F.explode(F.sequence(F.lit(0), last)).alias("window_idx"))
        .select(*keys, "window_idx", ctx.alias("ctx"), F.slice(tokens, start + 1, end - start).alias("cont"))
    )


def disjoint_windows(df: DataFrame) -> DataFrame:
    """Cuts the part of the context that the continuation repeats."""
    keep = F.greatest(F.size("ctx") - (F.size("cont") - 1), F.lit(0))
    return df.withColumn("ctx", F.slice("ctx", F.lit(1), keep))


def _pad(tokens: Column, pad: Column, length: Column) -> Column:
    return F.concat(tokens, F.array_repeat(pad, F.greatest(length - F.size(tokens), F.lit(0))))


def pad_windows(df: DataFrame, pad: Column, max_len: int, keys: list[str]) -> DataFrame:
    """Pads contexts to the length of the document's last context, and its last continuation to ``max_len``.

    The last window of a document is one small aggregate row, joined back.
    """
    last = df.groupBy(*keys).agg(
        F.max("window_idx").alias("_last"), F.max_by(F.size("ctx"), "window_idx").alias("_length")
    )
    is_last = F.col("window_idx") == F.col("_last")
    ctx = (
        F.when(is_last & (F.size("ctx") == 0), F.array(pad))
        .when(~is_last & (F.col("_length") > 1), _pad(F.col("ctx"), pad, F.col("_length")))
        .otherwise(F.col("ctx"))
    )
    cont = F.when(is_last & (F.col("_last") > 0), _pad(F.col("cont"), pad, F.lit(max_len))).otherwise(F.col("cont"))
    return df.join(last, keys).withColumns({"ctx": ctx, "cont": cont}).drop("_last", "_length")


def truncate_left(ctx: Column, cont: Column, max_len: int) -> dict[str, Column]:
    """Model input of a scoring request: the last max_len + 1 tokens without the final one.

    ``api_input`` and ``ctx_len`` are the variant that sends the final token too.
    """
    full = F.concat(ctx, cont)
    size = F.size(full)
    start = F.greatest(size - (max_len + 1), F.lit(0))
    return {
        "input": F.slice(full, start + 1, F.greatest(size - start - 1, F.lit(0))),
        "api_input": F.slice(full, start + 1, F.lit(max_len + 1)),
        "ctx_len": F.size(ctx) - F.greatest(size - (max_len + 1), F.lit(0)),
    }


def truncate_for_generation(ctx: Column, max_len: int, max_gen: int) -> Column:
    """The last max_len - max_gen context tokens."""
    keep = max_len - max_gen
    return F.slice(ctx, F.greatest(F.size(ctx) - keep, F.lit(0)) + 1, F.lit(keep))


def length_batches(df: DataFrame, length: str, order_hash: str, batch_size: int) -> DataFrame:
    """Batches of ``batch_size`` rows, longest first: batch, and the padded length of each.

    Rows of one length are spread by their hash, so a common length is many small groups.
    """
    prepared = df.withColumns({"_shorter": -F.col(length), "_prefix": F.substring(order_hash, 1, 2)})
    placed = running_total(prepared, [], ["_shorter", "_prefix"], [F.col(order_hash)], F.lit(1), "_position")
    batched = placed.withColumn("batch", F.floor(F.col("_position") / batch_size))
    longest = batched.groupBy("batch").agg(F.max(length).alias("padded_length"))
    return batched.join(longest, "batch").drop("_shorter", "_prefix", "_position")


def padding_report(batched: DataFrame, length: str) -> DataFrame:
    """Tokens, padded tokens and the share of padding."""
    return batched.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_distinct("batch").alias("batches"),
        F.sum(length).cast("bigint").alias("tokens"),
        F.sum("padded_length").cast("bigint").alias("padded_tokens"),
    ).withColumn("padding_share", 1 - F.col("tokens") / F.col("padded_tokens"))


def select_continuation(df: DataFrame, batch: str, ctx: str, generated: str, out: str = "continuation") -> DataFrame:
    """Generated tokens after the longest context of the batch."""
    longest = df.groupBy(batch).agg(F.max(F.size(ctx)).alias("_longest"))
    tail = F.slice(generated, F.col("_longest") + 1, F.greatest(F.size(generated), F.lit(1)))
    return df.join(longest, batch).withColumn(out, tail).drop("_longest")


# --- deduplication and cache ----------------------------------------------------------------


def request_key(df: DataFrame) -> Column:
    """SHA-256 of a request's type, context, continuation and arguments."""
    cont = F.col("cont") if "cont" in df.columns else F.lit(None).cast("string")
    args = F.to_json("args") if "args" in df.columns else F.lit(None).cast("string")
    parts = [F.coalesce(c, F.lit("\x1e")) for c in (F.col("req_type"), F.col("ctx"), cont, args)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def dedup_requests(requests: DataFrame) -> DataFrame:
    """Each distinct request once, with ``origins``, how many rows asked for it."""
    keyed = requests if "request_key" in requests.columns else requests.withColumn("request_key", request_key(requests))
    fields = [c for c in ("req_type", "ctx", "cont", "args") if c in keyed.columns]
    return keyed.groupBy("request_key").agg(
        *[F.first(c).alias(c) for c in fields], F.count(F.lit(1)).alias("origins")
    )


def scatter_back(requests: DataFrame, responses: DataFrame, row_id: list[str]) -> DataFrame:
    """Responses (request_key, origins, ...) back on every row that asked.

    ``row_id`` spreads the rows of a request asked for very often.
    """
    keyed = requests if "request_key" in requests.columns else requests.withColumn("request_key", request_key(requests))
    return skew_safe_join(keyed, responses, ["request_key"], "origins", [F.col(c) for c in row_id])


def cached_scores(
    requests: DataFrame, cache_path: str, score: Callable[[DataFrame], DataFrame], row_id: list[str]
) -> DataFrame:
    """Scores only the requests that are not in the cache table, and adds them to it.

    ``score`` maps distinct requests to (request_key, ll, is_greedy, generated).
    """
    spark = requests.sparkSession
    unique = dedup_requests(requests)
    schema = "request_key string, ll double, is_greedy boolean, generated string"
    misses = unique
    if path_exists(spark, cache_path):
        misses = unique.join(spark.read.schema(schema).parquet(cache_path), "request_key", "left_anti")
    score(misses).select("request_key", "ll", "is_greedy", "generated").write.mode("append").parquet(cache_path)
    # a run that was repeated may have written a key twice: one row per key counts
    known = spark.read.schema(schema).parquet(cache_path).groupBy("request_key")
    known = known.agg(F.min(F.struct("ll", "is_greedy", "generated")).alias("_r")).select("request_key", "_r.*")
    # saved, as a plan with two reads of the cache takes them for one, whatever was added in between
    scored = saved(unique.select("request_key", "origins").join(known, "request_key"))
    return scatter_back(requests, scored, row_id)


# --- scorers --------------------------------------------------------------------------------


def score_dummy(requests: DataFrame) -> DataFrame:
    """Stand-in scorer: a log-likelihood in (-1, 0] from a hash, never greedy; generations are "null"."""
    generation = F.col("req_type") == GENERATION
    cont = F.col("cont") if "cont" in requests.columns else F.lit(None).cast("string")
    return requests.withColumns(
        {
            "ll": F.when(~generation, -hash_unit(F.col("ctx"), cont)),
            "is_greedy": F.when(~generation, F.lit(False)),
            "generated": F.when(
                generation & (F.trim("ctx") == ""), F.raise_error(F.lit("a generation needs a context")).cast("string")
            ).when(generation, F.lit("null")),
        }
    )


ARGS_TYPE = "struct<stop_sequences: array<string>, max_generation_length: int, num_fewshot: int>"
SCORE_SCHEMA = "request_key string, ll double, is_greedy boolean, generated string"


def score_with(requests: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Runs a model over Arrow batches of (request_key, req_type, ctx, cont, args).

    ``fn`` returns a frame with ll, is_greedy and generated, in the order of its input.
    ``cont`` is null for generations; ``args`` (stop_sequences, max_generation_length,
    num_fewshot) is null for other requests.
    """
    absent = {"cont": F.lit(None).cast("string"), "args": F.lit(None).cast(ARGS_TYPE)}
    requests = requests.withColumns({c: v for c, v in absent.items() if c not in requests.columns})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scored = fn(batch)
            yield pd.DataFrame(
                {
                    "request_key": batch["request_key"].to_numpy(),
                    "ll": scored["ll"].to_numpy(),
                    "is_greedy": scored["is_greedy"].to_numpy(),
                    "generated": scored["generated"].to_numpy(),
                }
            )

    return requests.select("request_key", "req_type", "ctx", "cont", "args").mapInPandas(run, SCORE_SCHEMA)


# --- n-gram model ---------------------------------------------------------------------------

START = "<s>"
#: Words in a block of documents, about. A Python group holds one block, or about as many keys.
BLOCK_WORDS = 1 << 21

ASKED_SCHEMA = "_block int, _bucket int, key array<bigint>, n array<bigint>"
ANSWER_SCHEMA = "_block int, _bucket int, counts array<bigint>"


def _bigrams(docs: DataFrame, keys: list[str], tokens: str) -> DataFrame:
    """Word pairs w1, w2 of each document, the first word preceded by ``<s>``."""
    before = F.concat(F.array(F.lit(START)), F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))))
    return docs.select(*keys, F.inline(F.arrays_zip(before.alias("w1"), F.col(tokens).alias("w2"))))


def train_ngram_lm(docs: DataFrame, by: list[str], tokens: str) -> dict[str, DataFrame]:
    """Unigram, bigram and context counts and totals per group (language), and the words they count.

    Each table counts the documents by itself when it is read: one that needs no pairs shuffles
    none, and ``score_ngram`` counts the words it looks up in the shuffle that looks them up.
    """
    pairs = _bigrams(docs, by, tokens)
    n = F.count(F.lit(1))
    unigrams = pairs.groupBy(*by, "w2").agg(n.alias("n_word"))
    return {
        "bigrams": pairs.groupBy(*by, "w1", "w2").agg(n.alias("n_pair")),
        "contexts": pairs.groupBy(*by, "w1").agg(n.alias("n_ctx")),
        "unigrams": unigrams,
        "totals": unigrams.groupBy(*by).agg(F.sum("n_word").alias("n_all"), n.alias("n_vocab")),
        "words": docs.select(*by, F.col(tokens).alias("words")),
    }


def ngram_table(lm: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Bigram counts with the count of their first word: ``by``, w1, w2, n_pair, n_ctx; no null groups or first words.

    The words are counted where they lie, a block at a time: a row is a first word with all
    that follows it in the block. These rows meet by first word, in one shuffle that serves both
    counts. What follows a first word of more than a partition's share is spread over partitions.
    """
    words = lm["words"]
    held = F.when(F.size("words") > 0, F.col("words")).otherwise(F.array(F.lit(None).cast("string")))
    fields = [words.schema[k] for k in by]
    schema = T.StructType(fields).add("w1", "string").add("n", "long")
    schema = schema.add("w2", T.ArrayType(T.StringType())).add("n2", T.ArrayType(T.LongType()))
    counted = saved(
        words.where(F.col("words").isNotNull())
        .select(*by, F.concat(F.array(F.lit(START)), held).alias("_words"))
        .mapInArrow(_followers(by), schema)
        .dropna(subset=[*by, "w1"])
    )
    shares = 2 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")) / F.lit(
        counted.agg(F.coalesce(F.sum("n"), F.lit(0)) + 1).first()[0]
    )
    hot = (
        counted.groupBy(*by, "w1").agg(F.sum("n").alias("_n")).withColumn("_parts", F.ceil(F.col("_n") * shares).cast("int"))
    )
    hot = F.broadcast(saved(hot.where("_parts > 2")))
    pairs = F.arrays_zip("w2", F.col("n2").alias("n_pair"))
    split = F.transform(
        F.sequence(F.lit(0), F.col("_parts") - 1),
        lambda p: F.struct(
            p.alias("_part"),
            F.filter("_pairs", lambda f: F.pmod(F.xxhash64(f["w2"]), F.col("_parts")) == p).alias("_pairs"),
        ),
    )
    whole = F.array(F.struct(F.lit(0).alias("_part"), F.col("_pairs")))
    parts = (
        counted.withColumn("_pairs", pairs)
        .join(hot, [*by, "w1"], "left")
        .select(*by, "w1", "n", "_n", F.inline(F.when(F.col("_parts").isNull(), whole).otherwise(split)))
    )
    met = Window.partitionBy(*by, "w1", "_part")
    return (
        parts.withColumn("n_ctx", F.coalesce("_n", F.sum("n").over(met)))
        .select(*by, "w1", "_part", "n_ctx", F.inline("_pairs"))
        .groupBy(*by, "w1", "_part", "n_ctx", "w2")
        .agg(F.sum("n_pair").alias("n_pair"))
        .select(*by, "w1", "w2", "n_pair", "n_ctx")
    )


def _numbered(codes: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes (all below ``top``), for each code the number of its own, and how often each is there."""
    if top > 8 * len(codes):
        return np.unique(codes, return_inverse=True, return_counts=True)
    n = np.bincount(codes, minlength=top)
    there = np.flatnonzero(n)
    return there, (np.cumsum(n > 0) - 1)[codes], n[there]


def _followers(by: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """First words of about ``BLOCK_WORDS`` words at a time, with what follows each and how often."""

    def count(docs: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.zeros(docs.num_rows, np.int64)
        for k in by:
            codes = docs[k].combine_chunks().dictionary_encode(null_encoding="encode")
            group = np.unique(group * (len(codes.dictionary) + 1) + codes.indices.to_numpy(), return_inverse=True)[1]
        _, example = np.unique(group, return_index=True)
        lists = docs["_words"].combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        codes = lists.flatten().dictionary_encode(null_encoding="encode")
        number, names = codes.indices.to_numpy().astype(np.int64), codes.dictionary
        ends = np.cumsum(sizes)
        first, second = np.delete(number, ends - 1), np.delete(number, ends - sizes)
        above, at, n = _numbered(np.repeat(group, sizes - 1) * len(names) + first, len(example) * len(names))
        pairs, n2 = np.unique(at * len(names) + second, return_counts=True)
        owner, second = np.divmod(pairs, len(names))
        cuts = pa.array(np.searchsorted(owner, np.arange(len(above) + 1)), pa.int32())
        group, first = np.divmod(above, len(names))
        out = docs.select(by).take(example[group])
        out = out.append_column("w1", names.take(pa.array(first))).append_column("n", pa.array(n, pa.int64()))
        out = out.append_column("w2", pa.ListArray.from_arrays(cuts, names.take(pa.array(second))))
        yield from out.append_column("n2", _lists(n2, cuts)).to_batches(max_chunksize=10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            kept.append(batch)
            size += len(batch["_words"].flatten())
            if size >= BLOCK_WORDS:
                yield from count(pa.Table.from_batches(kept))
                kept, size = [], 0
        if size:
            yield from count(pa.Table.from_batches(kept))

    return run


def score_ngram(
    lm: dict[str, DataFrame], docs: DataFrame, by: list[str], keys: list[str], tokens: str, alpha: float = 0.5, order: int = 2
) -> DataFrame:
    """Log-likelihood of each document's tokens: ``by``, ``keys``, ll, n_tokens.

    Documents are dealt over blocks of about ``BLOCK_WORDS`` words. A block asks once for each
    distinct pair and word in it, with its own count of them, so a common one is one entry a
    block; the answers come in the order asked and need no keys. The documents the model counts
    ask and count at once. Words are 64-bit hashes, which differ between groups; so are pairs,
    within a bucket.
    """
    totals = saved(lm["totals"])
    known = lm["words"]
    same = docs.select(*by, F.col(tokens).alias("words")).sameSemantics(known)
    n_known = totals.agg(F.coalesce(F.sum("n_all"), F.lit(0))).first()[0]
    n_words = n_known if same else docs.agg(F.coalesce(F.sum(F.size(tokens)), F.lit(0))).first()[0]
    least = docs.sparkSession.sparkContext.defaultParallelism
    buckets = max(least, -(-max(n_known, n_words) // BLOCK_WORDS))

    blocks = _blocks(docs.select(*by, *keys, tokens).join(totals, by, "left"), by, keys, tokens, n_words, ["n_all", "n_vocab"])
    asked = blocks.groupBy("_block").applyInArrow(_asks(buckets, order, counts=same), ASKED_SCHEMA)
    if not same:
        counted = _blocks(known, by, [], "words", n_known, []).groupBy("_block")
        asked = asked.unionByName(counted.applyInArrow(_asks(buckets, order, asks=False), ASKED_SCHEMA))
    answers = asked.groupBy("_bucket").applyInArrow(_answers, ANSWER_SCHEMA)
    schema = T.StructType([docs.schema[k] for k in [*by, *keys]]).add("ll", "double").add("n_tokens", "long")
    return (
        blocks.groupBy("_block")
        .cogroup(answers.groupBy("_block"))
        .applyInArrow(_sums(buckets, order, alpha, [*by, *keys]), schema)
        .groupBy(*by, *keys)
        .agg(F.sum("ll").alias("ll"), F.sum("n_tokens").alias("n_tokens"))
    )


def _blocks(docs: DataFrame, by: list[str], keys: list[str], tokens: str, n_words: int, more: list[str]) -> DataFrame:
    """Documents with words, dealt over blocks; ``_words`` are hashes, null for a null word or in a null group."""
    n = max(docs.sparkSession.sparkContext.defaultParallelism, -(-n_words // BLOCK_WORDS))
    in_group = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])
    # a document without words counts as one null word, as in ``_bigrams``
    held = F.when(F.size(tokens) > 0, F.col(tokens)).otherwise(F.array(F.lit(None).cast("string")))
    hashed = F.transform(
        F.concat(F.array(F.lit(START)), held), lambda w: F.when(in_group & w.isNotNull(), F.xxhash64(*by, w))
    )
    block = F.pmod(F.xxhash64(*by, *keys, tokens), F.lit(n)).cast("int")
    return (
        docs.where(F.col(tokens).isNotNull())
        .select(block.alias("_block"), *by, *keys, hashed.alias("_words"), *[F.col(m).alias(f"_{m}") for m in more])
        .repartition(n, "_block")
    )


class _Block:
    """The words of a block of documents as numbers, and its distinct words and pairs."""

    def __init__(self, docs: pa.Table, order: int):
        lists = docs["_words"].combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        flat = lists.flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        number = np.full(len(flat), -1)
        self.words, number[known] = np.unique(flat.drop_null().to_numpy(), return_inverse=True)
        ends = np.cumsum(sizes)
        self.first, self.second = np.delete(number, ends - 1), np.delete(number, ends - sizes)
        self.doc = np.repeat(np.arange(len(sizes)), sizes - 1)
        # what stands below: the word before, or for single words the word itself
        self.single = self.second if order == 1 else self.first
        self.n_single = np.bincount(self.single[self.single >= 0], minlength=len(self.words))
        self.paired = (self.first >= 0) & (self.second >= 0) & (order != 1)
        codes = self.first[self.paired] * len(self.words) + self.second[self.paired]
        codes, self.pair, self.n_pair = np.unique(codes, return_inverse=True, return_counts=True)
        self.pairs = np.divmod(codes, max(len(self.words), 1))

    def dealt(self, buckets: int):
        """Pairs and words as (key, n, order by bucket, bucket); words are in buckets below 0."""
        a, b = (self.words[p].view(np.uint64) for p in self.pairs)
        # the words of a pair are spread over all of 64 bits, so a sum of odd multiples of them is too
        keys = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
        # a bucket gets no first word's pairs beyond a sixteenth of its share
        bucket = (a >> np.uint64(7)) % np.uint64(buckets) + (b >> np.uint64(7)) % np.uint64(max(16, buckets // 16))
        bucket = (bucket % np.uint64(buckets)).astype(np.int32)
        yield keys.view(np.int64), self.n_pair, np.argsort(bucket, kind="stable"), bucket
        bucket = -1 - ((self.words.view(np.uint64) >> np.uint64(7)) % np.uint64(buckets)).astype(np.int32)
        yield self.words, self.n_single, np.argsort(bucket, kind="stable"), bucket


def _lists(values: np.ndarray, cuts: np.ndarray | pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int64()))


def _asks(buckets: int, order: int, counts: bool = True, asks: bool = True) -> Callable[[pa.Table], pa.Table]:
    """A block's distinct pairs and words by bucket, with its own counts; blocks that only count are below 0."""

    def run(docs: pa.Table) -> pa.Table:
        block = docs["_block"][0].as_py()
        parts = []
        for key, n, at, bucket in _Block(docs, order).dealt(buckets):
            names, starts = np.unique(bucket[at], return_index=True)
            cuts = np.append(starts, len(at))
            parts.append(
                pa.table(
                    {
                        "_block": pa.array(np.full(len(names), block if asks else -1 - block), pa.int32()),
                        "_bucket": pa.array(names, pa.int32()),
                        "key": _lists(key[at], cuts),
                        "n": _lists(n[at] if counts else np.zeros(len(at), np.int64), cuts),
                    }
                )
            )
        return pa.concat_tables(parts)

    return run


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table[column].combine_chunks().flatten().to_numpy()


def _answers(asked: pa.Table) -> pa.Table:
    """The counts of all blocks together for what each block asks of a bucket."""
    key, n = _flat(asked, "key"), _flat(asked, "n")
    at = np.argsort(key)
    key = key[at]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts = np.empty_like(n)
    counts[at] = np.repeat(np.add.reduceat(n[at], starts), np.diff(np.append(starts, len(at))))
    sizes = asked["key"].combine_chunks().value_lengths().to_numpy()
    out = asked.select(["_block", "_bucket"]).append_column("counts", _lists(counts, np.append(0, np.cumsum(sizes))))
    return out.filter(pc.greater_equal(out["_block"], 0))


def _sums(buckets: int, order: int, alpha: float, keys: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The log-likelihood of each document of a block, from the answers to the block."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(docs, order)
        answers = answers.sort_by("_bucket")
        counts = []
        for above, (*_, at, _) in zip((True, False), block.dealt(buckets)):
            of = answers.filter(pc.equal(pc.greater_equal(answers["_bucket"], 0), above))
            counts.append(np.empty(len(at), np.int64))
            counts[-1][at] = _flat(of, "counts")
        pairs, singles = counts
        single = np.zeros(len(block.doc))
        single[block.single >= 0] = singles[block.single[block.single >= 0]]
        n_all, n_vocab = (docs[f"_{c}"].combine_chunks().fill_null(0).to_numpy()[block.doc] for c in ("n_all", "n_vocab"))
        if order == 1:
            over, under = single, n_all
        else:
            over, under = np.zeros(len(block.doc)), single
            over[block.paired] = pairs[block.pair]
        with np.errstate(divide="ignore", invalid="ignore"):
            # one more vocabulary entry stands for all unseen words
            share = (over + alpha) / (under + alpha * (n_vocab + 1))
        some = share > 0
        logs = np.bincount(block.doc[some], np.log(share[some]), docs.num_rows)
        none = np.bincount(block.doc[some], minlength=docs.num_rows) == 0
        n_tokens = np.bincount(block.doc, minlength=docs.num_rows)
        return (
            docs.select(keys)
            .append_column("ll", pa.array(logs, pa.float64(), mask=none))
            .append_column("n_tokens", pa.array(n_tokens, pa.int64()))
        )

    return run


# --- responses ------------------------------------------------------------------------------


def reduce_logprobs(token_logprobs: Column, tokens: Column, top_logprobs: Column, ctx_len: Column) -> dict[str, Column]:
    """Sum of the log-probabilities after the context, and whether each token was the top candidate."""
    rest = F.greatest(F.size(tokens) - ctx_len, F.lit(0))
    ll = F.aggregate(F.slice(token_logprobs, ctx_len + 1, rest), F.lit(0.0), lambda a, x: a + x)
    pairs = F.slice(F.arrays_zip(tokens.alias("token"), top_logprobs.alias("top")), ctx_len + 1, rest)

    def best(top: Column) -> Column:
        most = F.array_max(F.map_values(top))
        return F.element_at(F.filter(F.map_entries(top), lambda e: e["value"] == most), 1)["key"]

    return {"ll": ll, "is_greedy": F.forall(pairs, lambda p: best(p["top"]) == p["token"])}


def rolling_loglikelihood(scored_windows: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the window scores of each document."""
    return scored_windows.groupBy(*keys).agg(F.sum("ll").alias("ll"))


def cut_generation(generated: Column, stops: Column, k: Column, end_of_text: str) -> Column:
    """Text before the first stop string; without few-shot examples only the end of text stops."""
    end = F.array(F.lit(end_of_text))
    used = F.when(stops.isNull() | (k == 0), end).otherwise(F.concat(stops, end))
    return cut_at_stops(generated, used)


def collect_doc_results(responses: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """The responses of each document in request order, as an array of structs."""
    return responses.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("req_idx", *fields))).alias("results")
    )

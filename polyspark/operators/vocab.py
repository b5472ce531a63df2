"""Learning, extending and comparing subword vocabularies held as tables.

A vocabulary is a table (id, piece, score, type).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polyspark.functions.ranks import position_by, running_total
from polyspark.functions.text import WHITE_SPACE_RUN, characters, words
from polyspark.operators.tokens import tokenize
from polyspark.session import discard, saved

# The word-start mark, piece types and control pieces of the vocabulary format.
WORD_START = "▁"
NORMAL, UNKNOWN, CONTROL = 1, 2, 3
CONTROL_PIECES = [("<unk>", UNKNOWN), ("<s>", CONTROL), ("</s>", CONTROL)]
MAX_PIECE_LENGTH = 16
DEFAULT_COVERAGE = 0.9995

# Marks around each symbol of a word while merges are learnt.
OPEN, CLOSE = "\x1e", "\x1f"


def word_counts(corpus: DataFrame, by: list[str] | None = None, text: str = "text") -> DataFrame:
    """Words with the start mark and how often each occurs, in total or per ``by``."""
    by = by or []
    word = F.explode(words(F.col(text)))
    return (
        corpus.select(*by, word.alias("_w"))
        .groupBy(*by, "_w")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*by, F.concat(F.lit(WORD_START), F.col("_w")).alias("word"), "n")
    )


def char_inventory(counts: DataFrame, coverage: float = DEFAULT_COVERAGE) -> DataFrame:
    """Characters by frequency, up to the one that reaches the coverage: rank, char, n.

    The table has one row per character, so the ordered window is over a bounded table.
    """
    chars = (
        counts.select(F.explode(characters(F.col("word"))).alias("char"), "n")
        .groupBy("char")
        .agg(F.sum("n").alias("n"))
    )
    ordered = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), "char")
    before = F.coalesce(F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return (
        chars.withColumns({"_before": before, "_total": total, "rank": F.row_number().over(ordered) - 1})
        .where(F.col("_before") / F.col("_total") < coverage)
        .select(F.col("rank").cast("bigint"), "char", "n")
    )


def word_vocabulary(counts: DataFrame, min_count: int = 1, first_id: int = 0) -> DataFrame:
    """A vocabulary of whole words seen at least ``min_count`` times, most common first."""
    kept = counts.where(F.col("n") >= min_count).withColumns(
        {"_rarer": -F.col("n"), "_prefix": F.substring("word", 1, 3)}
    )
    placed = running_total(kept, [], ["_rarer", "_prefix"], [F.col("word")], F.lit(1), "_at")
    return placed.select(
        (F.col("_at") + first_id).alias("id"),
        F.col("word").alias("piece"),
        (-F.col("_at") - first_id).cast("double").alias("score"),
        F.lit(NORMAL).alias("type"),
    )


# --- merges ---------------------------------------------------------------------------------


def _marked(symbol: str) -> str:
    return f"{OPEN}{symbol}{CLOSE}"


def start_symbols(counts: DataFrame) -> DataFrame:
    """Each word as its characters, each between two marks."""
    marked = F.transform(characters(F.col("word")), lambda c: F.concat(F.lit(OPEN), c, F.lit(CLOSE)))
    return counts.select(F.array_join(marked, "").alias("symbols"), "n")


def _parts(symbols: Column) -> Column:
    """The symbols of a word as an array; a one-character delimiter needs no regular expression."""
    return F.split(F.rtrim(F.replace(symbols, F.lit(OPEN), F.lit("")), F.lit(CLOSE)), CLOSE)


def _signed(parts: str, sign: int) -> Column:
    """Adjacent symbol pairs of a word as an array of (left, right, sign)."""
    rest = F.greatest(F.size(parts) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(parts, F.lit(1), rest).alias("left"),
        F.slice(parts, F.lit(2), rest).alias("right"),
        F.array_repeat(F.lit(sign), rest).alias("sign"),
    )


def _merged(symbols: Column, pairs: list[tuple[str, str]]) -> Column:
    for left, right in pairs:
        symbols = F.replace(symbols, F.lit(_marked(left) + _marked(right)), F.lit(_marked(left + right)))
    return symbols


def pair_counts(state: DataFrame, max_length: int = MAX_PIECE_LENGTH) -> DataFrame:
    """Adjacent symbol pairs and their counts; pairs too long for a piece are left out."""
    return (
        state.select("n", _parts(F.col("symbols")).alias("_parts"))
        .select("n", F.inline(_signed("_parts", 1)))
        .where(F.length("left") + F.length("right") <= max_length)
        .groupBy("left", "right")
        .agg(F.sum("n").alias("n"))
    )


def merge_pairs(state: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Joins every occurrence of the pairs, left to right."""
    return state.select(_merged(F.col("symbols"), pairs).alias("symbols"), "n")


def changed_pair_counts(
    counts: DataFrame, state: DataFrame, pairs: list[tuple[str, str]], max_length: int = MAX_PIECE_LENGTH
) -> DataFrame:
    """Pair counts after merging ``pairs`` in ``state``; only the words that hold one of them are taken apart."""
    symbols = F.col("symbols")
    holds = F.lit(False)
    for left, right in pairs:
        holds = holds | F.contains(symbols, F.lit(_marked(left) + _marked(right)))
    change = (
        state.where(holds)
        .select(
            F.col("n").alias("_n"),
            _parts(symbols).alias("_before"),
            _parts(_merged(symbols, pairs)).alias("_after"),
        )
        .select("_n", F.inline(F.concat(_signed("_before", -1), _signed("_after", 1))))
        .where(F.length("left") + F.length("right") <= max_length)
        .select("left", "right", (F.col("_n") * F.col("sign")).alias("n"))
    )
    return (
        counts.unionByName(change)
        .groupBy("left", "right")
        .agg(F.sum("n").alias("n"))
        .where("n > 0")
    )


def safe_prefix(
    ranked: list[tuple[str, str, int]], complete: bool, known: set[str] = frozenset()
) -> list[tuple[str, str]]:
    """How many of the best pairs can be merged in one round with the result of one at a time.

    A merge changes only counts of pairs that share one of its symbols, and a pair it
    makes occurs at most as often as the pair it came from. So the list may be followed
    until a pair shares a symbol with an earlier one, until a pair made by an earlier
    one could tie and sort before, or until ties could lie beyond the fetched list. A
    piece that was made before in another way (it is in ``known``) ends the round, as
    its pairs then add up.
    """
    taken: list[tuple[str, str]] = []
    used: set[str] = set()
    pieces = set(known)
    for at, (left, right, n) in enumerate(ranked):
        if at:
            if left in used or right in used:
                break
            if not complete and n == ranked[-1][2]:
                break
            tied = [(a, b) for a, b, m in ranked[at + 1 :] if m == n and (a in used or b in used)]
            made = {(a, x + y) for a, b in tied for x, y in taken if b == x}
            made |= {(x + y, b) for a, b in tied for x, y in taken if a == y}
            if any(pair < (left, right) for pair in made):
                break
        taken.append((left, right))
        if left == right or left + right in pieces:
            break
        used |= {left, right}
        pieces.add(left + right)
    return taken


def learn_bpe(
    counts: DataFrame, n_merges: int, horizon: int = 512, max_length: int = MAX_PIECE_LENGTH
) -> DataFrame:
    """Byte-pair merges in rank order: rank, left, right, piece, n, score = -rank.

    The pair with the highest count is merged first; on a tie the smaller pair. The
    state is the distinct words, never the corpus. Each round ranks the pairs on the
    executors, brings at most ``horizon`` of them to the driver, merges as many as
    leave the result unchanged, and recounts the pairs of the words that changed. The
    lineage is cut in the shared checkpoint folder.
    """
    spark = counts.sparkSession
    # an explicit number keeps the words spread over all cores in every later round
    parallel = spark.sparkContext.defaultParallelism
    state = saved(start_symbols(counts).repartition(parallel, "symbols"))
    pairs = saved(pair_counts(state, max_length))
    merges: list[tuple[int, str, str, str, int, float]] = []
    known: set[str] = set()
    while len(merges) < n_merges:
        top = pairs.orderBy(F.col("n").desc(), "left", "right").limit(horizon).collect()
        ranked = [(r["left"], r["right"], r["n"]) for r in top]
        if not ranked:
            break
        chosen = safe_prefix(ranked, len(ranked) < horizon, known)[: n_merges - len(merges)]
        known |= {left + right for left, right in chosen}
        for (left, right), (_, _, n) in zip(chosen, ranked):
            merges.append((len(merges), left, right, left + right, n, -float(len(merges))))
        before = pairs, state
        pairs = saved(changed_pair_counts(pairs, state, chosen, max_length))
        state = saved(merge_pairs(state, chosen))
        for table in before:  # superseded, so that disk use does not grow with the rounds
            discard(table)
    for table in (pairs, state):
        discard(table)
    return spark.createDataFrame(
        merges, "rank bigint, left string, right string, piece string, n bigint, score double"
    )


def build_vocabulary(merges: DataFrame, chars: DataFrame, spark: SparkSession) -> DataFrame:
    """Control pieces, merged pieces in rank order, then characters by frequency."""
    control = spark.createDataFrame(
        [(i, p, 0.0, t) for i, (p, t) in enumerate(CONTROL_PIECES)], "id bigint, piece string, score double, type int"
    )
    first = len(CONTROL_PIECES)
    learnt = (
        merges.groupBy("piece")
        .agg(F.min("rank").alias("rank"))
        .select(F.lit(0).alias("part"), F.col("rank").alias("at"), "piece")
    )
    single = chars.select(F.lit(1).alias("part"), F.col("rank").alias("at"), F.col("char").alias("piece"))
    # a vocabulary is a bounded table: its size is chosen by the caller
    ordered = Window.partitionBy(F.lit(0)).orderBy("part", "at")
    rest = learnt.unionByName(single).withColumn("_i", F.row_number().over(ordered) - 1)
    return control.unionByName(
        rest.select(
            (F.col("_i") + first).cast("bigint").alias("id"),
            "piece",
            (-F.col("_i")).cast("double").alias("score"),
            F.lit(NORMAL).alias("type"),
        )
    )


def learn_vocabulary(corpus: DataFrame, vocab_size: int, coverage: float = 1.0, text: str = "text") -> DataFrame:
    """A vocabulary of ``vocab_size`` pieces from raw text, in one pass over the corpus."""
    spark = corpus.sparkSession
    counts = saved(word_counts(corpus, text=text))
    chars = char_inventory(counts, coverage)
    n_merges = vocab_size - len(CONTROL_PIECES) - chars.count()
    if n_merges < 0:
        raise ValueError("the vocabulary is smaller than the character inventory")
    return build_vocabulary(learn_bpe(counts, n_merges), chars, spark)


# --- extension ------------------------------------------------------------------------------


def extend_vocab(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` plus every piece of ``new`` it lacks, in the order of ``new``, with continuing ids.

    Added pieces keep their new score; their type is normal.
    """
    last_id = old.agg(F.max("id")).first()[0]
    next_id = 0 if last_id is None else last_id + 1
    missing = new.join(old.select("piece"), "piece", "left_anti")
    placed = position_by(missing, [], "id", "_at")
    added = placed.select(
        (F.col("_at") + next_id).alias("id"), "piece", "score", F.lit(NORMAL).alias("type")
    )
    return old.select("id", "piece", "score", "type").unionByName(added)


def vocab_report(old: DataFrame, new: DataFrame, merged: DataFrame) -> DataFrame:
    """Sizes of the old, new and final vocabulary, and how many pieces were added."""
    tagged = [df.select(F.lit(name).alias("name")) for name, df in (("old", old), ("new", new), ("final", merged))]
    sizes = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    one = lambda name: F.count_if(F.col("name") == name)
    return sizes.agg(
        one("old").alias("old_size"),
        one("new").alias("new_size"),
        one("final").alias("final_size"),
        (one("final") - one("old")).alias("added"),
    )


def tokenizer_compare(corpus: DataFrame, vocabs: dict[str, DataFrame], by: list[str], text: str = "text") -> DataFrame:
    """Per vocabulary and group: tokens, tokens per word, characters per token."""
    measured = corpus.withColumns({"_words": F.size(words(F.col(text))), "_chars": F.length(text)})
    out = None
    for name, vocab in vocabs.items():
        tokens = tokenize(measured, vocab, keys=[*by, "_words", "_chars"], text=text)
        rows = tokens.groupBy(*by).agg(
            F.sum(F.size("input_ids")).cast("bigint").alias("tokens"),
            F.sum("_words").cast("bigint").alias("words"),
            F.sum("_chars").cast("bigint").alias("chars"),
        )
        rows = rows.select(
            F.lit(name).alias("vocabulary"),
            *by,
            "tokens",
            (F.col("tokens") / F.col("words")).alias("tokens_per_word"),
            (F.col("chars") / F.col("tokens")).alias("chars_per_token"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def extend_embeddings(emb: DataFrame, n_new: int, id_col: str = "id", vector: str = "embedding", chunk: int = 1024) -> DataFrame:
    """Adds ``n_new`` vectors with the ids that follow, each the mean of the old ones."""
    if n_new == 0:
        return emb.select(id_col, vector)
    kind = dict(emb.dtypes)[vector]
    means = (
        emb.select(id_col, F.posexplode(vector).alias("_pos", "_x"))
        .groupBy("_pos")
        .agg(F.avg(F.col("_x").cast("double")).alias("_mean"), F.max(id_col).alias("_last"))
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_mean"))).alias("_m"), F.max("_last").alias("_last"))
        .select(F.transform("_m", lambda m: m["_mean"]).cast(kind).alias(vector), "_last")
    )
    chunks = -(-n_new // chunk)
    starts = means.select(vector, "_last", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("_chunk"))
    if chunks > 1:
        starts = starts.repartition(chunks, "_chunk")
    first = F.col("_last") + 1 + F.col("_chunk") * chunk
    last = F.least(first + (chunk - 1), F.col("_last") + n_new)
    added = starts.select(F.explode(F.sequence(first, last).cast("array<bigint>")).alias(id_col), vector)
    return emb.select(id_col, vector).unionByName(added)

"""Corpus reading, tokenising, counting, packing, holdout."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyspark.functions.hashing import hash_unit
from polyspark.functions.text import characters, words
from polyspark.operators import corpus as C
from polyspark.operators import vocab as V
from polyspark.operators.tokens import tokenize
from polyspark.queries.common import hash_int_sql, hash_unit_sql, table, words_sql
from polyspark.session import saved
from polyspark.sources.corpus import read_corpus as read

BLOCK = 512
CORPUS_SEED = 7


def read_corpus(spark, sf):
    corpus = read(spark, f"{sf}/documents.parquet", keep=("lang",))
    return corpus.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).cast("bigint").alias("chars")
    )


READ_SQL = """
select lang, count(*)::BIGINT as rows, sum(length(text))::BIGINT as chars from documents group by lang"""


def word_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", words(F.col("text")).alias("input_ids"))


def tokenize_words(spark, sf):
    docs = table(spark, sf, "documents").withColumn("w", words(F.col("text")))
    return docs.select(
        "doc_id", F.size("w").cast("bigint").alias("n"), F.md5(F.array_join("w", "\x1f")).alias("tokens_md5")
    )


WORDS_SQL = f"""
select doc_id, len(w)::BIGINT as n, md5(array_to_string(w, chr(31))) as tokens_md5
from (select doc_id, {words_sql("text")} as w from documents)"""


def tokenize_characters(spark, sf):
    docs = table(spark, sf, "documents").withColumn("c", characters(F.col("text")))
    return docs.select(
        "doc_id", F.size("c").cast("bigint").alias("n"), F.md5(F.array_join("c", "\x1f")).alias("tokens_md5")
    )


CHARACTERS_SQL = """
select doc_id, len(c)::BIGINT as n, md5(array_to_string(c, chr(31))) as tokens_md5
from (select doc_id, regexp_extract_all(text, '(?s).') as c from documents)"""


def word_vocabulary(spark, sf):
    """Every word, by rank, after one unknown piece."""
    return V.word_vocabulary(saved(V.word_counts(table(spark, sf, "documents"))), first_id=1)


def tokenize_vocabulary(spark, sf):
    tokens = tokenize(table(spark, sf, "documents"), word_vocabulary(spark, sf), ["doc_id"], mode="word", special=(1, None))
    return tokens.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("n"),
        F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ",")).alias("ids_md5"),
    )


def tokenize_vocabulary_join(spark, sf):
    """The same through the join of distinct words, the way for a vocabulary too large to send."""
    tokens = tokenize(
        table(spark, sf, "documents"), word_vocabulary(spark, sf), ["doc_id"], mode="word", special=(1, None), broadcast_pieces=0
    )
    return tokens.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("n"),
        F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ",")).alias("ids_md5"),
    )


VOCABULARY_SQL = f"""
with w as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i
           from (select doc_id, {words_sql("text")} as w from documents)),
v as (select word, row_number() over (order by n desc, word) as id
      from (select word, count(*) as n from w group by word))
select doc_id, (count(*) + 1)::BIGINT as n,
       md5('1,' || string_agg(coalesce(id, 0)::VARCHAR, ',' order by i)) as ids_md5
from w left join v using (word) group by doc_id"""


def count_tokens(spark, sf):
    return C.count_tokens(word_tokens(spark, sf), ["lang", "source"])


COUNT_SQL = f"""
select lang, source, sum(len({words_sql("text")}))::BIGINT as tokens, count(*)::BIGINT as rows,
       grouping(lang, source)::BIGINT as level
from documents group by rollup (lang, source)"""


def pack_blocks(spark, sf):
    blocks = C.pack_blocks(word_tokens(spark, sf), "doc_id", BLOCK)
    return blocks.select(
        F.col("batch").cast("bigint"),
        F.col("block").cast("bigint"),
        F.size("input_ids").cast("bigint").alias("n"),
        F.md5(F.array_join("input_ids", "\x1f")).alias("tokens_md5"),
        (F.col("labels") == F.col("input_ids")).alias("same_labels"),
    )


PACK_SQL = f"""
with docs as (select *, (row_number() over (order by doc_id) - 1) // 1000 as batch from documents),
t as (select batch, doc_id, unnest(w) as tok, generate_subscripts(w, 1) as i
      from (select batch, doc_id, {words_sql("text")} as w from docs)),
p as (select batch, tok, row_number() over (partition by batch order by doc_id, i) - 1 as pos,
             count(*) over (partition by batch) as total from t)
select batch::BIGINT as batch, (pos // {BLOCK})::BIGINT as block, count(*)::BIGINT as n,
       md5(string_agg(tok, chr(31) order by pos)) as tokens_md5, true as same_labels
from p where total < {BLOCK} or pos < total // {BLOCK} * {BLOCK}
group by all"""


def holdout_split(spark, sf):
    split = C.holdout_split(table(spark, sf, "documents"), "doc_id", seed=CORPUS_SEED)
    return split.groupBy("lang", "split").agg(F.count(F.lit(1)).alias("rows"), F.sum("doc_id").cast("bigint").alias("id_sum"))


HOLDOUT_SQL = f"""
select lang, case when {hash_int_sql(str(CORPUS_SEED), "doc_id")} % 100 < 5 then 'validation' else 'train' end as split,
       count(*)::BIGINT as rows, sum(doc_id)::BIGINT as id_sum
from documents group by all"""


def limit_samples(spark, sf):
    split = C.holdout_split(table(spark, sf, "documents"), "doc_id", seed=CORPUS_SEED)
    return C.limit_samples(split, "doc_id", {"train": 100, "validation": None}, CORPUS_SEED).select("doc_id", "lang", "split")


LIMIT_SQL = f"""
with s as (
  select doc_id, lang, case when {hash_int_sql(str(CORPUS_SEED), "doc_id")} % 100 < 5 then 'validation' else 'train' end as split,
         md5(concat_ws(chr(31), '{CORPUS_SEED}', doc_id)) as h from documents),
o as (select *, row_number() over (partition by split order by h, doc_id) as k from s)
select doc_id, lang, split from o where split = 'validation' or k <= 100"""


def corpus_perplexity(spark, sf):
    losses = table(spark, sf, "documents").withColumn("loss", 5 * hash_unit(CORPUS_SEED, F.col("doc_id")))
    return losses.groupBy("lang").agg(
        F.round(C.corpus_perplexity(F.col("loss")), 6).alias("perplexity"),
        C.corpus_perplexity(F.col("loss") * 1000).alias("overflow"),
    )


PERPLEXITY_SQL = f"""
select lang, round(exp(avg(loss)), 6) as perplexity, 'Infinity'::DOUBLE as overflow
from (select lang, 5 * {hash_unit_sql(str(CORPUS_SEED), "doc_id")} as loss from documents) group by lang"""

QUERIES = {
    "read_corpus": (read_corpus, READ_SQL),
    "tokenize_words": (tokenize_words, WORDS_SQL),
    "tokenize_characters": (tokenize_characters, CHARACTERS_SQL),
    "tokenize_vocabulary": (tokenize_vocabulary, VOCABULARY_SQL),
    "tokenize_vocabulary_join": (tokenize_vocabulary_join, VOCABULARY_SQL),
    "count_tokens": (count_tokens, COUNT_SQL),
    "pack_blocks": (pack_blocks, PACK_SQL),
    "holdout_split": (holdout_split, HOLDOUT_SQL),
    "limit_samples": (limit_samples, LIMIT_SQL),
    "corpus_perplexity": (corpus_perplexity, PERPLEXITY_SQL),
}

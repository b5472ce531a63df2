"""Word counts, merges, vocabulary extension, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyspark.operators import vocab as V
from polyspark.operators.tokens import tokenize
from polyspark.queries.common import table, words_sql
from polyspark.session import saved

MERGES = 64
NEW_VECTORS = 100


def word_counts(spark, sf):
    return V.word_counts(table(spark, sf, "documents"), ["lang"])


WORDS_SQL = f"""
select lang, '▁' || word as word, count(*)::BIGINT as n
from (select lang, unnest({words_sql("text")}) as word from documents) group by all"""

CHARS = f"""
w as (select '▁' || word as word, count(*) as n from (select unnest({words_sql("text")}) as word from documents) group by all),
c as (select char, sum(n)::BIGINT as n from (select unnest(regexp_extract_all(word, '(?s).')) as char, n from w) group by char),
r as (select *, row_number() over (order by n desc, char) - 1 as rank,
             coalesce(sum(n) over (order by n desc, char rows between unbounded preceding and 1 preceding), 0) as before,
             sum(n) over () as total from c)"""


def char_inventory(spark, sf):
    return V.char_inventory(V.word_counts(table(spark, sf, "documents")), 0.995)


CHARS_SQL = f"""
with {CHARS}
select rank::BIGINT as rank, char, n::BIGINT as n from r where before::DOUBLE / total::DOUBLE < 0.995::DOUBLE"""


def learn_bpe(spark, sf):
    merges = V.learn_bpe(V.word_counts(table(spark, sf, "documents")), MERGES)
    return merges.select("rank", "left", "right", "piece", "n", "score")


def vocabularies(spark, sf):
    """Old: the words of English documents; new: those of all documents."""
    docs = table(spark, sf, "documents")
    english, every = saved(V.word_counts(docs.where("lang = 'en'"))), saved(V.word_counts(docs))
    return saved(V.word_vocabulary(english)), saved(V.word_vocabulary(every))


VOCABULARIES_SQL = f"""
w as (select lang, '▁' || word as word from (select lang, unnest({words_sql("text")}) as word from documents)),
old as (select row_number() over (order by n desc, word) - 1 as id, word as piece
        from (select word, count(*) as n from w where lang = 'en' group by word)),
new as (select row_number() over (order by n desc, word) - 1 as id, word as piece
        from (select word, count(*) as n from w group by word)),
merged as (
  select id, piece, -id::DOUBLE as score from old
  union all
  select (select max(id) from old) + row_number() over (order by id), piece, -id::DOUBLE
  from new where piece not in (select piece from old))"""


def extend_vocab(spark, sf):
    return V.extend_vocab(*vocabularies(spark, sf))


EXTEND_SQL = f"""
with {VOCABULARIES_SQL}
select id::BIGINT as id, piece, score, 1::INT as type from merged"""


def vocab_report(spark, sf):
    old, new = vocabularies(spark, sf)
    return V.vocab_report(old, new, V.extend_vocab(old, new))


REPORT_SQL = f"""
with {VOCABULARIES_SQL}
select (select count(*) from old)::BIGINT as old_size, (select count(*) from new)::BIGINT as new_size,
       (select count(*) from merged)::BIGINT as final_size,
       ((select count(*) from merged) - (select count(*) from old))::BIGINT as added"""


def learnt_vocabulary(spark, sf):
    counts = saved(V.word_counts(table(spark, sf, "documents")))
    return V.build_vocabulary(V.learn_bpe(counts, MERGES), V.char_inventory(counts, 1.0), spark)


def tokenize_bpe(spark, sf):
    """Token ids of every document under a learnt vocabulary."""
    tokens = tokenize(table(spark, sf, "documents"), learnt_vocabulary(spark, sf), ["doc_id"])
    return tokens.select("doc_id", F.size("input_ids").cast("bigint").alias("n"), F.array_max("input_ids").alias("max_id"))


def tokenizer_compare(spark, sf):
    docs = table(spark, sf, "documents")
    english = saved(V.word_counts(docs.where("lang = 'en'")))
    old = saved(V.build_vocabulary(V.learn_bpe(english, MERGES), V.char_inventory(english, 1.0), spark))
    merged = V.extend_vocab(old, learnt_vocabulary(spark, sf))
    return V.tokenizer_compare(docs, {"old": old, "merged": merged}, ["lang"])


def extend_embeddings(spark, sf):
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    out = V.extend_embeddings(emb, NEW_VECTORS)
    return out.select(
        "id",
        F.size("embedding").cast("bigint").alias("dim"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"),
        F.round(F.element_at("embedding", 1).cast("double"), 5).alias("first"),
    )


EMBEDDINGS_SQL = f"""
with e as (select vec_id as id, unnest(embedding)::DOUBLE as x, generate_subscripts(embedding, 1) as pos from embeddings),
m as (select pos, avg(x)::FLOAT::DOUBLE as x from e group by pos),
n as (select (select max(vec_id) from embeddings) + 1 + i as id, pos, x from m, (select unnest(range({NEW_VECTORS})) as i)),
a as (select * from n union all select id, pos, x from e)
select id::BIGINT as id, count(*)::BIGINT as dim, round(sum(x), 4) as total, round(sum(case when pos = 1 then x end), 5) as first
from a group by id"""

QUERIES = {
    "word_counts": (word_counts, WORDS_SQL),
    "char_inventory": (char_inventory, CHARS_SQL),
    "learn_bpe": (learn_bpe, None),
    "extend_vocab": (extend_vocab, EXTEND_SQL),
    "vocab_report": (vocab_report, REPORT_SQL),
    "tokenize_bpe": (tokenize_bpe, None),
    "tokenizer_compare": (tokenizer_compare, None),
    "extend_embeddings": (extend_embeddings, EMBEDDINGS_SQL),
}

"""Windows, truncation, batches, deduplication, cache, scorers, responses."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from polyspark.functions.hashing import hash_hex, hash_unit
from polyspark.functions.text import has_words, words
from polyspark.operators import prompts as P
from polyspark.operators import scoring as S
from polyspark.queries import common as Q
from polyspark.session import checkpoint_dir

MAX_LEN, CTX_LEN = 128, 32
PREFIX, PAD = "<s>", "<pad>"
BATCH = 32


def _tokens(spark, sf):
    return Q.table(spark, sf, "documents").select("doc_id", "lang", words(F.col("text")).alias("tokens"))


def _windows(spark, sf):
    return S.rolling_windows(_tokens(spark, sf), "tokens", MAX_LEN, CTX_LEN, F.lit(PREFIX), ["doc_id"])


def _shown(df):
    return df.select(
        "doc_id",
        F.col("window_idx").cast("bigint"),
        F.size("ctx").cast("bigint").alias("n_ctx"),
        F.size("cont").cast("bigint").alias("n_cont"),
        F.md5(F.array_join("ctx", " ")).alias("ctx_md5"),
        F.md5(F.array_join("cont", " ")).alias("cont_md5"),
    )


def rolling_windows(spark, sf):
    return _shown(_windows(spark, sf))


STEP = MAX_LEN - CTX_LEN + 1
WINDOWS_SQL = f"""
t as (select doc_id, {Q.words_sql("text")} as w from documents),
n as (select doc_id, w, len(w) as n, least({MAX_LEN}, len(w)) as first from t where len(w) > 0),
i as (select *, unnest(range((ceil((n - first) / {STEP}.0))::BIGINT + 1)) as window_idx from n),
b as (select *, case when window_idx = 0 then 0 else first + (window_idx - 1) * {STEP} end as lo,
             least(n, first + window_idx * {STEP}) as hi from i),
win as (select doc_id, window_idx,
               case when window_idx = 0 then list_concat(['{PREFIX}'], w[1:first - 1]) else w[hi - {MAX_LEN}:hi - 1] end as ctx,
               w[lo + 1:hi] as cont from b)"""
SHOWN_SQL = """
select doc_id, window_idx::BIGINT as window_idx, len(ctx)::BIGINT as n_ctx, len(cont)::BIGINT as n_cont,
       md5(array_to_string(ctx, ' ')) as ctx_md5, md5(array_to_string(cont, ' ')) as cont_md5 from """


def disjoint_windows(spark, sf):
    return _shown(S.disjoint_windows(_windows(spark, sf)))


DISJOINT_SQL = (
    Q.with_sql(WINDOWS_SQL, "\nd as (select doc_id, window_idx, ctx[1:len(ctx) - (len(cont) - 1)] as ctx, cont from win)")
    + SHOWN_SQL
    + "d"
)


def pad_windows(spark, sf):
    return _shown(S.pad_windows(S.disjoint_windows(_windows(spark, sf)), F.lit(PAD), MAX_LEN, ["doc_id"]))


def _list_of_pads(n: str) -> str:
    return f"list_transform(range(greatest({n}, 0)), lambda x: '{PAD}')"


PAD_SQL = (
    Q.with_sql(
        WINDOWS_SQL,
        f"""
d as (select doc_id, window_idx, ctx[1:len(ctx) - (len(cont) - 1)] as ctx, cont from win),
l as (select *, max(window_idx) over (partition by doc_id) as last,
             last_value(len(ctx)) over (partition by doc_id order by window_idx
                                        rows between unbounded preceding and unbounded following) as size from d),
p as (select doc_id, window_idx,
             case when window_idx = last and len(ctx) = 0 then ['{PAD}']
                  when window_idx < last and size > 1 then list_concat(ctx, {_list_of_pads("size - len(ctx)")})
                  else ctx end as ctx,
             case when window_idx = last and last > 0 then list_concat(cont, {_list_of_pads(f"{MAX_LEN} - len(cont)")})
                  else cont end as cont from l)""",
    )
    + SHOWN_SQL
    + "p"
)


def truncate_left(spark, sf):
    pairs = Q.generation_pairs(spark, sf).withColumns({"c": words(F.col("source")), "t": words(F.col("reference"))})
    cut = pairs.select("conv_id", "turn", *[c.alias(n) for n, c in S.truncate_left(F.col("c"), F.col("t"), 48).items()],
                       S.truncate_for_generation(F.col("c"), 48, 16).alias("generation_input"))
    joined = {n: F.array_join(n, " ") for n in ("input", "api_input", "generation_input")}
    return cut.withColumns({**joined, "ctx_len": F.col("ctx_len").cast("bigint")})


TRUNCATE_SQL = Q.with_sql(Q.PAIRS_SQL, f"""
t as (select conv_id, turn, {Q.words_sql("source")} as c, {Q.words_sql("reference")} as t from pairs),
f as (select *, list_concat(c, t) as x, greatest(len(c) + len(t) - 49, 0) as lo from t)""") + """
select conv_id, turn, array_to_string(x[lo + 1:len(x) - 1], ' ') as input, array_to_string(x[lo + 1:], ' ') as api_input,
       (len(c) - lo)::BIGINT as ctx_len, array_to_string(c[greatest(len(c) - 32, 0) + 1:], ' ') as generation_input from f"""


def _batched(spark, sf):
    docs = _tokens(spark, sf).select("doc_id", F.size("tokens").alias("length"), hash_hex(F.col("doc_id")).alias("h"))
    return S.length_batches(docs, "length", "h", BATCH)


def length_batches(spark, sf):
    return _batched(spark, sf).select(
        "doc_id", F.col("length").cast("bigint"), F.col("batch").cast("bigint"), F.col("padded_length").cast("bigint")
    )


BATCHES_SQL = f"""
b as (select doc_id, n as length, (row_number() over (order by -n, h) - 1) // {BATCH} as batch
      from (select doc_id, len({Q.words_sql("text")}) as n, md5(doc_id::VARCHAR) as h from documents)),
p as (select *, max(length) over (partition by batch) as padded_length from b)"""
LENGTH_SQL = f"with {BATCHES_SQL} select doc_id, length::BIGINT as length, batch::BIGINT as batch, padded_length::BIGINT as padded_length from p"


def padding_report(spark, sf):
    report = S.padding_report(_batched(spark, sf), "length")
    return report.withColumn("padding_share", F.round("padding_share", 6))


PADDING_SQL = f"""
with {BATCHES_SQL}
select count(*)::BIGINT as requests, count(distinct batch)::BIGINT as batches, sum(length)::BIGINT as tokens,
       sum(padded_length)::BIGINT as padded_tokens, round(1 - sum(length)::DOUBLE / sum(padded_length)::DOUBLE, 6) as padding_share
from p"""


def select_continuation(spark, sf):
    """Source and reference stand for a prompt and what a left-padded batch returned."""
    pairs = Q.generation_pairs(spark, sf).withColumns(
        {"ctx": words(F.col("source")), "generated": F.concat(words(F.col("source")), words(F.col("reference")))}
    )
    batched = pairs.withColumn("batch", F.floor(F.col("conv_id") / 8))
    return S.select_continuation(batched, "batch", "ctx", "generated").select(
        "conv_id", "turn", F.array_join("continuation", " ").alias("continuation")
    )


CONTINUATION_SQL = Q.with_sql(Q.PAIRS_SQL, f"""
t as (select conv_id, turn, {Q.words_sql("source")} as c, list_concat({Q.words_sql("source")}, {Q.words_sql("reference")}) as g from pairs),
m as (select *, max(len(c)) over (partition by conv_id // 8) as longest from t)""") + """
select conv_id, turn, array_to_string(g[longest + 1:], ' ') as continuation from m"""


def _zero_shot_requests(spark, sf):
    return P.choice_requests(Q.with_context(spark, sf, 0))


def dedup_requests(spark, sf):
    unique = S.dedup_requests(_zero_shot_requests(spark, sf))
    return unique.select("request_key", "cont", F.md5("ctx").alias("ctx_md5"), "origins")


KEY_SQL = "sha256(concat_ws(chr(31), 'loglikelihood', ctx, cont, chr(30)))"
ZERO_REQUESTS = [Q.RENDERED_SQL, "\nz as (select *, text_prompt as ctx from r)", Q.CHOICES_SQL, Q.requests_sql("z")]
DEDUP_SQL = Q.with_sql(*ZERO_REQUESTS) + f"""
select {KEY_SQL} as request_key, cont, md5(ctx) as ctx_md5, count(*)::BIGINT as origins from requests group by all"""


def scatter_back(spark, sf):
    """Each distinct request scored once, the score back on every request."""
    requests = _zero_shot_requests(spark, sf)
    requests = requests.withColumn("request_key", S.request_key(requests))
    scored = S.score_dummy(S.dedup_requests(requests)).select("request_key", "origins", "ll")
    return S.scatter_back(requests, scored, ["doc_id", "req_idx"]).select(
        "doc_id", F.col("req_idx").cast("bigint"), "request_key", F.round("ll", 9).alias("ll"), "origins"
    )


SCATTER_SQL = Q.with_sql(*ZERO_REQUESTS, Q.SCORED_SQL) + f"""
select doc_id, req_idx::BIGINT as req_idx, {KEY_SQL} as request_key, round(ll, 9) as ll,
       count(*) over (partition by ctx, cont)::BIGINT as origins from scored"""


def cached_scores(spark, sf):
    """Scores of all requests after the English ones were already in the cache."""
    cache = f"{checkpoint_dir(spark)}/scores-{uuid.uuid4().hex}"
    requests = _zero_shot_requests(spark, sf)
    S.cached_scores(requests.where("lang = 'en'"), cache, S.score_dummy, ["doc_id", "req_idx"])
    return S.cached_scores(requests, cache, S.score_dummy, ["doc_id", "req_idx"]).select(
        "doc_id", F.col("req_idx").cast("bigint"), F.round("ll", 9).alias("ll")
    )


CACHED_SQL = Q.with_sql(*ZERO_REQUESTS, Q.SCORED_SQL) + "select doc_id, req_idx::BIGINT as req_idx, round(ll, 9) as ll from scored"


def score_dummy(spark, sf):
    scored = S.score_dummy(P.choice_requests(Q.with_context(spark, sf)))
    return scored.select("lang", "doc_id", F.col("req_idx").cast("bigint"), F.round("ll", 9).alias("ll"), "is_greedy")


DUMMY_SQL = Q.with_sql(
    Q.RENDERED_SQL, Q.FEWSHOT_SQL, Q.CONTEXT_SQL, Q.CHOICES_SQL, Q.requests_sql("ctx"), Q.SCORED_SQL
) + "select lang, doc_id, req_idx::BIGINT as req_idx, round(ll, 9) as ll, false as is_greedy from scored"


def _batch_model(batch: pd.DataFrame) -> pd.DataFrame:
    """A model stand-in: longer continuations score lower, contexts that end like them higher."""
    ll = -batch["cont"].str.len() - batch["ctx"].str.len() % 7 / 10
    return pd.DataFrame({"ll": ll.astype(float), "is_greedy": batch["cont"].str.len() < 4, "generated": None})


def score_with(spark, sf):
    requests = S.dedup_requests(_zero_shot_requests(spark, sf))
    scored = S.score_with(requests, _batch_model)
    return scored.select("request_key", F.round("ll", 6).alias("ll"), "is_greedy")


SCORE_WITH_SQL = Q.with_sql(*ZERO_REQUESTS) + f"""
select distinct {KEY_SQL} as request_key, round((-length(cont))::DOUBLE - (length(ctx) % 7) / 10.0::DOUBLE, 6) as ll,
       length(cont) < 4 as is_greedy from requests"""


def lm_docs(spark, sf, with_words=False):
    """Documents as lists of words; ``with_words``: only those that have any."""
    docs = Q.table(spark, sf, "documents")
    docs = docs.where(has_words(F.col("text"))) if with_words else docs
    return docs.select("lang", "doc_id", words(F.lower("text")).alias("tokens"))


def train_ngram_lm(spark, sf):
    lm = S.train_ngram_lm(lm_docs(spark, sf), ["lang"], "tokens")
    return S.ngram_table(lm, ["lang"])


NGRAM_SQL = f"""
t as (select lang, doc_id, {Q.words_sql("lower(text)")} as w from documents),
p as (select lang, doc_id, unnest(list_concat(['<s>'], w[1:len(w) - 1])) as w1, unnest(w) as w2 from t where len(w) > 0),
bi as (select lang, w1, w2, count(*) as n_pair from p group by all),
ctx as (select lang, w1, count(*) as n_ctx from p group by all),
uni as (select lang, w2, count(*) as n_word from p group by all),
tot as (select lang, sum(n_word) as n_all, count(*) as n_vocab from uni group by all)"""
TRAIN_SQL = f"with {NGRAM_SQL} select lang, w1, w2, n_pair::BIGINT as n_pair, n_ctx::BIGINT as n_ctx from bi join ctx using (lang, w1)"


def _score_docs(spark, sf, order):
    docs = lm_docs(spark, sf)
    lm = S.train_ngram_lm(docs, ["lang"], "tokens")
    return S.score_ngram(lm, docs, ["lang"], ["doc_id"], "tokens", order=order)


def score_bigram(spark, sf):
    return _score_docs(spark, sf, 2).select("lang", "doc_id", F.round("ll", 4).alias("ll"), "n_tokens")


BIGRAM_SQL = f"""
with {NGRAM_SQL}
select lang, doc_id, round(sum(ln((n_pair + 0.5::DOUBLE) / (n_ctx + 0.5::DOUBLE * (n_vocab + 1)))), 4) as ll, count(*)::BIGINT as n_tokens
from p join bi using (lang, w1, w2) join ctx using (lang, w1) join tot using (lang) group by all"""


def score_unigram(spark, sf):
    return _score_docs(spark, sf, 1).select("lang", "doc_id", F.round("ll", 4).alias("ll"), "n_tokens")


UNIGRAM_SQL = f"""
with {NGRAM_SQL}
select lang, doc_id, round(sum(ln((n_word + 0.5::DOUBLE) / (n_all + 0.5::DOUBLE * (n_vocab + 1)))), 4) as ll, count(*)::BIGINT as n_tokens
from p join uni using (lang, w2) join tot using (lang) group by all"""


def reduce_logprobs(spark, sf):
    """Words of each benchmark item as tokens; each has two candidates, one of them itself."""
    items = Q.table(spark, sf, "benchmark").withColumn("tokens", words(F.col("text")))
    own = lambda t, i: -hash_unit(F.col("item_id"), i, t, F.lit("own"))
    other = lambda t, i: -hash_unit(F.col("item_id"), i, t, F.lit("other"))
    items = items.withColumns(
        {
            "token_logprobs": F.transform("tokens", own),
            "top_logprobs": F.transform(
                "tokens",
                lambda t, i: F.map_from_arrays(
                    F.array(t, F.concat(t, F.lit("_"))),
                    F.array(own(t, i), F.when(i % 8 == 0, other(t, i)).otherwise(-1.0)),
                ),
            ),
        }
    )
    reduced = S.reduce_logprobs(
        F.col("token_logprobs"), F.col("tokens"), F.col("top_logprobs"), F.size("tokens") - F.lit(12)
    )
    return items.select("item_id", F.round(reduced["ll"], 6).alias("ll"), reduced["is_greedy"].alias("is_greedy"))


LOGPROBS_SQL = f"""
with t as (select item_id, unnest(w) as tok, generate_subscripts(w, 1) - 1 as i, len(w) as n
           from (select item_id, {Q.words_sql("text")} as w from benchmark)),
l as (select *, -{Q.hash_unit_sql("item_id", "i", "tok", "'own'")} as own,
             case when i % 8 = 0 then -{Q.hash_unit_sql("item_id", "i", "tok", "'other'")} else -1.0::DOUBLE end as other from t)
select item_id, round(sum(own), 6) as ll, bool_and(own >= other) as is_greedy from l where i >= n - 12 group by item_id"""


def rolling_loglikelihood(spark, sf):
    """Windows of each document scored by the stand-in scorer and summed."""
    windows = _windows(spark, sf).withColumns({"ctx": F.array_join("ctx", " "), "cont": F.array_join("cont", " ")})
    scored = windows.withColumn("ll", -hash_unit(F.col("ctx"), F.col("cont")))
    return S.rolling_loglikelihood(scored, ["doc_id"]).select("doc_id", F.round("ll", 6).alias("ll"))


ROLLING_SQL = Q.with_sql(WINDOWS_SQL) + f"""
select doc_id, round(sum(-{Q.hash_unit_sql("array_to_string(ctx, ' ')", "array_to_string(cont, ' ')")}), 6) as ll from win group by doc_id"""


def cut_at_stop(spark, sf):
    pairs = Q.generation_pairs(spark, sf).withColumn("k", F.col("turn") % 4 - 1)
    stops = F.array(F.lit("\n"), F.lit(". "))
    cut = S.cut_generation(F.col("reference"), stops, F.col("k"), "<eos>")
    return pairs.select("conv_id", "turn", cut.alias("cut"))


CUT_SQL = Q.with_sql(Q.PAIRS_SQL) + """
select conv_id, turn, case when turn % 4 = 1 then reference
  else split_part(split_part(reference, chr(10), 1), '. ', 1) end as cut from pairs"""


def collect_doc_results(spark, sf):
    scored = S.score_dummy(_zero_shot_requests(spark, sf))
    results = S.collect_doc_results(scored, ["doc_id"], ["choice", "ll"])
    ordered = F.aggregate("results", F.lit(0.0), lambda s, r: s * 0.5 + r["ll"])  # tells orders apart
    return results.select(
        "doc_id", F.array_join(F.col("results").getField("choice"), ",").alias("choices"), F.round(ordered, 9).alias("ordered")
    )


COLLECT_SQL = Q.with_sql(
    Q.RENDERED_SQL, "\nctx as (select *, text_prompt as ctx from r)", Q.CHOICES_SQL, Q.requests_sql("ctx"), Q.SCORED_SQL
) + """select doc_id, string_agg(choice, ',' order by req_idx) as choices,
  round(((max(ll) filter (req_idx = 0) * 0.5 + max(ll) filter (req_idx = 1)) * 0.5 + max(ll) filter (req_idx = 2)) * 0.5
        + max(ll) filter (req_idx = 3), 9) as ordered
from scored group by doc_id"""

QUERIES = {
    "rolling_windows": (rolling_windows, Q.with_sql(WINDOWS_SQL) + SHOWN_SQL + "win"),
    "disjoint_windows": (disjoint_windows, DISJOINT_SQL),
    "pad_windows": (pad_windows, PAD_SQL),
    "truncate_left": (truncate_left, TRUNCATE_SQL),
    "length_batches": (length_batches, LENGTH_SQL),
    "padding_report": (padding_report, PADDING_SQL),
    "select_continuation": (select_continuation, CONTINUATION_SQL),
    "dedup_requests": (dedup_requests, DEDUP_SQL),
    "scatter_back": (scatter_back, SCATTER_SQL),
    "cached_scores": (cached_scores, CACHED_SQL),
    "score_dummy": (score_dummy, DUMMY_SQL),
    "score_with": (score_with, SCORE_WITH_SQL),
    "train_ngram_lm": (train_ngram_lm, TRAIN_SQL),
    "score_bigram": (score_bigram, BIGRAM_SQL),
    "score_unigram": (score_unigram, UNIGRAM_SQL),
    "reduce_logprobs": (reduce_logprobs, LOGPROBS_SQL),
    "rolling_loglikelihood": (rolling_loglikelihood, ROLLING_SQL),
    "cut_at_stop": (cut_at_stop, CUT_SQL),
    "collect_doc_results": (collect_doc_results, COLLECT_SQL),
}

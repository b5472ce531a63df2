"""Per-document metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyspark.functions.text import count_bytes, count_words, segment_unspaced
from polyspark.functions.text import detokenize as detok
from polyspark.operators import doc_metrics as M
from polyspark.operators import prompts as P
from polyspark.operators import scoring as S
from polyspark.queries import common as Q
from polyspark.queries.scoring import NGRAM_SQL, lm_docs

PAIR = ["conv_id", "turn"]


def picked_docs(spark, sf, k=0, templates=(Q.LANGID,)):
    scored = S.score_dummy(P.choice_requests(Q.with_context(spark, sf, k, templates)))
    return M.pick_choice(scored, [*P.BY, "doc_id"])


def pick_choice(spark, sf):
    return picked_docs(spark, sf).select("lang", "doc_id", "pred", "target", "acc", "acc_norm")


PICK_SQL = Q.ZERO_SHOT_SQL + """
select lang, doc_id, pred, target, (pred = target)::INT::DOUBLE as acc, (norm_pred = target)::INT::DOUBLE as acc_norm from picked"""


def rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


FIGURES = ["precision", "recall", "fmeasure"]


def rouge_n(spark, sf):
    scores = M.rouge_n(Q.generation_pairs(spark, sf), PAIR, [1, 2], stemmed=False)
    return rounded(scores, FIGURES).withColumn("n", F.col("n").cast("bigint"))


def gram_sql(tokens: str, n: str) -> str:
    return f"list_transform(range(1, greatest(len({tokens}) - {n} + 2, 1)), lambda i: array_to_string({tokens}[i:i + {n} - 1], ' '))"


def rouge_tokens_sql(text: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"


def rouge_counts_sql(source: str, keys: str) -> str:
    """Hits and sizes per pair and order; every pair has a row."""
    return f"""
tok as (select {keys}, n, {rouge_tokens_sql("ref")} as r, {rouge_tokens_sql("pred")} as p
        from {source}, (select unnest([1, 2]) as n)),
gr as (select {keys}, n, g, count(*) as c from (select {keys}, n, unnest({gram_sql("r", "n")}) as g from tok) group by all),
gp as (select {keys}, n, g, count(*) as c from (select {keys}, n, unnest({gram_sql("p", "n")}) as g from tok) group by all),
hits as (select {keys}, n, sum(least(gr.c, gp.c)) as hits from gr join gp using ({keys}, n, g) group by all),
pr as (select {keys}, n, coalesce(hits, 0)::DOUBLE / greatest(len(p) - n + 1, 1) as precision,
              coalesce(hits, 0)::DOUBLE / greatest(len(r) - n + 1, 1) as recall
       from tok left join hits using ({keys}, n)),
sc as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as fmeasure from pr)"""


ROUGE_SQL = Q.with_sql(
    Q.PAIRS_SQL, "\none as (select conv_id, turn, reference as ref, prediction as pred from pairs)", rouge_counts_sql("one", "conv_id, turn")
) + """
select conv_id, turn, n::BIGINT as n, round(precision, 6) as precision, round(recall, 6) as recall, round(fmeasure, 6) as fmeasure from sc"""


def rouge_l(spark, sf):
    scores = M.rouge_l(Q.generation_pairs(spark, sf), PAIR)
    return scores.select(
        *PAIR, *[F.round(f"{k}.{f}", 6).alias(f"{k}_{f}") for k in ("rougeL", "rougeLsum") for f in FIGURES]
    )


def rouge_l_plain(spark, sf):
    """ROUGE-L without stems of each reply against its reference and against the turn before it."""
    pairs = Q.generation_pairs(spark, sf).select(*PAIR, "prediction", F.posexplode("references").alias("ref_idx", "reference"))
    scores = M.rouge_l(pairs, [*PAIR, "ref_idx"], stemmed=False)
    return scores.select(
        *PAIR, F.col("ref_idx").cast("bigint").alias("ref_idx"), *[F.round(f"rougeL.{f}", 6).alias(f) for f in FIGURES]
    )


# A row of the table holds the subsequence lengths after each word of the prediction; one round is one reference word.
ROUGE_L_SQL = Q.with_sql(
    Q.PAIRS_SQL,
    f"""
tok as (select conv_id, turn, i as ref_idx, {rouge_tokens_sql("refs[i + 1]")} as r, {rouge_tokens_sql("prediction")} as p
        from pairs, (select unnest([0, 1]) as i)),
step as (
  select conv_id, turn, ref_idx, r, p, 0 as word, list_transform(range(0, len(p)), lambda j: 0) as lengths from tok
  union all
  select conv_id, turn, ref_idx, r, p, word + 1,
         list_transform(range(1, len(p) + 1), lambda j: list_max(kept[1:j]))
  from (select *, list_transform(range(1, len(p) + 1), lambda j:
                    case when p[j] = r[word + 1] then coalesce(lengths[j - 1], 0) + 1 else lengths[j] end) as kept
        from step where word < len(r))),
pr as (select conv_id, turn, ref_idx, coalesce(lengths[len(p)], 0)::DOUBLE / greatest(len(p), 1) as precision,
              coalesce(lengths[len(p)], 0)::DOUBLE / greatest(len(r), 1) as recall
       from step where word = len(r))""",
).replace("with ", "with recursive ", 1) + """
select conv_id, turn, ref_idx::BIGINT as ref_idx, round(precision, 6) as precision, round(recall, 6) as recall,
       round(case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end, 6) as fmeasure
from pr"""


def rouge_all(spark, sf):
    """The twelve stemmed figures, against the reference and the source as two references."""
    return M.rouge(Q.generation_pairs(spark, sf), PAIR)


def rouge_multi_ref(spark, sf):
    pairs = Q.generation_pairs(spark, sf).select(*PAIR, "prediction", F.posexplode("references").alias("ref_idx", "reference"))
    scores = M.rouge_n(pairs, [*PAIR, "ref_idx"], [1, 2], stemmed=False)
    return rounded(M.rouge_multi_ref(scores, [*PAIR, "n"]), FIGURES).withColumn("n", F.col("n").cast("bigint"))


MULTI_SQL = Q.with_sql(
    Q.PAIRS_SQL,
    "\none as (select conv_id, turn, i as ref_idx, refs[i + 1] as ref, prediction as pred from pairs, (select unnest([0, 1]) as i))",
    rouge_counts_sql("one", "conv_id, turn, ref_idx"),
    """
loo as (select l.conv_id, l.turn, l.n, l.ref_idx as left_out,
               arg_max({'p': o.precision, 'r': o.recall, 'f': o.fmeasure}, (o.fmeasure, -o.ref_idx)) as best
        from sc l join sc o on l.conv_id = o.conv_id and l.turn = o.turn and l.n = o.n and l.ref_idx <> o.ref_idx group by all)""",
) + """
select conv_id, turn, n::BIGINT as n, round(avg(best.p), 6) as precision, round(avg(best.r), 6) as recall, round(avg(best.f), 6) as fmeasure
from loo group by all"""


def max_over_refs(spark, sf):
    pairs = Q.generation_pairs(spark, sf).select(*PAIR, "prediction", F.posexplode("references").alias("ref_idx", "reference"))
    scores = M.rouge_n(pairs, [*PAIR, "ref_idx"], [1], stemmed=False)
    return rounded(M.max_over_refs(scores, PAIR, "fmeasure"), ["fmeasure"])


MAX_SQL = Q.with_sql(
    Q.PAIRS_SQL,
    "\none as (select conv_id, turn, i as ref_idx, refs[i + 1] as ref, prediction as pred from pairs, (select unnest([0, 1]) as i))",
    rouge_counts_sql("one", "conv_id, turn, ref_idx"),
) + "select conv_id, turn, round(max(fmeasure), 6) as fmeasure from sc where n = 1 group by all"


def sari(spark, sf):
    return rounded(M.sari(Q.generation_pairs(spark, sf), PAIR), ["sari"])


SARI_SQL = Q.with_sql(Q.PAIRS_SQL, f"""
base as (select conv_id, turn, n, string_split(lower(source), ' ') as s, string_split(lower(prediction), ' ') as c,
                string_split(lower(reference), ' ') as r1, string_split(lower(source), ' ') as r2, 2 as m
         from pairs, (select unnest([1, 2, 3, 4]) as n)),
sides as (
  select conv_id, turn, n, m, unnest({gram_sql("s", "n")}) as g, 's' as side from base
  union all select conv_id, turn, n, m, unnest({gram_sql("c", "n")}), 'c' from base
  union all select conv_id, turn, n, m, unnest({gram_sql("r1", "n")}), 'r' from base
  union all select conv_id, turn, n, m, unnest({gram_sql("r2", "n")}), 'r' from base),
cnt as (select conv_id, turn, n, g, (count(*) filter (side = 's')) * m as s, (count(*) filter (side = 'c')) * m as c,
               count(*) filter (side = 'r') as r from sides group by conv_id, turn, n, m, g),
al as (select *, least(s, c) as keep, least(s, r) as keep_all, least(s, c, r) as keep_good, greatest(s - c, 0) as del,
              greatest(greatest(s - c, 0) - r, 0) as del_good from cnt),
fig as (select conv_id, turn, n,
   coalesce(sum(keep_good::DOUBLE / keep) filter (keep > 0) / nullif(count(*) filter (keep > 0), 0), 0) as kp,
   coalesce(sum(keep_good::DOUBLE / keep_all) filter (keep_all > 0) / nullif(count(*) filter (keep_all > 0), 0), 0) as kr,
   coalesce(sum(del_good::DOUBLE / del) filter (del > 0) / nullif(count(*) filter (del > 0), 0), 0) as dp,
   coalesce((count(*) filter (c > 0 and s = 0 and r > 0))::DOUBLE / nullif(count(*) filter (c > 0 and s = 0), 0), 0) as ap,
   coalesce((count(*) filter (c > 0 and s = 0 and r > 0))::DOUBLE / nullif(count(*) filter (r > 0 and s = 0), 0), 0) as ar
   from al group by all)""") + """
select conv_id, turn, round(sum(case when kp + kr > 0 then 2 * kp * kr / (kp + kr) else 0 end + dp
                                + case when ap + ar > 0 then 2 * ap * ar / (ap + ar) else 0 end) / 12, 6) as sari
from fig group by all"""


def _rolling(spark, sf):
    """Documents that have words with their sizes and the summed bigram score of their words."""
    docs = lm_docs(spark, sf, with_words=True)
    lm = S.train_ngram_lm(docs, ["lang"], "tokens")
    scores = S.score_ngram(lm, docs, ["lang"], ["doc_id"], "tokens").select("doc_id", "ll")
    return M.text_sizes(Q.langid_docs(spark, sf)).drop("text").join(scores, "doc_id")


def count_words_bytes(spark, sf):
    docs = Q.table(spark, sf, "documents")
    return docs.select("doc_id", count_words(F.col("text")).alias("words"), count_bytes(F.col("text")).alias("bytes"))


COUNT_SQL = f"select doc_id, len({Q.space_split_sql('text')})::BIGINT as words, strlen(text)::BIGINT as bytes from documents"


def perplexity_parts(spark, sf):
    parts = M.perplexity_parts(_rolling(spark, sf), text=None)
    names = ["byte_perplexity_instance", "bits_per_byte_instance"]
    return parts.select(
        "doc_id", "words", "bytes", F.round(F.log("word_perplexity_instance"), 4).alias("log_word_perplexity"),
        *[F.round(n, 4).alias(n) for n in names],
    )


LL_SQL = NGRAM_SQL + f""",
lls as (select lang, doc_id, sum(ln((n_pair + 0.5::DOUBLE) / (n_ctx + 0.5::DOUBLE * (n_vocab + 1)))) as ll
        from p join bi using (lang, w1, w2) join ctx using (lang, w1) join tot using (lang) group by all),
parts as (select doc_id, lls.lang, ll, len({Q.space_split_sql("text")}) as words, strlen(text) as bytes
          from documents join lls using (doc_id))"""


PARTS_SQL = f"""
with {LL_SQL}
select doc_id, words::BIGINT as words, bytes::BIGINT as bytes, round(-ll / words, 4) as log_word_perplexity,
       round(exp(-ll / bytes), 4) as byte_perplexity_instance, round(-ll / bytes / ln(2), 4) as bits_per_byte_instance
from parts"""


def detokenize(spark, sf):
    """Text with spaces put around its punctuation, and the same undone."""
    docs = Q.table(spark, sf, "documents")
    spaced = F.regexp_replace("text", "(['\".,()])", " $1 ")
    return docs.select("doc_id", F.md5(spaced).alias("spaced_md5"), detok(spaced).alias("joined"))


DETOKENIZE_SQL = """
with s as (select doc_id, regexp_replace(text, '([''".,()])', ' \\1 ', 'g') as t from documents)
select doc_id, md5(t) as spaced_md5,
       regexp_replace(replace(replace(replace(replace(replace(t, ' n''t', 'n''t'), ' )', ')'), '( ', '('), '" ', '"'), ' "', '"'),
                      ' ([''.,])', '\\1', 'g') as joined
from s"""


def segment_cjk(spark, sf):
    """Each language's texts through the segmenter; Han characters stand in for the letter e."""
    docs = Q.table(spark, sf, "documents")
    han = F.translate("text", "eé", "中文")
    return docs.select("doc_id", segment_unspaced(han, "zh").alias("zh"), F.md5(segment_unspaced(han, "en")).alias("other_md5"))


SEGMENT_SQL = f"""
select doc_id, array_to_string({Q.words_sql("regexp_replace(translate(text, 'eé', '中文'), '([中文])', ' \\1 ', 'g')")}, ' ') as zh,
       md5(translate(text, 'eé', '中文')) as other_md5
from documents"""

QUERIES = {
    "pick_choice": (pick_choice, PICK_SQL),
    "rouge_n": (rouge_n, ROUGE_SQL),
    "rouge_l": (rouge_l, None),
    "rouge_l_plain": (rouge_l_plain, ROUGE_L_SQL),
    "rouge_all": (rouge_all, None),
    "rouge_multi_ref": (rouge_multi_ref, MULTI_SQL),
    "max_over_refs": (max_over_refs, MAX_SQL),
    "sari": (sari, SARI_SQL),
    "count_words_bytes": (count_words_bytes, COUNT_SQL),
    "perplexity_parts": (perplexity_parts, PARTS_SQL),
    "detokenize": (detokenize, DETOKENIZE_SQL),
    "segment_cjk": (segment_cjk, SEGMENT_SQL),
}

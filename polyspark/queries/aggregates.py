"""Aggregated metrics and standard errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyspark.functions.hashing import hash_int, hash_unit
from polyspark.functions.resample import draw_sql, weight_sql
from polyspark.operators import aggregates as G
from polyspark.operators import corpus_metrics as CM
from polyspark.operators import doc_metrics as M
from polyspark.operators import prompts as P
from polyspark.queries import common as Q
from polyspark.queries.doc_metrics import LL_SQL, PAIR, _rolling, gram_sql, picked_docs

ROUNDS = 100


def fewshot_accuracy(spark, sf):
    """Three-shot accuracy with standard error per language: the flagship query."""
    picked = picked_docs(spark, sf, Q.SHOTS)
    long = M.long_metrics(picked, [*P.BY, "doc_id"], ["acc", "acc_norm"])
    results = G.aggregate_results(long, P.BY)
    return results.withColumns({c: F.round(c, 6) for c in ("value", "stderr")})


RESULTS = """
select task, template, lang, metric, round(avg(value), 6) as value,
       round(coalesce(stddev_samp(value), 0) / sqrt(count(*)), 6) as stderr, count(*)::BIGINT as n, true as higher_is_better
from metrics group by all"""
ACCURACY_SQL = Q.EVAL_SQL + RESULTS


def zero_shot_accuracy(spark, sf):
    picked = picked_docs(spark, sf, 0)
    long = M.long_metrics(picked, [*P.BY, "doc_id"], ["acc", "acc_norm"])
    results = G.aggregate_results(long, P.BY)
    return results.withColumns({c: F.round(c, 6) for c in ("value", "stderr")})


ZERO_SQL = Q.ZERO_SHOT_SQL + RESULTS


def mean_summary(spark, sf):
    rows = Q.table(spark, sf, "labels").join(Q.table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id")
    out = G.mean_summary(rows, ["lang", "source"], "quality")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "pop_stddev", "sample_stddev", "mean_stderr")})


SUMMARY_SQL = """
select lang, source, round(avg(quality), 6) as mean, round(stddev_pop(quality), 6) as pop_stddev,
       round(coalesce(stddev_samp(quality), 0), 6) as sample_stddev,
       round(coalesce(stddev_samp(quality), 0) / sqrt(count(*)), 6) as mean_stderr, count(*)::BIGINT as n
from labels join documents using (doc_id) group by all"""


def median(spark, sf):
    return G.median(Q.table(spark, sf, "documents"), ["lang"], "n_chars")


MEDIAN_SQL = """
select lang, n_chars::DOUBLE as median
from (select lang, n_chars, row_number() over (partition by lang order by n_chars) - 1 as k, count(*) over (partition by lang) as n
      from documents) where k = n // 2"""


def _graded(spark, sf):
    """Labelled documents with a prediction by hash for quality, and the language guess by hash."""
    docs = Q.table(spark, sf, "documents").select("doc_id", "lang", "source")
    guess = F.element_at(F.array(*[F.lit(x) for x in ("en", "de", "fr", "es")]), (hash_int(1, F.col("doc_id")) % 4 + 1).cast("int"))
    return (
        Q.table(spark, sf, "labels")
        .join(docs, "doc_id")
        .withColumns({"pred": (hash_int(2, F.col("doc_id")) % 4 > 0).cast("int"), "guess": guess})
    )


GRADED_SQL = f"""
graded as (select doc_id, lang, source, quality, ({Q.hash_int_sql("1", "doc_id")}) as h1,
                  ({Q.hash_int_sql("2", "doc_id")} % 4 > 0)::INT as pred,
                  (['en', 'de', 'fr', 'es'])[({Q.hash_int_sql("1", "doc_id")} % 4 + 1)::INT] as guess
           from labels join documents using (doc_id))"""


def matthews_corrcoef(spark, sf):
    """Of the language guess, all classes at once, per quality label."""
    return G.matthews_corrcoef(_graded(spark, sf), ["quality"], "lang", "guess").withColumn(
        "matthews_corrcoef", F.round("matthews_corrcoef", 6)
    )


MCC_SQL = f"""
with {GRADED_SQL},
g as (select quality, lang as k, count(*) as g from graded group by all),
p as (select quality, guess as k, count(*) as p from graded group by all),
s as (select quality, sum(coalesce(g, 0) * coalesce(p, 0)) as gp, sum(coalesce(g, 0) * coalesce(g, 0)) as gg,
             sum(coalesce(p, 0) * coalesce(p, 0)) as pp, sum(coalesce(g, 0)) as n from g full join p using (quality, k) group by quality),
r as (select quality, count(*) filter (lang = guess) as c from graded group by all)
select quality, round(case when (n * n - gg) * (n * n - pp) > 0
                      then (c * n - gp)::DOUBLE / sqrt((n * n - gg)::DOUBLE * (n * n - pp)::DOUBLE) else 0 end, 6) as matthews_corrcoef
from s join r using (quality)"""


def f1_score(spark, sf):
    return G.f1_score(_graded(spark, sf), ["lang"], "quality", "pred").withColumn("f1", F.round("f1", 6))


F1_SQL = f"""
with {GRADED_SQL}
select lang, round(2.0::DOUBLE * count(*) filter (quality = 1 and pred = 1)
                   / (count(*) filter (quality = 1) + count(*) filter (pred = 1)), 6) as f1
from graded group by lang"""


def _answers(spark, sf):
    turns = Q.table(spark, sf, "conversations")
    return turns.select(
        F.pmod("conv_id", F.lit(3)).alias("part"),
        F.col("conv_id").alias("paragraph"),
        F.floor(F.col("turn") / 2).alias("question"),
        (F.col("role") == "assistant").cast("int").alias("label"),
        (F.length("text") > 100).alias("pred"),
    )


ANSWERS_SQL = """
a as (select conv_id % 3 as part, conv_id as paragraph, turn // 2 as question,
             (role = 'assistant') = (length(text) > 100) as good from conversations)"""


def acc_all(spark, sf):
    return G.acc_all(_answers(spark, sf), ["part"]).withColumn("acc_all", F.round("acc_all", 6))


ACC_ALL_SQL = f"""
with {ANSWERS_SQL}, q as (select part, paragraph, question, bool_and(good)::INT as ok from a group by all)
select part, round(avg(ok), 6) as acc_all from q group by part"""


def acc_all_stderr(spark, sf):
    return G.acc_all_stderr(_answers(spark, sf), ["part"]).withColumn("acc_all_stderr", F.round("acc_all_stderr", 6))


ACC_ALL_STDERR_SQL = f"""
with {ANSWERS_SQL}, q as (select part, question, bool_and(good)::INT as ok from a group by all)
select part, round(coalesce(stddev_samp(ok), 0) / sqrt(count(*)), 6) as acc_all_stderr from q group by part"""


def parity(spark, sf):
    """Of the stand-in scorer's choices for documents with neighbouring ids."""
    picked = picked_docs(spark, sf, 0)
    out = G.parity(picked, ["template"], "doc_id", "pred")
    return out.withColumns({c: F.round(c, 6) for c in ("parity", "parity_stderr")})


PARITY_SQL = Q.ZERO_SHOT_SQL + """
select a.template, round(avg((a.pred = b.pred)::INT), 6) as parity,
       round(coalesce(stddev_samp((a.pred = b.pred)::INT), 0) / sqrt(count(*)), 6) as parity_stderr, count(*)::BIGINT as pairs
from picked a join picked b on b.doc_id = a.doc_id + 1 and a.doc_id % 2 = 0 and a.template = b.template group by a.template"""


def perplexity(spark, sf):
    scored = Q.table(spark, sf, "documents").withColumn("ll", -4 * hash_unit(3, F.col("doc_id")))
    return scored.groupBy("lang").agg(
        F.round(G.perplexity(F.col("ll")), 6).alias("perplexity"),
        F.round(G.weighted_mean(F.col("ll"), F.col("n_chars")), 9).alias("weighted_mean"),
    )


PERPLEXITY_SQL = f"""
select lang, round(exp(-avg(ll)), 6) as perplexity, round(sum(ll) / sum(n_chars), 9) as weighted_mean
from (select lang, n_chars, -4 * {Q.hash_unit_sql("3", "doc_id")} as ll from documents) group by lang"""


def weighted_perplexity(spark, sf):
    """Word perplexity, byte perplexity and bits per byte of the bigram model per language."""
    pairs = M.perplexity_pairs(M.perplexity_parts(_rolling(spark, sf), text=None), ["task", "lang"])
    results = G.aggregate_results(pairs, ["task", "lang"])
    return results.select("task", "lang", "metric", F.round("value", 4).alias("value"), "n", "higher_is_better")


WEIGHTED_SQL = f"""
with {LL_SQL},
m as (select lang, 'word_perplexity' as metric, exp(-sum(ll) / sum(words)) as value, count(*) as n from parts group by lang
      union all select lang, 'byte_perplexity', exp(-sum(ll) / sum(bytes)), count(*) from parts group by lang
      union all select lang, 'bits_per_byte', -sum(ll) / sum(bytes) / ln(2), count(*) from parts group by lang)
select 'langid' as task, lang, metric, round(value, 4) as value, n::BIGINT as n, false as higher_is_better from m"""


# --- corpus metrics -------------------------------------------------------------------------


def _parted(spark, sf):
    return Q.generation_pairs(spark, sf).withColumn("part", F.pmod("conv_id", F.lit(4)))


def tokens_13a_sql(text: str) -> str:
    t = f"replace(replace(replace({text}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for old, new in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        t = f"replace({t}, '{old}', '{new}')"
    t = f"' ' || {t} || ' '"
    for pattern, to in (
        ("([\\{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])", " \\1 "),
        ("([^0-9])([\\.,])", "\\1 \\2 "),
        ("([\\.,])([^0-9])", " \\1 \\2"),
        ("([0-9])(-)", "\\1 \\2 "),
    ):
        t = f"regexp_replace({t}, '{pattern}', '{to}', 'g')"
    return Q.words_sql(t)


def bleu(spark, sf):
    stats = CM.bleu_stats(_parted(spark, sf), ["part", *PAIR])
    return CM.bleu(stats, ["part"]).withColumn("bleu", F.round("bleu", 6))


BLEU_SQL = Q.with_sql(Q.PAIRS_SQL, f"""
t as (select conv_id, turn, {tokens_13a_sql("prediction")} as p, [{tokens_13a_sql("reference")}, {tokens_13a_sql("source")}] as rs from pairs),
g as (select conv_id, turn, n, -1 as side, unnest({gram_sql("p", "n")}) as gram from t, (select unnest([1, 2, 3, 4]) as n)
      union all
      select conv_id, turn, n, side, unnest({gram_sql("r", "n")})
      from (select conv_id, turn, i as side, rs[i + 1] as r from t, (select unnest([0, 1]) as i)), (select unnest([1, 2, 3, 4]) as n)),
c as (select conv_id, turn, n, side, gram, count(*) as c from g group by all),
m as (select conv_id, turn, n, gram, coalesce(max(c) filter (side = -1), 0) as p, coalesce(max(c) filter (side >= 0), 0) as r from c group by all),
k as (select conv_id % 4 as part, n, sum(least(p, r))::DOUBLE as correct, sum(p)::DOUBLE as total from m group by all),
l as (select conv_id % 4 as part, sum(len(p))::DOUBLE as sys,
             sum(least((abs(len(rs[1]) - len(p)), len(rs[1])), (abs(len(rs[2]) - len(p)), len(rs[2])))[2])::DOUBLE as ref from t group by all),
z as (select part, sum(ln(100 * correct / total)) / 4 as logs, min(correct) as least_correct from k group by part)""") + """
select part, round(case when sys < ref then exp(1 - ref / sys) else 1 end * exp(logs), 6) as bleu
from z join l using (part)"""


def chrf(spark, sf):
    one = _parted(spark, sf).withColumn("references", F.array("reference"))
    stats = CM.chrf_stats(one, ["part", *PAIR])
    return CM.chrf(stats, ["part"]).withColumn("chrf", F.round("chrf", 6))


def _squeeze_sql(text: str) -> str:
    return f"regexp_extract_all(regexp_replace({text}, '{Q.SPACE_RUN}', '', 'g'), '(?s).')"


CHRF_SQL = Q.with_sql(Q.PAIRS_SQL, f"""
t as (select conv_id, turn, {_squeeze_sql("prediction")} as p, {_squeeze_sql("reference")} as r from pairs),
ns as (select *, unnest([1, 2, 3, 4, 5, 6]) as n from t),
gp as (select conv_id, turn, n, g, count(*) as c from (select conv_id, turn, n, unnest({gram_sql("p", "n")}) as g from ns) group by all),
gr as (select conv_id, turn, n, g, count(*) as c from (select conv_id, turn, n, unnest({gram_sql("r", "n")}) as g from ns) group by all),
h as (select conv_id % 4 as part, n, sum(least(gp.c, gr.c))::DOUBLE as hits from gp join gr using (conv_id, turn, n, g) group by all),
s as (select conv_id % 4 as part, n, sum(greatest(len(r) - n + 1, 0))::DOUBLE as ref,
             sum(case when len(r) >= n then greatest(len(p) - n + 1, 0) else 0 end)::DOUBLE as hyp from ns group by all),
f as (select part, avg(coalesce(hits, 0) / hyp) as p, avg(coalesce(hits, 0) / ref) as r
      from s left join h using (part, n) where hyp > 0 and ref > 0 group by part)""") + """
select part, round(case when p + r > 0 then 100 * 5 * p * r / (4 * p + r) else 0 end, 6) as chrf from f"""


def ter(spark, sf):
    """Of the prediction against the next reference with words left out."""
    one = _parted(spark, sf).withColumn("references", F.array("reference"))
    return CM.ter(CM.ter_stats(one, ["part", *PAIR]), ["part"])


# --- bootstrap ------------------------------------------------------------------------------


def draws_sql(source: str, keys: str, seed: int = 0) -> str:
    """Draws with replacement: for each round and place, the place whose row is taken."""
    return f"""
placed as (select *, row_number() over (partition by {keys} order by {Q.hash_sql(str(seed), "doc_id")}, doc_id) - 1 as i,
                  count(*) over (partition by {keys}) as n from {source}),
rounds as (select unnest(range({ROUNDS})) as round),
drawn as (select {keys}, round, {Q.hash_int_sql(str(seed), "round", "i")} % n as i from placed, rounds),
taken as (select drawn.round, placed.* from drawn join placed using ({keys}, i))"""


def bootstrap_mean(spark, sf):
    out = G.bootstrap_stderr(_graded(spark, sf), ["lang"], G.mean_of("quality"), "doc_id", ROUNDS, method="index")
    return out.withColumn("stderr", F.round("stderr", 6))


BOOT_MEAN_SQL = f"""
with {GRADED_SQL}, {draws_sql("graded", "lang")},
s as (select lang, round, avg(quality) as score from taken group by all)
select lang, round(stddev_samp(score), 6) as stderr from s group by lang"""


def bootstrap_perplexity(spark, sf):
    rows = _graded(spark, sf).withColumn("ll", -hash_unit(4, F.col("doc_id")))
    out = G.stderr_for("perplexity", rows, ["lang"], "doc_id", {"value": "ll"}, ROUNDS, method="index")
    return out.withColumn("stderr", F.round("stderr", 6))


BOOT_PPL_SQL = f"""
with {GRADED_SQL}, v as (select *, -{Q.hash_unit_sql("4", "doc_id")} as ll from graded), {draws_sql("v", "lang")},
s as (select lang, round, exp(-avg(ll)) as score from taken group by all)
select lang, round(stddev_samp(score), 6) as stderr from s group by lang"""


def bootstrap_f1(spark, sf):
    out = G.stderr_for("f1_score", _graded(spark, sf), ["lang"], "doc_id", {"gold": "quality", "pred": "pred"}, ROUNDS, method="index")
    return out.withColumn("stderr", F.round("stderr", 6))


BOOT_F1_SQL = f"""
with {GRADED_SQL}, {draws_sql("graded", "lang")},
s as (select lang, round, coalesce(2.0::DOUBLE * count(*) filter (quality = 1 and pred = 1)
                          / nullif(count(*) filter (quality = 1) + count(*) filter (pred = 1), 0), 0) as score from taken group by all)
select lang, round(stddev_samp(score), 6) as stderr from s group by lang"""


def bootstrap_matthews(spark, sf):
    columns = {"gold": "lang", "pred": "guess"}
    out = G.stderr_for("matthews_corrcoef", _graded(spark, sf), ["quality"], "doc_id", columns, ROUNDS, method="index")
    return out.withColumn("stderr", F.round("stderr", 6))


BOOT_MCC_SQL = f"""
with {GRADED_SQL}, {draws_sql("graded", "quality")},
g as (select quality, round, lang as k, count(*) as g from taken group by all),
p as (select quality, round, guess as k, count(*) as p from taken group by all),
s as (select quality, round, sum(coalesce(g, 0) * coalesce(p, 0)) as gp, sum(coalesce(g, 0) * coalesce(g, 0)) as gg,
             sum(coalesce(p, 0) * coalesce(p, 0)) as pp, sum(coalesce(g, 0)) as n
      from g full join p using (quality, round, k) group by all),
r as (select quality, round, count(*) filter (lang = guess) as c from taken group by all),
z as (select quality, round, case when (n * n - gg) * (n * n - pp) > 0
             then (c * n - gp)::DOUBLE / sqrt((n * n - gg)::DOUBLE * (n * n - pp)::DOUBLE) else 0 end as score
      from s join r using (quality, round))
select quality, round(stddev_samp(score), 6) as stderr from z group by quality"""


def bootstrap_median(spark, sf):
    rows = Q.table(spark, sf, "labels").join(Q.table(spark, sf, "documents"), "doc_id")
    out = G.stderr_for("median", rows, ["lang"], "doc_id", {"value": "n_chars"}, ROUNDS)
    return out.withColumn("stderr", F.round("stderr", 6))


BOOT_MEDIAN_SQL = f"""
with v as (select doc_id, lang, n_chars from labels join documents using (doc_id)), {draws_sql("v", "lang")},
o as (select lang, round, n_chars, row_number() over (partition by lang, round order by n_chars) - 1 as k,
             count(*) over (partition by lang, round) as m from taken)
select lang, round(stddev_samp(n_chars), 6) as stderr from o where k = m // 2 group by lang"""


def _with_errors(out):
    return out.withColumn("stderr", F.round("stderr", 6))


def bootstrap_chrf(spark, sf):
    one = _parted(spark, sf).withColumn("references", F.array("reference"))
    stats = CM.chrf_stats(one, ["part", *PAIR]).withColumn("id", F.concat_ws("-", *PAIR))
    return _with_errors(G.stderr_for("chrf", stats, ["part"], "id", {}, ROUNDS))


def weighted_sql(source: str, id_: str, rounds: int, seed: int = 0) -> str:
    """Rows of ``source`` with their weight ``w`` in every round."""
    return f"""
seeded as (select *, {Q.hash_int_sql(str(seed), id_)} as s from {source}),
drawn as (select *, {draw_sql("s", "round")} as u from seeded, (select unnest(range({rounds})) as round)),
weighted as (select *, {weight_sql("u")} as w from drawn)"""


BOOT_CHRF_SQL = Q.with_sql(Q.PAIRS_SQL, f"""
t as (select conv_id, turn, {_squeeze_sql("prediction")} as p, {_squeeze_sql("reference")} as r from pairs),
ns as (select *, unnest([1, 2, 3, 4, 5, 6]) as n from t),
gp as (select conv_id, turn, n, g, count(*) as c from (select conv_id, turn, n, unnest({gram_sql("p", "n")}) as g from ns) group by all),
gr as (select conv_id, turn, n, g, count(*) as c from (select conv_id, turn, n, unnest({gram_sql("r", "n")}) as g from ns) group by all),
h as (select conv_id, turn, n, sum(least(gp.c, gr.c))::DOUBLE as hits from gp join gr using (conv_id, turn, n, g) group by all),
s as (select conv_id, turn, n, coalesce(hits, 0) as hits, greatest(len(r) - n + 1, 0)::DOUBLE as ref,
             (case when len(r) >= n then greatest(len(p) - n + 1, 0) else 0 end)::DOUBLE as hyp from ns left join h using (conv_id, turn, n)),
ids as (select conv_id, turn, concat_ws('-', conv_id, turn) as id from pairs), {weighted_sql("ids", "id", ROUNDS)},
d as (select conv_id % 4 as part, round, n, sum(w * hits) as hits, sum(w * ref) as ref, sum(w * hyp) as hyp
      from weighted join s using (conv_id, turn) group by all),
f as (select part, round, avg(hits / hyp) filter (hyp > 0 and ref > 0) as p, avg(hits / ref) filter (hyp > 0 and ref > 0) as r from d group by all),
z as (select part, round, case when p + r > 0 then 100 * 5 * p * r / (4 * p + r) else 0 end as score from f)""") + """
select part, round(stddev_samp(score), 6) as stderr from z group by part"""


def bootstrap_ter(spark, sf):
    one = _parted(spark, sf).withColumn("references", F.array("reference"))
    stats = CM.ter_stats(one, ["part", *PAIR]).withColumn("id", F.concat_ws("-", *PAIR))
    return G.stderr_for("ter", stats, ["part"], "id", {}, ROUNDS)


def bootstrap_poisson(spark, sf):
    """Mean per language by row weights."""
    return _with_errors(G.bootstrap_stderr(_graded(spark, sf), ["lang"], G.mean_of("quality"), "doc_id", ROUNDS))


BOOT_POISSON_SQL = f"""
with {GRADED_SQL}, {weighted_sql("graded", "doc_id", ROUNDS)},
z as (select lang, round, sum(w * quality)::DOUBLE / nullif(sum(w), 0) as score from weighted group by all)
select lang, round(stddev_samp(score), 6) as stderr from z group by lang"""

FULL_ROUNDS = 2_000


def bootstrap_f1_rounds(spark, sf):
    """F1 per language over many rounds."""
    out = G.stderr_for("f1_score", _graded(spark, sf), ["lang"], "doc_id", {"gold": "quality", "pred": "pred"}, FULL_ROUNDS)
    return _with_errors(out)


BOOT_F1_ROUNDS_SQL = f"""
with {GRADED_SQL}, {weighted_sql("graded", "doc_id", FULL_ROUNDS)},
z as (select lang, round, coalesce(2.0::DOUBLE * sum(w) filter (quality = 1 and pred = 1)
             / nullif(coalesce(sum(w) filter (quality = 1), 0) + coalesce(sum(w) filter (pred = 1), 0), 0), 0) as score from weighted group by all)
select lang, round(stddev_samp(score), 6) as stderr from z group by lang"""


def bootstrap_matthews_rounds(spark, sf):
    """Matthews correlation by row weights summed into confusion cells."""
    columns = {"gold": "lang", "pred": "guess"}
    return _with_errors(G.stderr_for("matthews_corrcoef", _graded(spark, sf), ["quality"], "doc_id", columns, ROUNDS))


BOOT_MCC_ROUNDS_SQL = f"""
with {GRADED_SQL}, {weighted_sql("graded", "doc_id", ROUNDS)},
g as (select quality, round, lang as k, sum(w) as g from weighted group by all),
p as (select quality, round, guess as k, sum(w) as p from weighted group by all),
s as (select quality, round, sum(coalesce(g, 0) * coalesce(p, 0)) as gp, sum(coalesce(g, 0) * coalesce(g, 0)) as gg,
             sum(coalesce(p, 0) * coalesce(p, 0)) as pp, sum(coalesce(g, 0)) as n
      from g full join p using (quality, round, k) group by all),
r as (select quality, round, coalesce(sum(w) filter (lang = guess), 0) as c from weighted group by all),
z as (select quality, round, case when (n * n - gg) * (n * n - pp) > 0
             then (c * n - gp)::DOUBLE / sqrt((n * n - gg)::DOUBLE * (n * n - pp)::DOUBLE) else 0 end as score
      from s join r using (quality, round))
select quality, round(stddev_samp(score), 6) as stderr from z group by quality"""


QUERIES = {
    "fewshot_accuracy": (fewshot_accuracy, ACCURACY_SQL),
    "zero_shot_accuracy": (zero_shot_accuracy, ZERO_SQL),
    "mean_summary": (mean_summary, SUMMARY_SQL),
    "median": (median, MEDIAN_SQL),
    "matthews_corrcoef": (matthews_corrcoef, MCC_SQL),
    "f1_score": (f1_score, F1_SQL),
    "acc_all": (acc_all, ACC_ALL_SQL),
    "acc_all_stderr": (acc_all_stderr, ACC_ALL_STDERR_SQL),
    "parity": (parity, PARITY_SQL),
    "perplexity": (perplexity, PERPLEXITY_SQL),
    "weighted_perplexity": (weighted_perplexity, WEIGHTED_SQL),
    "bleu": (bleu, BLEU_SQL),
    "chrf": (chrf, CHRF_SQL),
    "ter": (ter, None),
    "bootstrap_mean": (bootstrap_mean, BOOT_MEAN_SQL),
    "bootstrap_perplexity": (bootstrap_perplexity, BOOT_PPL_SQL),
    "bootstrap_f1": (bootstrap_f1, BOOT_F1_SQL),
    "bootstrap_matthews": (bootstrap_matthews, BOOT_MCC_SQL),
    "bootstrap_median": (bootstrap_median, BOOT_MEDIAN_SQL),
    "bootstrap_chrf": (bootstrap_chrf, BOOT_CHRF_SQL),
    "bootstrap_ter": (bootstrap_ter, None),
    "bootstrap_poisson": (bootstrap_poisson, BOOT_POISSON_SQL),
    "bootstrap_f1_rounds": (bootstrap_f1_rounds, BOOT_F1_ROUNDS_SQL),
    "bootstrap_matthews_rounds": (bootstrap_matthews_rounds, BOOT_MCC_ROUNDS_SQL),
}

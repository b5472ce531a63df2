"""The evaluation plan end to end: generated answers, and choices and answers in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.functions.hashing import SEPARATOR
from polyspark.functions.text import words
from polyspark.operators import prompts as P
from polyspark.operators import scoring as S
from polyspark.plans.evaluation import evaluate
from polyspark.queries import common as Q
from polyspark.queries.aggregates import tokens_13a_sql
from polyspark.queries.doc_metrics import gram_sql
from polyspark.sources.templates import Template

REPLY = Template(task="reply", name="reply", jinja="{{text}} ||| {{label}}", id="reply-1", original_task=True, metrics=("BLEU", "SARI"))
NAMED = Template(
    task="langid",
    name="named",
    jinja='The language of the text "{{text}}" is ||| {{label}}',
    answer_choices="en ||| de ||| fr ||| es",
    id="langid-1",
    metrics=("Accuracy",),
)
RESULT = [*P.BY, "metric", "value", "stderr", "n", "higher_is_better"]


def replies(spark, sf) -> DataFrame:
    """Each user turn and the assistant turn after it, as documents of a generation task."""
    turns = Q.table(spark, sf, "conversations")
    user = turns.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), "text")
    reply = turns.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("label"))
    return reply.join(user, ["conv_id", "turn"]).select(
        F.lit("reply").alias("task"),
        F.concat(F.lit("part"), (F.col("conv_id") % 4).cast("string")).alias("lang"),
        F.lit("test").alias("split"),
        (F.col("conv_id").cast("long") * 1000 + F.col("turn")).alias("doc_id"),
        "text",
        "label",
    )


def labelled(spark, sf) -> DataFrame:
    """Documents with their language, of a choice task."""
    docs = Q.table(spark, sf, "documents")
    return docs.select(F.lit("langid").alias("task"), "lang", F.lit("test").alias("split"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("label"))


def answer(requests: DataFrame) -> DataFrame:
    """The hash scorer for choices; a generation is its target with the words left out that a hash picks."""
    if "choice" in requests.columns:
        return S.score_dummy(requests)
    picked = F.filter(
        F.transform(words(F.col("target")), lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
        lambda s: F.conv(F.substring(F.md5(F.concat_ws(SEPARATOR, "doc_id", s["i"].cast("string"), s["w"])), 1, 2), 16, 10).cast("int") % 4 != 0,
    )
    return requests.withColumn("generated", F.array_join(F.transform(picked, lambda s: s["w"]), " "))


def _results(out: dict[str, DataFrame]) -> DataFrame:
    return out["results"].select(RESULT).withColumns({c: F.round(c, 6) for c in ("value", "stderr")})


def generation_evaluation(spark, sf):
    """BLEU and SARI of generated replies."""
    return _results(evaluate(replies(spark, sf), [REPLY], answer, k=0, source="text"))


def mixed_evaluation(spark, sf):
    """A choice task and a generation task in one call, of the documents whose prompt is not empty."""
    docs = labelled(spark, sf).unionByName(replies(spark, sf))
    return _results(evaluate(docs, [NAMED, REPLY], answer, k=0, valid=F.col("label").isNotNull(), source="text"))


def mixed_examples(spark, sf):
    """One example per document and template, with the facts of its template."""
    docs = labelled(spark, sf).unionByName(replies(spark, sf))
    out = evaluate(docs, [NAMED, REPLY], answer, k=0, source="text")["examples"]
    return out.select(*P.BY, "doc_id", "pred", "target", "acc", "prompt_id", "prompt_original_task", F.size("fixed_answer_choice_list").alias("choices"))


REPLIES_SQL = f"""
replies as (
  select 'part' || (a.conv_id % 4) as lang, a.conv_id::BIGINT * 1000 + a.turn as doc_id, u.text as source,
         {Q.strip_sql(Q.truncate_sql("a.text"))} as target
  from conversations a join conversations u on u.conv_id = a.conv_id and u.turn + 1 = a.turn
  where a.role = 'assistant' and u.role = 'user'),
placed as (select doc_id, generate_subscripts(w, 1) - 1 as i, unnest(w) as word from (select doc_id, {Q.words_sql("target")} as w from replies)),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as pred from placed
  where ('0x' || substr(md5(concat_ws(chr(31), doc_id, i, word)), 1, 2))::INT % 4 <> 0 group by all),
answers as (select replies.*, coalesce(pred, '') as pred from replies left join kept using (doc_id))"""

GENERATION_PARTS = f"""
tok as (select lang, doc_id, {tokens_13a_sql("pred")} as p, {tokens_13a_sql("target")} as r from answers),
orders as (select unnest([1, 2, 3, 4]) as n),
bg as (select lang, doc_id, n, unnest({gram_sql("p", "n")}) as g, 1 as a, 0 as b from tok, orders
       union all select lang, doc_id, n, unnest({gram_sql("r", "n")}), 0, 1 from tok, orders),
bc as (select lang, doc_id, n, g, sum(a) as a, sum(b) as b from bg group by all),
bk as (select lang, n, sum(least(a, b))::DOUBLE as correct, sum(a)::DOUBLE as total from bc group by all),
bl as (select lang, sum(len(p))::DOUBLE as sys, sum(len(r))::DOUBLE as ref, count(*) as n from tok group by all),
bz as (select lang, sum(ln(100 * correct / total)) / 4 as logs from bk group by lang),
bleu as (select lang, 'bleu' as metric, case when sys < ref then exp(1 - ref / sys) else 1 end * exp(logs) as value, null::DOUBLE as stderr, n
         from bz join bl using (lang)),
base as (select lang, doc_id, n, string_split(lower(source), ' ') as s, string_split(lower(pred), ' ') as c, string_split(lower(target), ' ') as r
         from answers, orders),
sides as (
  select lang, doc_id, n, unnest({gram_sql("s", "n")}) as g, 's' as side from base
  union all select lang, doc_id, n, unnest({gram_sql("c", "n")}), 'c' from base
  union all select lang, doc_id, n, unnest({gram_sql("r", "n")}), 'r' from base),
cnt as (select lang, doc_id, n, g, count(*) filter (side = 's') as s, count(*) filter (side = 'c') as c, count(*) filter (side = 'r') as r from sides group by all),
al as (select *, least(s, c) as keep, least(s, r) as keep_all, least(s, c, r) as keep_good, greatest(s - c, 0) as del,
              greatest(greatest(s - c, 0) - r, 0) as del_good from cnt),
fig as (select lang, doc_id, n,
   coalesce(sum(keep_good::DOUBLE / keep) filter (keep > 0) / nullif(count(*) filter (keep > 0), 0), 0) as kp,
   coalesce(sum(keep_good::DOUBLE / keep_all) filter (keep_all > 0) / nullif(count(*) filter (keep_all > 0), 0), 0) as kr,
   coalesce(sum(del_good::DOUBLE / del) filter (del > 0) / nullif(count(*) filter (del > 0), 0), 0) as dp,
   coalesce((count(*) filter (c > 0 and s = 0 and r > 0))::DOUBLE / nullif(count(*) filter (c > 0 and s = 0), 0), 0) as ap,
   coalesce((count(*) filter (c > 0 and s = 0 and r > 0))::DOUBLE / nullif(count(*) filter (r > 0 and s = 0), 0), 0) as ar
   from al group by all),
sari_docs as (select lang, doc_id, sum(case when kp + kr > 0 then 2 * kp * kr / (kp + kr) else 0 end + dp
                                 + case when ap + ar > 0 then 2 * ap * ar / (ap + ar) else 0 end) / 12 as sari from fig group by all),
sari as (select lang, 'sari' as metric, avg(sari) as value, coalesce(stddev_samp(sari), 0) / sqrt(count(*)) as stderr, count(*) as n from sari_docs group by lang),
generated as (
  select 'reply' as task, 'reply' as template, lang, metric, round(value, 6) as value, round(stderr, 6) as stderr, n::BIGINT as n, true as higher_is_better
  from (select * from bleu union all select * from sari))"""

GENERATION_SQL = Q.with_sql(REPLIES_SQL, GENERATION_PARTS) + "select * from generated"

MIXED_SQL = (
    Q.ZERO_SHOT_SQL.rstrip()
    + ","
    + REPLIES_SQL
    + ","
    + GENERATION_PARTS
    + """
select * from generated
union all
select task, template, lang, metric, round(avg(value), 6) as value, round(coalesce(stddev_samp(value), 0) / sqrt(count(*)), 6) as stderr,
       count(*)::BIGINT as n, true as higher_is_better
from metrics group by all"""
)

EXAMPLES_SQL = (
    Q.ZERO_SHOT_SQL.rstrip()
    + ","
    + REPLIES_SQL
    + f"""
select 'langid' as task, 'named' as template, lang, doc_id, pred, target, (pred = target)::INT::DOUBLE as acc, 'langid-1' as prompt_id,
       false as prompt_original_task, 4 as choices from picked
union all
select 'reply', 'reply', lang, doc_id, {Q.strip_sql("pred")}, target, null, 'reply-1', true, null from answers"""
)

QUERIES = {
    "generation_evaluation": (generation_evaluation, GENERATION_SQL),
    "mixed_evaluation": (mixed_evaluation, MIXED_SQL),
    "mixed_examples": (mixed_examples, EXAMPLES_SQL),
}

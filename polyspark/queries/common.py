"""The stand-in tasks the queries run on, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyspark.functions.hashing import HASH_RANGE, NULL_MARK, SEPARATOR, content_key
from polyspark.functions.text import WHITE_SPACE, words
from polyspark.operators import prompts as P
from polyspark.session import spread
from polyspark.sources.templates import Template

SEED = 1234
SHOTS = 3

LANGID = Template(
    task="langid",
    name="named",
    jinja='The language of the text "{{text}}" is ||| {{lang}}',
    answer_choices="en ||| de ||| fr ||| es",
    id="langid-1",
    original_task=True,
    metrics=("Accuracy",),
)
LANGID_SHORT = Template(
    task="langid",
    name="short",
    jinja="{{text}}\nLanguage: ||| {{lang}}",
    answer_choices="en ||| de ||| fr ||| es",
    id="langid-2",
    metrics=("Accuracy",),
)
TEMPLATES = [LANGID, LANGID_SHORT]


# Tables whose rows cost much to process.
TEXT_TABLES = ("documents", "conversations")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df, df.columns[0]) if name in TEXT_TABLES else df


def langid_docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.lit("langid").alias("task"), "doc_id", "lang", "text")


def rendered(spark: SparkSession, sf: str, templates=(LANGID,)) -> DataFrame:
    """Rendered documents with their content key; the text itself is no longer needed."""
    docs = langid_docs(spark, sf).withColumn("content", content_key(F.col("text"), F.col("lang")))
    return P.render(docs, list(templates)).drop("text", "metrics")


def with_context(spark: SparkSession, sf: str, k: int = SHOTS, templates=(LANGID,)) -> DataFrame:
    """Every document with ``k`` examples drawn from all documents but itself and its copies."""
    docs = rendered(spark, sf, templates)
    if k == 0:
        return P.fewshot_context(docs, None, 0)
    pool = docs.select(
        *P.BY, F.col("doc_id").alias("row_id"), "content", P.format_example(F.col("text_prompt"), F.col("target")).alias("example")
    )
    sampled = P.fewshot_sample(pool, docs, k, SEED)
    return P.fewshot_context(docs, sampled, k, source="all")


def generation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each user turn with the assistant turn after it; the prediction is the reference with words left out.

    A word is left out if the hash of the pair, its place and the word is odd.
    """
    turns = table(spark, sf, "conversations")
    user = turns.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("source"))
    reply = turns.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("reference"))
    kept = F.transform(
        F.filter(
            F.transform(words(F.col("reference")), lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
            lambda s: F.conv(F.substring(F.md5(F.concat_ws(SEPARATOR, "conv_id", "turn", s["i"].cast("string"), s["w"])), 1, 2), 16, 10).cast("int") % 4 != 0,
        ),
        lambda s: s["w"],
    )
    return (
        reply.join(user, ["conv_id", "turn"])
        .withColumn("prediction", F.array_join(kept, " "))
        .withColumn("references", F.array("reference", "source"))
    )


# --- the same in SQL ------------------------------------------------------------------------


def hash_sql(*parts: str) -> str:
    inner = ", ".join(f"coalesce(cast({p} as varchar), chr({ord(NULL_MARK)}))" for p in parts)
    return f"md5(concat_ws(chr({ord(SEPARATOR)}), {inner}))"


def hash_int_sql(*parts: str) -> str:
    return f"('0x' || substr({hash_sql(*parts)}, 1, 15))::BIGINT"


def hash_unit_sql(*parts: str) -> str:
    return f"(({hash_int_sql(*parts)})::DOUBLE / {HASH_RANGE:.1f}::DOUBLE)"


def strip_sql(text: str) -> str:
    chars = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
    return f"trim({text}, {chars})"


def truncate_sql(text: str) -> str:
    return (
        f"(case when length({text}) <= 2053 then {text} "
        f"else regexp_replace(substr({text}, 1, 2045), ' [^ ]*$', '') || '...' end)"
    )


SPACE_RUN = "[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x{85}]+"


def space_split_sql(text: str) -> str:
    return f"regexp_split_to_array({text}, '{SPACE_RUN}')"


def words_sql(text: str) -> str:
    return f"list_filter({space_split_sql(text)}, lambda w: w <> '')"


RENDERED_SQL = f"""
r as (
  select 'langid' as task, 'named' as template, lang, doc_id,
         {strip_sql("'The language of the text \"' || " + truncate_sql("text") + " || '\" is '")} as text_prompt,
         {strip_sql(truncate_sql("lang"))} as target,
         {hash_sql("text", "lang")} as content
  from documents)"""

BOTH_RENDERED_SQL = f"""
r as (
  select 'langid' as task, template, lang, doc_id, {strip_sql("raw")} as text_prompt,
         {strip_sql(truncate_sql("lang"))} as target, {hash_sql("text", "lang")} as content
  from (select *, 'named' as template, 'The language of the text "' || {truncate_sql("text")} || '" is ' as raw from documents
        union all
        select *, 'short' as template, {truncate_sql("text")} || chr(10) || 'Language: ' as raw from documents))"""

FEWSHOT_SQL = f"""
contents as (
  select task, template, lang, content, count(*) as m, {hash_sql(str(SEED), "content")} as o from r group by all),
runs as (
  select *, coalesce(sum(m) over (partition by task, template, lang order by o, content
                                  rows between unbounded preceding and 1 preceding), 0)::BIGINT as run_start
  from contents),
ranked as (
  select r.task, r.template, r.lang, r.doc_id as row_id, r.text_prompt || ' ' || r.target as example,
         run_start + row_number() over (partition by r.task, r.template, r.lang, r.content
                                        order by substr({hash_sql("r.doc_id")}, 1, 2), r.doc_id) - 1 as rank
  from r join runs using (task, template, lang, content)),
sizes as (select task, template, lang, sum(m)::BIGINT as n from contents group by all),
own as (
  select r.task, r.template, r.lang, r.doc_id, run_start + m as start_at, n - m as free, n
  from r join runs using (task, template, lang, content) join sizes using (task, template, lang)),
strata as (
  select *, (j * free // {SHOTS})::BIGINT as low, ((j + 1) * free // {SHOTS})::BIGINT as high
  from own, (select unnest(range({SHOTS})) as j)),
drawn as (
  select task, template, lang, doc_id,
         (j + {hash_int_sql(str(SEED), "task", "template", "lang", "doc_id")}) % {SHOTS} as slot,
         (start_at + low + {hash_int_sql(str(SEED), "task", "template", "lang", "doc_id", "j")} % (high - low)) % n as rank
  from strata),
sampled as (
  select task, template, lang, doc_id, slot, row_id, example from drawn join ranked using (task, template, lang, rank))"""

CONTEXT_SQL = """
ctx as (
  select r.*, s.shots || chr(10) || r.text_prompt as ctx, s.idx
  from r join (select task, template, lang, doc_id, string_agg(example, chr(10) order by slot) as shots,
                      string_agg(row_id::varchar, ',' order by slot) as idx
               from sampled group by all) s using (task, template, lang, doc_id))"""

CHOICES_SQL = """
choices as (
  select * from (values (0, 'en'), (1, 'de'), (2, 'fr'), (3, 'es')) t(req_idx, choice))"""


def requests_sql(source: str) -> str:
    return f"""
requests as (select {source}.*, req_idx, choice, ' ' || choice as cont from {source}, choices)"""


SCORED_SQL = f"""
scored as (select *, -{hash_unit_sql("ctx", "cont")} as ll from requests)"""

PICKED_SQL = """
picked as (
  select task, template, lang, doc_id, any_value(target) as target,
         arg_max(choice, (ll, -req_idx)) as pred,
         arg_max(choice, (ll / length(choice), -req_idx)) as norm_pred
  from scored group by all),
metrics as (
  select task, template, lang, doc_id, 'acc' as metric, (pred = target)::INT::DOUBLE as value from picked
  union all
  select task, template, lang, doc_id, 'acc_norm', (norm_pred = target)::INT::DOUBLE from picked)"""


def with_sql(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


EVAL_SQL = with_sql(
    RENDERED_SQL, FEWSHOT_SQL, CONTEXT_SQL, CHOICES_SQL, requests_sql("ctx"), SCORED_SQL, PICKED_SQL
)
ZERO_SHOT_SQL = with_sql(
    RENDERED_SQL,
    "\nctx as (select *, text_prompt as ctx from r)",
    CHOICES_SQL,
    requests_sql("ctx"),
    SCORED_SQL,
    PICKED_SQL,
)

PAIRS_SQL = f"""
turns as (
  select a.conv_id, a.turn, u.text as source, a.text as reference
  from conversations a join conversations u on u.conv_id = a.conv_id and u.turn + 1 = a.turn
  where a.role = 'assistant' and u.role = 'user'),
placed as (select conv_id, turn, generate_subscripts(w, 1) - 1 as i, unnest(w) as word
           from (select conv_id, turn, {words_sql("reference")} as w from turns)),
kept as (
  select conv_id, turn, string_agg(word, ' ' order by i) as prediction from placed
  where ('0x' || substr(md5(concat_ws(chr(31), conv_id, turn, i, word)), 1, 2))::INT % 4 <> 0 group by all),
pairs as (
  select turns.*, coalesce(prediction, '') as prediction, [reference, source] as refs
  from turns left join kept using (conv_id, turn))"""

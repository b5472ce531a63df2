"""Templates, prompts, few-shot contexts and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyspark.functions.text import truncate
from polyspark.operators import prompts as P
from polyspark.queries import common as Q
from polyspark.sources.tasks import choose_split, hash_splits
from polyspark.sources.tasks import EVAL_ORDER
from polyspark.sources.templates import select_templates, templates_table

SPLITS = {"train": 80, "validation": 10, "test": 10}


def split_docs(spark, sf):
    """Documents by hash into three splits; French ones have no test split."""
    docs = hash_splits(Q.langid_docs(spark, sf), SPLITS, Q.SEED)
    french_test = (F.col("lang") == "fr") & (F.col("split") == "test")
    return docs.withColumn("split", F.when(french_test, F.lit("validation")).otherwise(F.col("split")))


SPLIT_SQL = f"""
splits as (
  select 'langid' as task, doc_id, lang, text,
         case when h < 80 then 'train' when h < 90 or lang = 'fr' then 'validation' else 'test' end as split
  from (select *, {Q.hash_int_sql(str(Q.SEED), "doc_id")} % 100 as h from documents))"""


def read_task(spark, sf):
    """How many documents each language has in the split its evaluation uses."""
    docs = choose_split(split_docs(spark, sf), EVAL_ORDER, ["task", "lang"])
    return docs.groupBy("task", "lang", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("doc_id").cast("bigint").alias("id_sum")
    )


READ_TASK_SQL = f"""
with {SPLIT_SQL}
select task, lang, split, count(*)::BIGINT as rows, sum(doc_id)::BIGINT as id_sum from splits
where split = case when lang = 'fr' then 'validation' else 'test' end group by all"""


def assign_doc_ids(spark, sf):
    docs = Q.langid_docs(spark, sf)
    return P.assign_doc_ids(docs, ["task", "lang"], "doc_id", "position").select("doc_id", "lang", "position")


IDS_SQL = """
select doc_id, lang, (row_number() over (partition by lang order by doc_id) - 1)::BIGINT as position from documents"""


def drop_invalid(spark, sf):
    """Pairs whose reference is not empty."""
    pairs = Q.generation_pairs(spark, sf).withColumn("target", F.col("prediction"))
    return P.drop_empty_targets(pairs).select("conv_id", "turn", F.length("target").cast("bigint").alias("chars"))


DROP_SQL = Q.with_sql(Q.PAIRS_SQL) + (
    "select conv_id, turn, length(prediction)::BIGINT as chars from pairs where prediction <> ''"
)


def shuffle_limit(spark, sf):
    docs = Q.langid_docs(spark, sf)
    return P.shuffle_limit(docs, ["task", "lang"], "doc_id", Q.SEED, 20).select("doc_id", "lang", "position")


SHUFFLE_SQL = f"""
select doc_id, lang, k::BIGINT as position
from (select *, row_number() over (partition by lang order by {Q.hash_sql(str(Q.SEED), "doc_id")}, doc_id) - 1 as k
      from documents) where k < 20"""


def shuffle_documents(spark, sf):
    docs = Q.langid_docs(spark, sf)
    return P.shuffle_limit(docs, ["task", "lang"], "doc_id", Q.SEED).select("doc_id", "lang", "position")


SHUFFLE_ALL_SQL = f"""
select doc_id, lang, (row_number() over (partition by lang order by {Q.hash_sql(str(Q.SEED), "doc_id")}, doc_id) - 1)::BIGINT as position
from documents"""


def cross_templates(spark, sf):
    """Documents per template of their task, for the original and for all templates."""
    docs = Q.langid_docs(spark, sf)
    chosen = {
        names: [t.name for t in select_templates(Q.TEMPLATES, "langid", names)]
        for names in ("all_templates", "original_templates", "short,named,short")
    }
    out = None
    for names, picked in chosen.items():
        rows = P.cross_templates(docs, templates_table(spark, Q.TEMPLATES), picked)
        counted = rows.groupBy("task", "template", "template_key", "lang").agg(F.count(F.lit(1)).alias("rows"))
        counted = counted.withColumn("names", F.lit(names))
        out = counted if out is None else out.unionByName(counted)
    return out


CROSS_SQL = """
with t as (select * from (values ('all_templates', 'named'), ('all_templates', 'short'), ('original_templates', 'named'),
                                 ('short,named,short', 'named'), ('short,named,short', 'short')) v(names, template))
select 'langid' as task, template, 'langid+' || template as template_key, lang, count(*)::BIGINT as rows, names
from documents, t group by all"""


def templates(spark, sf):
    """The template table with the number of documents of its task."""
    sizes = Q.langid_docs(spark, sf).groupBy("task").agg(F.count(F.lit(1)).alias("documents"))
    flat = templates_table(spark, Q.TEMPLATES).join(sizes, "task")
    return flat.withColumns({c: F.array_join(c, ",") for c in ("metrics", "languages")})


def render(spark, sf):
    return Q.rendered(spark, sf, Q.TEMPLATES).select(
        "doc_id", "lang", "template", "task_template", "text_prompt", "target", F.array_join("choices", "|").alias("choices")
    )


RENDER_SQL = Q.with_sql(Q.BOTH_RENDERED_SQL) + """
select doc_id, lang, template, 'langid+' || template as task_template, text_prompt, target, 'en|de|fr|es' as choices from r"""


def render_highlighted(spark, sf):
    docs = Q.langid_docs(spark, sf)
    return P.render(docs, [Q.LANGID], mark=True).select("doc_id", "text_prompt", "target")


HIGHLIGHT_SQL = f"""
select doc_id,
       {Q.strip_sql("'The language of the text \"<span style=''color: #F08080''>' || " + Q.truncate_sql("text") + " || '</span>\" is '")} as text_prompt,
       '<span style=''color: #F08080''>' || lang || '</span>' as target
from documents"""


def truncate_field(spark, sf):
    return table_text(spark, sf).select("doc_id", truncate(F.col("text")).alias("cut"))


def table_text(spark, sf):
    return Q.table(spark, sf, "documents").select("doc_id", "text")


TRUNCATE_SQL = f"select doc_id, {Q.truncate_sql('text')} as cut from documents"


def answer_choices(spark, sf):
    """Choices that use a field of the document, next to fixed ones."""
    docs = Q.table(spark, sf, "documents").select("doc_id", "lang", "source")
    with_field = Q.Template(task="t", name="t", jinja="a ||| b", answer_choices="{{lang}} ||| not {{lang}} ||| {{source}}")
    return docs.select(
        "doc_id",
        F.array_join(P.answer_choices(docs, with_field), "|").alias("choices"),
        F.array_join(P.fixed_choices(with_field), "|").alias("fixed_of_field"),
        F.array_join(P.fixed_choices(Q.LANGID), "|").alias("fixed"),
    )


CHOICES_SQL = """
select doc_id, lang || '|not ' || lang || '|' || source as choices, null::VARCHAR as fixed_of_field, 'en|de|fr|es' as fixed
from documents"""


def prompt_expressions(spark, sf):
    """A prompt that lists its answer choices and a target that picks one by the document's label."""
    docs = Q.table(spark, sf, "documents").select(
        "doc_id", "lang", "source", (F.col("doc_id") % 4).alias("label"), Q.words("source").alias("parts"), (F.col("n_chars") / 8).alias("size")
    )
    asks = Q.Template(
        task="t",
        name="t",
        jinja='{{source | upper}} ({{parts | length}}, {{size}}): {{answer_choices | join(", ")}}? not {{answer_choices[-1]}}{{answer_choices[9]}}'
        " ||| {{answer_choices[label]}} {{parts | first}}",
        answer_choices="{{lang}} ||| other ||| both",
    )
    text, target = P.prompt_columns(docs, asks)
    return docs.select("doc_id", text.alias("prompt"), target.alias("target"))


EXPRESSIONS_SQL = f"""
with d as (select *, {Q.words_sql("source")} as parts, [lang, 'other', 'both'] as choices from documents)
select doc_id, upper(source) || ' (' || len(parts) || ', ' || (n_chars / 8)::DOUBLE::VARCHAR || '): ' || lang || ', other, both? not both' as prompt,
       {Q.strip_sql("coalesce(choices[(doc_id % 4 + 1)::INT], '') || ' ' || parts[1]")} as target
from d"""


def template_filters(spark, sf):
    """The most frequent words of each document, one of its words by hash, and a marked language."""
    docs = Q.table(spark, sf, "documents")
    tokens = docs.select("doc_id", "lang", Q.words(F.lower("text")).alias("w"))
    common = P.most_frequent(tokens, ["doc_id"], "w")
    picked = tokens.select(
        "doc_id", P.choose(F.col("w"), Q.SEED, F.col("doc_id")).alias("picked"), P.highlight(F.col("lang")).alias("marked")
    )
    return picked.join(common.select("doc_id", F.array_join("modes", " ").alias("modes")), "doc_id", "left")


FILTERS_SQL = f"""
with t as (select doc_id, lang, {Q.words_sql("lower(text)")} as w from documents),
u as (select doc_id, unnest(w) as item, generate_subscripts(w, 1) as i from t),
c as (select doc_id, item, count(*) as n, min(i) as i from u group by all),
m as (select doc_id, string_agg(item, ' ' order by i) as modes
      from (select *, max(n) over (partition by doc_id) as most from c) where n = most group by doc_id)
select doc_id, w[({Q.hash_int_sql(str(Q.SEED), "doc_id")} % greatest(len(w), 1) + 1)::INT] as picked,
       '<span style=''color: #F08080''>' || lang || '</span>' as marked, modes
from t left join m using (doc_id)"""


def fewshot_sample(spark, sf):
    docs = Q.rendered(spark, sf)
    pool = docs.select(*P.BY, F.col("doc_id").alias("row_id"), "content")
    sampled = P.fewshot_sample(pool, docs, Q.SHOTS, Q.SEED)
    return sampled.select("template", "lang", "doc_id", F.col("slot").cast("bigint"), "row_id")


SAMPLE_SQL = Q.with_sql(Q.RENDERED_SQL, Q.FEWSHOT_SQL) + (
    "select template, lang, doc_id, slot::BIGINT as slot, row_id from sampled"
)


def fewshot_context(spark, sf):
    return Q.with_context(spark, sf).select(
        "lang",
        "doc_id",
        "ctx",
        F.array_join(F.col("fewshot_idx").cast("array<string>"), ",").alias("fewshot_idx"),
        "fewshot_source",
        F.col("fewshot_num").cast("bigint").alias("fewshot_num"),
    )


CONTEXT_SQL = Q.with_sql(Q.RENDERED_SQL, Q.FEWSHOT_SQL, Q.CONTEXT_SQL) + f"""
select lang, doc_id, ctx, idx as fewshot_idx, 'all' as fewshot_source, {Q.SHOTS}::BIGINT as fewshot_num from ctx"""


def choice_requests(spark, sf):
    requests = P.choice_requests(Q.with_context(spark, sf, 0, Q.TEMPLATES))
    return requests.select("template", "doc_id", F.col("req_idx").cast("bigint"), "req_type", F.md5("ctx").alias("ctx_md5"), "cont")


CHOICE_REQUESTS_SQL = Q.with_sql(Q.BOTH_RENDERED_SQL, Q.CHOICES_SQL) + """
select template, doc_id, req_idx::BIGINT as req_idx, 'loglikelihood' as req_type, md5(text_prompt) as ctx_md5, ' ' || choice as cont
from r, choices"""


def generation_requests(spark, sf):
    pairs = Q.generation_pairs(spark, sf).select("conv_id", "turn", F.col("source").alias("ctx"))
    return P.generation_requests(pairs, ["\n"], 64, 1).select(
        "conv_id",
        "turn",
        "ctx",
        "req_type",
        F.array_join("args.stop_sequences", "|").alias("stops"),
        F.col("args.max_generation_length").cast("bigint").alias("max_length"),
        F.col("args.num_fewshot").cast("bigint").alias("k"),
    )


GENERATION_SQL = Q.with_sql(Q.PAIRS_SQL) + """
select conv_id, turn, source as ctx, 'greedy_until' as req_type, chr(10) as stops, 64::BIGINT as max_length, 1::BIGINT as k from pairs"""


def perplexity_requests(spark, sf):
    return P.perplexity_requests(table_text(spark, sf)).select("doc_id", "req_type", "ctx", "cont")


PERPLEXITY_SQL = "select doc_id, 'loglikelihood_rolling' as req_type, '' as ctx, text as cont from documents"


def prompt_preview(spark, sf):
    """The first two prompts per template over the union of two splits."""
    docs = split_docs(spark, sf)
    union = P.union_splits([docs.where("split = 'validation'"), docs.where("split = 'test'")])
    contexts = P.fewshot_context(P.render(union, Q.TEMPLATES), None, 0)
    shown = P.prompt_preview(contexts, 2, ["task", "template"], ["split_order", "doc_id"])
    return shown.select("template", "doc_id", F.col("example").cast("bigint"), "shown")


PREVIEW_SQL = Q.with_sql(Q.BOTH_RENDERED_SQL, SPLIT_SQL) + """
select template, doc_id, example::BIGINT as example,
       '!!@@##@@!! -- Example ' || example || chr(10) || text_prompt || chr(10) as shown
from (select r.template, r.doc_id, text_prompt,
             row_number() over (partition by r.template order by split = 'test', r.doc_id) - 1 as example
      from r join splits using (doc_id) where split <> 'train') where example < 2"""


def prompt_page(spark, sf):
    """The second page of fifty documents of each language."""
    return P.page(Q.langid_docs(spark, sf), ["lang"], "doc_id", 1).select("lang", "doc_id", "position")


PAGE_SQL = """
select lang, doc_id, k::BIGINT as position
from (select *, row_number() over (partition by lang order by doc_id) - 1 as k from documents) where k between 50 and 99"""


def translation_direction(spark, sf):
    """Directions of language-pair names made from each document's language."""
    docs = Q.table(spark, sf, "documents").select(
        "doc_id",
        F.concat("lang", F.lit("-"), F.lit("en")).alias("dataset"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("say-"), "lang", F.lit("-en"))).otherwise(F.lit("reverse")).alias("template"),
    )
    return P.translation_direction(docs, "dataset", "template").select("doc_id", "src_lang", "ref_lang")


DIRECTION_SQL = """
select doc_id, case when doc_id % 2 = 0 then lang else 'en' end as src_lang,
       case when doc_id % 2 = 0 then 'en' else lang end as ref_lang from documents"""

TEMPLATES_SQL = """
with v as (select * from (values
  ('langid-1', 'named', 'The language of the text "{{text}}" is ||| {{lang}}', true),
  ('langid-2', 'short', '{{text}}' || chr(10) || 'Language: ||| {{lang}}', false)) t(id, name, jinja, original_task))
select 'langid' as task, id, name, jinja, '' as reference, 'en ||| de ||| fr ||| es' as answer_choices, original_task,
       false as choices_in_prompt, 'Accuracy' as metrics, 'multi' as languages, 'langid+' || name as template_key,
       (select count(*) from documents)::BIGINT as documents
from v"""

QUERIES = {
    "read_task": (read_task, READ_TASK_SQL),
    "templates": (templates, TEMPLATES_SQL),
    "assign_doc_ids": (assign_doc_ids, IDS_SQL),
    "prompt_expressions": (prompt_expressions, EXPRESSIONS_SQL),
    "drop_invalid": (drop_invalid, DROP_SQL),
    "shuffle_limit": (shuffle_limit, SHUFFLE_SQL),
    "shuffle_documents": (shuffle_documents, SHUFFLE_ALL_SQL),
    "cross_templates": (cross_templates, CROSS_SQL),
    "render": (render, RENDER_SQL),
    "render_highlighted": (render_highlighted, HIGHLIGHT_SQL),
    "truncate_field": (truncate_field, TRUNCATE_SQL),
    "answer_choices": (answer_choices, CHOICES_SQL),
    "template_filters": (template_filters, FILTERS_SQL),
    "fewshot_sample": (fewshot_sample, SAMPLE_SQL),
    "fewshot_context": (fewshot_context, CONTEXT_SQL),
    "choice_requests": (choice_requests, CHOICE_REQUESTS_SQL),
    "generation_requests": (generation_requests, GENERATION_SQL),
    "perplexity_requests": (perplexity_requests, PERPLEXITY_SQL),
    "prompt_preview": (prompt_preview, PREVIEW_SQL),
    "prompt_page": (prompt_page, PAGE_SQL),
    "translation_direction": (translation_direction, DIRECTION_SQL),
}

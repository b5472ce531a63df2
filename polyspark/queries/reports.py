"""Result tables, costs, catalogues, result files."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from polyspark.functions.text import count_words, words
from polyspark.operators import aggregates as G
from polyspark.operators import doc_metrics as M
from polyspark.operators import prompts as P
from polyspark.operators import reports as R
from polyspark.queries import common as Q
from polyspark.queries.doc_metrics import picked_docs
from polyspark.queries.prompts import SPLIT_SQL, split_docs
from polyspark.session import checkpoint_dir
from polyspark.sources.corpus import with_script
from polyspark.sources.sinks import flatten_struct as flatten
from polyspark.sources.sinks import (
    lang_of_path,
    materialize,
    publish_run,
    published_runs,
    read_run,
    run_key,
    slim_results,
    stage_key,
    write_results,
)
from polyspark.sources.templates import templates_table


def _results(spark, sf, templates=(Q.LANGID,)):
    picked = picked_docs(spark, sf, 0, templates)
    long = M.long_metrics(picked, [*P.BY, "doc_id"], ["acc", "acc_norm"])
    return G.aggregate_results(long, P.BY)


RESULTS_SQL = """
res as (
  select task, template, lang, metric, avg(value) as value, coalesce(stddev_samp(value), 0) / sqrt(count(*)) as stderr, count(*) as n
  from metrics group by all)"""
BOTH_SQL = Q.with_sql(
    Q.BOTH_RENDERED_SQL,
    "\nctx as (select *, text_prompt as ctx from r)",
    Q.CHOICES_SQL,
    Q.requests_sql("ctx"),
    Q.SCORED_SQL,
    Q.PICKED_SQL,
    RESULTS_SQL,
)


def results_table(spark, sf):
    results = _results(spark, sf, Q.TEMPLATES).withColumn("version", F.lit(1))
    return R.results_table(results, by=("lang",))


TABLE_SQL = BOTH_SQL + """
select lang, task as "Task", template as "Prompt",
       case when row_number() over (partition by task, template, lang order by metric) = 1 then '1' else '' end as "Version",
       metric as "Metric", printf('%.4f', value) as "Value", '±' as pm, printf('%.4f', stderr) as "Stderr" from res"""


def results_table_short(spark, sf):
    return R.results_table(_results(spark, sf, Q.TEMPLATES), style="short", by=("lang",))


SHORT_SQL = BOTH_SQL + """
select lang, template as prompt_name, metric, printf('%.5g', value) as mean, printf('%.5g', stderr) as stderr from res"""


def markdown(spark, sf):
    results = _results(spark, sf, Q.TEMPLATES).withColumn("version", F.lit(1))
    return R.markdown_rows(R.results_table(results, by=("lang",)))


MARKDOWN_SQL = BOTH_SQL + """
select '|' || concat_ws('|', lang, task, template,
       case when row_number() over (partition by task, template, lang order by metric) = 1 then '1' else '' end,
       metric, printf('%.4f', value), '±', printf('%.4f', stderr)) || '|' as line from res"""


def slim(spark, sf):
    results = R.with_logging_info(_results(spark, sf), templates_table(spark, Q.TEMPLATES))
    return slim_results(results).withColumns({c: F.round(c, 6) for c in ("value", "stderr")})


SLIM_SQL = Q.ZERO_SHOT_SQL.rstrip() + "," + RESULTS_SQL + """
select task, template, lang, metric, round(value, 6) as value, round(stderr, 6) as stderr, n::BIGINT as n,
       true as higher_is_better, template as prompt_name from res"""


def logging_info(spark, sf):
    examples = picked_docs(spark, sf, 0, Q.TEMPLATES)
    facts = Q.langid_docs(spark, sf).groupBy("task").agg(F.count(F.lit(1)).alias("dataset_rows"))
    out = R.with_logging_info(examples, templates_table(spark, Q.TEMPLATES), facts)
    return out.select(
        "lang", "doc_id", "template", "pred", "prompt_id", "prompt_original_task", "dataset_rows",
        F.array_join("fixed_answer_choice_list", ",").alias("choices"),
    )


LOGGING_SQL = BOTH_SQL + """
select lang, doc_id, template, pred, case template when 'named' then 'langid-1' else 'langid-2' end as prompt_id,
       template = 'named' as prompt_original_task, (select count(*) from documents)::BIGINT as dataset_rows, 'en,de,fr,es' as choices
from picked"""


def language_table(spark, sf):
    """Languages of the documents as iso_Script, seen if a fifth of the documents or more are in it."""
    counts = Q.table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = Q.table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n")).select(F.lit("*").alias("lang"), "n")
    both = counts.unionByName(total).withColumn(
        "all", F.max(F.when(F.col("lang") == "*", F.col("n"))).over(Window.partitionBy(F.lit(0)))
    )
    langs = both.where("lang <> '*'").select(
        F.concat("lang", F.lit("_Latn")).alias("lang"), (5 * F.col("n") >= F.col("all")).cast("int").alias("is_seen")
    )
    return with_script(langs)


LANGUAGES_SQL = """
langs as (select lang || '_Latn' as lang, (5 * count(*) >= (select count(*) from documents))::INT as is_seen, lang as iso, 'Latn' as script
          from documents group by documents.lang)"""


def macro_by_seen(spark, sf):
    results = _results(spark, sf, Q.TEMPLATES).withColumn("lang", F.concat("lang", F.lit("_Latn")))
    out = R.macro_by_seen(results, language_table(spark, sf), ["task", "template", "metric"])
    return out.withColumn("macro_mean", F.round("macro_mean", 6))


MACRO_SQL = BOTH_SQL.rstrip() + "," + LANGUAGES_SQL + """
select task, template, metric, is_seen, script, round(avg(value), 6) as macro_mean, count(*)::BIGINT as languages,
       grouping(task, template, metric, is_seen, script)::BIGINT as level
from (select res.*, is_seen, script from res join langs on res.lang || '_Latn' = langs.lang)
group by grouping sets ((task, template, metric, is_seen, script), (task, template, metric, is_seen),
                        (task, template, metric, script), (task, template, metric))"""


def cost_estimate(spark, sf):
    """Cost of the choice, generation and rolling requests of the stand-in tasks, in words."""
    n = lambda c: F.size(words(F.col(c))).cast("bigint")
    choice = P.choice_requests(Q.with_context(spark, sf, 0)).select("task", "req_type", "ctx", "cont")
    pairs = Q.generation_pairs(spark, sf).select(F.lit("reply").alias("task"), F.col("source").alias("ctx"))
    generation = P.generation_requests(pairs, ["\n"], None, 0).select("task", "req_type", "ctx", F.lit("").alias("cont"))
    texts = Q.table(spark, sf, "documents").select(F.lit("rolling").alias("task"), "text")
    rolling = P.perplexity_requests(texts).select("task", "req_type", "ctx", "cont")
    requests = choice.unionByName(generation).unionByName(rolling)
    priced = R.cost_estimate(requests.withColumn("tokens", R.request_tokens(F.col("req_type"), n("ctx"), n("cont"))))
    return priced.withColumns({p: F.round(p, 6) for p in R.PRICES})


COST_SQL = Q.with_sql(Q.RENDERED_SQL, Q.PAIRS_SQL, f"""
req as (select 'langid' as task, 4 * (len({Q.words_sql("text_prompt")}) + 1) as tokens from r
        union all select 'reply', len({Q.words_sql("source")}) + 256 from pairs
        union all select 'rolling', len({Q.words_sql("text")}) + 2048 from documents),
tot as (select coalesce(task, '**Total**') as task, sum(tokens)::BIGINT as tokens from req group by rollup (task))""") + """
select task, tokens, round(tokens / 1000::DOUBLE * 0.0008::DOUBLE, 6) as ada, round(tokens / 1000::DOUBLE * 0.0012::DOUBLE, 6) as babbage,
       round(tokens / 1000::DOUBLE * 0.006::DOUBLE, 6) as curie, round(tokens / 1000::DOUBLE * 0.06::DOUBLE, 6) as davinci from tot"""


def task_catalog(spark, sf):
    """Each language's documents as a task of its own, with the figures of its metric tag."""
    docs = split_docs(spark, sf).withColumn("task", F.concat("task", F.lit("_"), "lang"))
    names = docs.select("task").distinct()
    figures = F.array(*[F.lit(m) for m in G.FIGURES_OF_TAG["Accuracy"]])
    metrics = names.select("task", F.posexplode(figures).alias("at", "metric"))
    return R.task_catalog(docs, metrics)


CATALOG_SQL = f"""
with {SPLIT_SQL}
select 'langid_' || lang as task, case when count(*) filter (split = 'train') > 0 then '✓' else ' ' end as train,
       case when count(*) filter (split = 'validation') > 0 then '✓' else ' ' end as val,
       case when count(*) filter (split = 'test') > 0 then '✓' else ' ' end as test,
       case when count(*) filter (split = 'test') > 0 then count(*) filter (split = 'test')
            else count(*) filter (split = 'validation') end::BIGINT as eval_docs,
       'acc, acc_norm' as metrics
from splits group by lang"""


def _datasets(spark, sf):
    """Each source is a dataset; the languages are its subsets."""
    sources = Q.table(spark, sf, "documents").select("doc_id", F.col("source").alias("dataset"))
    return split_docs(spark, sf).join(sources, "doc_id").withColumnRenamed("lang", "subset")


def _dataset_templates(spark, sf):
    """Every subset has the two templates; one whose name ends in an even digit has the second only."""
    subsets = _datasets(spark, sf).select("dataset", "subset").distinct()
    both = subsets.select("*", F.explode(F.array(F.lit("named"), F.lit("short"))).alias("name"))
    even = F.substring("dataset", -1, 1).cast("int") % 2 == 0
    return both.where((F.col("name") == "short") | ~even).withColumn("original_task", F.col("name") == "named")


def dataset_overview(spark, sf):
    return R.dataset_overview(_datasets(spark, sf), _dataset_templates(spark, sf))


OVERVIEW = f"""
o as (select source as dataset, s.lang as subset, count(*) filter (split = 'train') as train_size,
             count(*) filter (split = 'validation') as validation_size, count(*) filter (split = 'test') as test_size,
             case when right(source, 1)::INT % 2 = 0 then 1 else 2 end as prompts,
             case when right(source, 1)::INT % 2 = 0 then 0 else 1 end as original_prompts,
             case when right(source, 1)::INT % 2 = 0 then 'short' else 'named, short' end as prompt_names
      from splits s join documents using (doc_id) group by source, s.lang)"""
OVERVIEW_SQL = f"""
with {SPLIT_SQL}, {OVERVIEW}
select dataset, subset, train_size::BIGINT as train_size, validation_size::BIGINT as validation_size, test_size::BIGINT as test_size,
       prompts::BIGINT as prompts, original_prompts::BIGINT as original_prompts, prompt_names from o"""


def overview_totals(spark, sf):
    return R.overview_totals(dataset_overview(spark, sf))


TOTALS_SQL = f"""
with {SPLIT_SQL}, {OVERVIEW}
select count(*)::BIGINT as datasets, sum(prompts)::BIGINT as prompts, sum(train_size)::BIGINT as training_instances from o"""


def train_share(spark, sf):
    sizes = _datasets(spark, sf).groupBy("dataset").agg(F.count_if(F.col("split") == "train").alias("train_size"))
    return R.train_share(sizes).withColumn("top3_percent", F.round("top3_percent", 6))


SHARE_SQL = f"""
with {SPLIT_SQL},
z as (select source as dataset, count(*) filter (split = 'train') as train_size from splits join documents using (doc_id) group by source),
k as (select *, row_number() over (order by train_size desc, dataset) as k from z)
select round(100.0::DOUBLE * sum(train_size) filter (k <= 3) / sum(train_size), 6) as top3_percent,
       arg_max(dataset, (train_size, dataset)) as biggest, max(train_size)::BIGINT as biggest_size,
       arg_min(dataset, (train_size, dataset)) filter (train_size > 0) as smallest,
       (min(train_size) filter (train_size > 0))::BIGINT as smallest_size
from k"""


def language_filter(spark, sf):
    """Sources as dataset names with the languages of their documents; some have an owner."""
    docs = Q.table(spark, sf, "documents")
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("int")
    name = F.when(number % 4 == 0, F.concat(F.lit("owner"), (number % 3).cast("string"), F.lit("/"), "source")).otherwise(
        F.when(number % 2 == 0, F.upper("source")).otherwise(F.col("source"))
    )
    datasets = docs.groupBy(name.alias("name")).agg(F.collect_set("lang").alias("languages"))
    return R.language_filter(datasets, ["es", "it"], ["owner1"])


FILTER_SQL = """
with d as (select case when k % 4 = 0 then 'owner' || (k % 3) || '/' || source when k % 2 = 0 then upper(source) else source end as name, lang
           from (select *, regexp_extract(source, '([0-9]+)$', 1)::INT as k from documents)),
s as (select name, list(distinct lang) as languages from d group by name)
select name from s where case when contains(name, '/') then split_part(name, '/', 1) = 'owner1' else list_contains(languages, 'es') end"""


def run_keys(spark, sf):
    """Run names of evaluations of each source and language, some limited."""
    groups = Q.table(spark, sf, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    fields = {
        "model": F.concat(F.lit("org/"), "source"),
        "task": F.lit("langid"),
        "lang": lang_of_path(F.concat(F.lit("data/langid/"), "lang")),
        "templates": F.lit("all_templates"),
        "fewshot": F.lit(3),
        "batchsize": F.when(F.col("n") > 5, F.lit(4)),
        "seed": F.lit(Q.SEED),
    }
    return groups.select("source", "lang", run_key(fields, F.when(F.col("n") % 2 == 0, F.col("n"))).alias("run"))


RUN_SQL = f"""
select source, lang, case when n % 2 = 0 then 'limited=' || n || '.' else '' end || 'model=org-' || source || '.task=langid.lang=' || lang
       || '.templates=all_templates.fewshot=3.' || case when n > 5 then 'batchsize=4.' else '' end || 'seed={Q.SEED}' as run
from (select source, lang, count(*) as n from documents group by all)"""


def written_results(spark, sf):
    """Result files of the zero-shot run, written and read back: rows and scores per file kind and language."""
    out = f"{checkpoint_dir(spark)}/results-{uuid.uuid4().hex}"
    picked = materialize(picked_docs(spark, sf, 0), f"{out}/{stage_key('dummy', 'langid', 4)}")
    results = G.aggregate_results(M.long_metrics(picked, [*P.BY, "doc_id"], ["acc", "acc_norm"]), P.BY)
    folders = write_results(R.with_logging_info(results, templates_table(spark, Q.TEMPLATES)), picked, f"{out}/files")
    rows = None
    for kind, folder in folders.items():
        score = "acc double" if kind == "examples" else "value double"
        read = spark.read.schema(f"{score}, task string, lang string").json(folder)
        part = read.groupBy("lang").agg(
            F.count(F.lit(1)).alias("rows"), F.round(F.sum(score.split(" ")[0]), 6).alias("total")
        ).withColumn("kind", F.lit(kind))
        rows = part if rows is None else rows.unionByName(part)
    return rows


WRITTEN_SQL = Q.ZERO_SHOT_SQL.rstrip() + "," + RESULTS_SQL + """
select lang, count(*)::BIGINT as rows, round(sum(value), 6) as total, kind
from res, (select unnest(['agg', 'slim']) as kind) group by lang, kind
union all
select lang, count(*)::BIGINT, round(sum((pred = target)::INT), 6), 'examples' from picked group by lang"""


def run_manifests(spark, sf):
    """Two published runs, read back with their configuration and versions; a third was cut off and does not show."""
    out = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    picked = materialize(picked_docs(spark, sf, 0), f"{out}/{stage_key('dummy', 'langid', 4)}")
    results = G.aggregate_results(M.long_metrics(picked, [*P.BY, "doc_id"], ["acc", "acc_norm"]), P.BY)
    for run, part in {"accuracy": results.where("metric = 'acc'"), "whole": results}.items():
        publish_run(part, picked, out, run, {"model": "dummy", "shots": 0}, {Q.LANGID.task: 1})
    write_results(results, picked, f"{out}/cut")
    runs = published_runs(spark, out)
    read = [read_run(spark, out, r["run"]).withColumn("run", F.lit(r["run"])) for r in runs.select("run").collect()]
    rows = read[0]
    for part in read[1:]:
        rows = rows.unionByName(part)
    return rows.join(F.broadcast(runs), "run").select(
        "run", "task", "lang", "metric", F.round("value", 6).alias("value"),
        F.col("config")["model"].alias("model"), F.col("config")["shots"].alias("shots"),
        F.col("versions")[F.col("task")].alias("version"), "result_rows", "example_rows",
    )


MANIFESTS_SQL = Q.ZERO_SHOT_SQL.rstrip() + "," + RESULTS_SQL + """,
runs as (select *, 'whole' as run from res union all select *, 'accuracy' from res where metric = 'acc')
select run, task, lang, metric, round(value, 6) as value, 'dummy' as model, '0' as shots, '1' as version,
       count(*) over (partition by run)::BIGINT as result_rows, (select count(*) from picked)::BIGINT as example_rows
from runs"""


def flatten_struct(spark, sf):
    docs = Q.table(spark, sf, "documents")
    sizes = F.struct(F.col("n_chars").alias("chars"), F.struct(count_words(F.col("text")).alias("spaces")).alias("words"))
    nested = docs.select("doc_id", F.struct(F.col("lang").alias("code"), sizes.alias("size")).alias("doc"))
    return flatten(nested)


FLATTEN_SQL = f"""
select doc_id, lang as doc_code, n_chars as doc_size_chars, len({Q.space_split_sql("text")})::BIGINT as doc_size_words_spaces from documents"""

QUERIES = {
    "results_table": (results_table, TABLE_SQL),
    "results_table_short": (results_table_short, SHORT_SQL),
    "results_markdown": (markdown, MARKDOWN_SQL),
    "slim_results": (slim, SLIM_SQL),
    "logging_info": (logging_info, LOGGING_SQL),
    "language_table": (language_table, "with " + LANGUAGES_SQL + " select * from langs"),
    "macro_by_seen": (macro_by_seen, MACRO_SQL),
    "cost_estimate": (cost_estimate, COST_SQL),
    "task_catalog": (task_catalog, CATALOG_SQL),
    "dataset_overview": (dataset_overview, OVERVIEW_SQL),
    "overview_totals": (overview_totals, TOTALS_SQL),
    "train_share": (train_share, SHARE_SQL),
    "language_filter": (language_filter, FILTER_SQL),
    "run_keys": (run_keys, RUN_SQL),
    "written_results": (written_results, WRITTEN_SQL),
    "run_manifests": (run_manifests, MANIFESTS_SQL),
    "flatten_struct": (flatten_struct, FLATTEN_SQL),
}

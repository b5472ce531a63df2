"""Few-shot evaluation of all tasks, templates and languages in one job."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyspark.functions.hashing import content_key
from polyspark.functions.text import strip
from polyspark.operators import aggregates as G
from polyspark.operators import doc_metrics as M
from polyspark.operators import prompts as P
from polyspark.operators import scoring as S
from polyspark.operators.metric_tags import metric_rows
from polyspark.operators.reports import with_logging_info
from polyspark.sources.sinks import materialize
from polyspark.sources.tasks import eval_docs, fewshot_docs
from polyspark.sources.templates import Template, templates_table

Scorer = Callable[[DataFrame], DataFrame]
END_OF_TEXT = "</s>"


def prompts(
    docs: DataFrame,
    templates: list[Template],
    k: int,
    seed: int,
    limit: int | None = None,
    valid: Column | None = None,
    source: str | None = None,
) -> DataFrame:
    """Prompts of the evaluation split, with examples from the few-shot split.

    ``docs`` has task, lang, split, doc_id (unique per task and language) and the fields. Documents
    that are not ``valid`` are left out before the limit counts. The field ``source`` comes along
    under that name.
    """
    groups = ["task", "lang"]
    fields = [c for c in docs.columns if c not in (*groups, "split", "doc_id")]
    keyed = docs.withColumn("content", content_key(*[F.col(c) for c in fields]))
    wanted = eval_docs(keyed, groups)
    if valid is not None:
        wanted = P.drop_invalid(wanted, valid)
    if limit is not None:
        wanted = P.shuffle_limit(wanted, groups, "doc_id", seed, limit).drop("position")
    narrow = [*P.BY, "doc_id", "content", "text_prompt", "target", "choices", "metrics"]
    raw = [F.col(source).alias("source")] if source else []
    rendered = P.render(wanted, templates).select(*narrow, *raw)
    sampled = None
    if k:
        pool = P.render(fewshot_docs(keyed, groups), templates).select(
            *P.BY,
            F.col("doc_id").alias("row_id"),
            "content",
            P.format_example(F.col("text_prompt"), F.col("target")).alias("example"),
        )
        sampled = P.fewshot_sample(pool, rendered, k, seed)
    return P.fewshot_context(rendered, sampled, k, source="fewshot")


def responses(requests: DataFrame, score: Scorer, once: bool = False, cache_path: str | None = None) -> DataFrame:
    """Requests with ll, is_greedy and generated.

    ``once`` sends requests that are equal to the model one time, and ``cache_path`` only those that
    are not in the cache; the model then gets request_key, req_type, ctx, cont and args alone.
    """
    row = [*P.BY, "doc_id", "req_idx"]
    if cache_path:
        return S.cached_scores(requests, cache_path, score, row)
    if not once:
        return score(requests)
    unique = S.dedup_requests(requests)
    answers = score(unique).select("request_key", "origins", *[c for c in ("ll", "is_greedy", "generated")])
    return S.scatter_back(requests, answers, row)


def evaluate(
    docs: DataFrame,
    templates: list[Template],
    score: Scorer = S.score_dummy,
    k: int = 3,
    seed: int = 1234,
    limit: int | None = None,
    scores_path: str | None = None,
    overwrite: bool = False,
    valid: Column | None = None,
    source: str | None = None,
    stops: list[str] | None = None,
    max_length: int | None = None,
    once: bool = False,
    cache_path: str | None = None,
) -> dict[str, DataFrame]:
    """``results`` per task, template, language and metric, and ``examples`` per document.

    A template with answer choices is scored choice by choice; one without is generated, cut at
    ``stops`` and compared with its target by the metric tags it carries. All templates end in one
    long table of results, each with its aggregate and standard error, and every document of
    every template is one example. ``source`` names the field that SARI takes as raw text. The
    facts of a template stand on results and examples.

    With ``scores_path`` the answers are written once, without their contexts, so that results and
    examples do not run the model twice.
    """
    keys = [*P.BY, "doc_id"]
    shots = ["fewshot_idx", "fewshot_source", "fewshot_num"]
    tags = sorted({m for t in templates for m in t.metrics})
    long, examples = [], []

    def kept(answers: DataFrame, name: str) -> DataFrame:
        return materialize(answers, f"{scores_path}/{name}", overwrite) if scores_path else answers

    chosen = [t for t in templates if t.answer_choices is not None]
    if chosen:
        requests = P.choice_requests(prompts(docs, chosen, k, seed, limit, valid))
        answers = responses(requests, score, once, cache_path)
        answers = kept(answers.select(*keys, "target", "req_idx", "choice", "ll", *shots), "choices")
        picked = M.pick_choice(answers, keys)
        is_of = lambda t: (F.col("task") == t.task) & (F.col("template") == t.name)
        metrics = F.coalesce(*[F.when(is_of(t), F.array(*map(F.lit, t.metrics)).cast("array<string>")) for t in chosen])
        long.append(metric_rows(picked.withColumn("metrics", metrics), keys, tags, choice=True))
        examples.append(picked.withColumn("generated", F.lit(None).cast("string")))
    written = [t for t in templates if t.answer_choices is None]
    if written:
        requests = P.generation_requests(prompts(docs, written, k, seed, limit, valid, source), stops or [], max_length, k)
        answers = responses(requests, score, once, cache_path)
        cut = S.cut_generation(F.col("generated"), F.col("args.stop_sequences"), F.lit(k), END_OF_TEXT)
        raw = ["source"] if source else []
        answers = kept(answers.select(*keys, "target", "metrics", "generated", strip(cut).alias("pred"), *raw, *shots), "generations")
        long.append(metric_rows(answers, keys, tags, choice=False))
        none = F.lit(None).cast("double")
        examples.append(answers.select(*keys, "pred", "target", none.alias("acc"), none.alias("acc_norm"), "generated"))
    rows = [x for x in long if x is not None]
    if not rows:
        raise ValueError("no template has a metric of its kind")
    results = G.aggregate_results(reduce(DataFrame.unionByName, rows), P.BY)
    table = templates_table(docs.sparkSession, templates)
    return {name: with_logging_info(df, table) for name, df in (("results", results), ("examples", reduce(DataFrame.unionByName, examples)))}


def perplexity(scored: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """Word perplexity, byte perplexity and bits per byte from documents with ``ll``."""
    pairs = M.perplexity_pairs(M.perplexity_parts(scored, text), by)
    return G.aggregate_results(pairs, by)

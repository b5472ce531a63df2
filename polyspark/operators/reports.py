"""Tables for people: results, costs, catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyspark.operators.prompts import GENERATION, ROLLING


def _five_digits(value: Column) -> Column:
    """Five significant digits without trailing zeros; an exponent below 1e-4 and from 1e5."""
    scientific = F.format_string("%.4e", value)
    exponent = F.element_at(F.split(scientific, "e"), 2).cast("int")
    short = lambda text: F.regexp_replace(F.regexp_replace(text, "(\\.[0-9]*?)0+$", "$1"), "\\.$", "")
    mantissa = short(F.element_at(F.split(scientific, "e"), 1))
    out = F.concat(mantissa, F.lit("e"), F.element_at(F.split(scientific, "e"), 2))
    for e in range(-4, 5):
        out = F.when(exponent == e, short(F.format_string(f"%.{4 - e}f", value))).otherwise(out)
    return F.when(value == 0, F.lit("0")).otherwise(out)


def results_table(results: DataFrame, version: str = "version", style: str = "full", by: tuple[str, ...] = ()) -> DataFrame:
    """Text columns of the results table.

    ``full``: the version on the first metric of a task and template only, four decimals,
    blanks without a standard error. ``short``: five significant digits.
    """
    if style == "short":
        return results.select(
            *by,
            F.col("template").alias("prompt_name"),
            "metric",
            _five_digits(F.col("value")).alias("mean"),
            _five_digits(F.col("stderr")).alias("stderr"),
        )
    first = F.row_number().over(Window.partitionBy("task", "template", *by).orderBy("metric")) == 1
    four = lambda c: F.format_string("%.4f", F.col(c))
    return results.select(
        *by,
        F.col("task").alias("Task"),
        F.col("template").alias("Prompt"),
        F.when(first, F.col(version).cast("string")).otherwise(F.lit("")).alias("Version"),
        F.col("metric").alias("Metric"),
        four("value").alias("Value"),
        F.when(F.col("stderr").isNotNull(), F.lit("±")).otherwise(F.lit("")).alias("pm"),
        F.when(F.col("stderr").isNotNull(), four("stderr")).otherwise(F.lit("")).alias("Stderr"),
    )


def markdown_rows(table: DataFrame) -> DataFrame:
    """Each row of a table of texts as a markdown line."""
    return table.select(F.concat(F.lit("|"), F.concat_ws("|", *table.columns), F.lit("|")).alias("line"))


def with_logging_info(df: DataFrame, templates: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """Template facts, and dataset facts if given, on each example or result."""
    facts = templates.select(
        "task",
        F.col("name").alias("template"),
        F.col("name").alias("prompt_name"),
        F.col("id").alias("prompt_id"),
        F.col("jinja").alias("prompt_jinja"),
        F.col("original_task").alias("prompt_original_task"),
        F.when(
            ~F.contains("answer_choices", F.lit("{{")),
            F.transform(F.split("answer_choices", "\\|\\|\\|"), lambda c: F.trim(c)),
        ).alias("fixed_answer_choice_list"),
        F.lit("").alias("comment"),
    )
    out = df.join(facts, ["task", "template"], "left")
    return out if datasets is None else out.join(datasets, "task", "left")


def macro_by_seen(results: DataFrame, langs: DataFrame, by: list[str]) -> DataFrame:
    """Mean over languages, by seen flag and script, with all subtotals; ``level`` tells them apart."""
    joined = results.join(langs.select("lang", "is_seen", "script"), "lang")
    grouped = joined.select(*by, "is_seen", "script", "value").groupingSets(
        [[*by, "is_seen", "script"], [*by, "is_seen"], [*by, "script"], by], *by, "is_seen", "script"
    )
    return grouped.agg(
        F.avg("value").alias("macro_mean"),
        F.count(F.lit(1)).alias("languages"),
        F.grouping_id().cast("bigint").alias("level"),
    )


# Price per 1000 tokens of four model sizes, and tokens a request may add.
PRICES = {"ada": 0.0008, "babbage": 0.0012, "curie": 0.006, "davinci": 0.06}
GENERATION_TOKENS = 256
ROLLING_TOKENS = 2048
TOTAL = "**Total**"


def request_tokens(req_type: Column, ctx_tokens: Column, cont_tokens: Column) -> Column:
    """Tokens a request costs at most."""
    return (
        F.when(req_type == GENERATION, ctx_tokens + GENERATION_TOKENS)
        .when(req_type == ROLLING, cont_tokens + ROLLING_TOKENS)
        .otherwise(ctx_tokens + cont_tokens)
    )


def cost_estimate(requests: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Tokens and prices per task, most first, with a total row."""
    sums = requests.rollup("task").agg(F.sum(tokens).cast("bigint").alias("tokens"), F.grouping("task").alias("_total"))
    priced = [(F.col("tokens") / 1000 * price).alias(name) for name, price in PRICES.items()]
    return (
        sums.select(F.when(F.col("_total") == 1, F.lit(TOTAL)).otherwise(F.col("task")).alias("task"), "tokens", *priced, "_total")
        .orderBy("_total", F.col("tokens").desc(), "task")
        .drop("_total")
    )


def task_catalog(docs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per task: which splits it has, documents to evaluate, metric names. ``metrics`` is (task, metric, at)."""
    n = lambda split: F.count_if(F.col("split") == split)
    tick = lambda split: F.when(n(split) > 0, F.lit("✓")).otherwise(F.lit(" "))
    splits = docs.groupBy("task").agg(
        tick("train").alias("train"),
        tick("validation").alias("val"),
        tick("test").alias("test"),
        F.when(n("test") > 0, n("test")).otherwise(n("validation")).alias("eval_docs"),
    )
    names = metrics.groupBy("task").agg(F.array_sort(F.collect_list(F.struct("at", "metric"))).alias("_m"))
    return splits.join(names, "task", "left").select(
        "task", "train", "val", "test", "eval_docs", F.array_join(F.transform("_m", lambda m: m["metric"]), ", ").alias("metrics")
    )


NO_SUBSET = "∅"


def dataset_overview(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Per dataset and subset: split sizes, prompts, original-task prompts, prompt names; most prompts first.

    ``docs`` has dataset, subset, split; ``templates`` has dataset, subset, name, original_task.
    """
    keys = ["dataset", "subset"]
    no_null = lambda df: df.withColumn("subset", F.coalesce("subset", F.lit(NO_SUBSET)))
    n = lambda split: F.count_if(F.col("split") == split)
    sizes = no_null(docs).groupBy(*keys).agg(
        n("train").alias("train_size"), n("validation").alias("validation_size"), n("test").alias("test_size")
    )
    prompts = no_null(templates).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("prompts"),
        F.count_if("original_task").alias("original_prompts"),
        F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("prompt_names"),
    )
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("train_size", "validation_size", "test_size")}
    return prompts.join(sizes, keys, "left").withColumns(filled).orderBy(F.col("prompts").desc(), *keys)


def overview_totals(overview: DataFrame) -> DataFrame:
    return overview.agg(
        F.count(F.lit(1)).alias("datasets"),
        F.sum("prompts").cast("bigint").alias("prompts"),
        F.sum("train_size").cast("bigint").alias("training_instances"),
    )


def train_share(sizes: DataFrame, name: str = "dataset", size: str = "train_size") -> DataFrame:
    """Share of the three largest training sets, the largest, and the smallest that is not empty."""
    top = (
        sizes.orderBy(F.col(size).desc(), name).limit(3).agg(F.sum(size).alias("_top"))
    )
    ends = sizes.agg(
        F.sum(size).alias("_all"),
        F.max_by(name, F.col(size)).alias("_x"),
        F.max(F.struct(F.col(size), F.col(name))).alias("biggest"),
        F.min(F.when(F.col(size) > 0, F.struct(F.col(size), F.col(name)))).alias("smallest"),
    )
    stacked = ends.drop("_x").unionByName(top, allowMissingColumns=True)
    return stacked.agg(
        (100 * F.max("_top") / F.max("_all")).alias("top3_percent"),
        F.max(F.col("biggest")[name]).alias("biggest"),
        F.max(F.col("biggest")[size]).alias("biggest_size"),
        F.max(F.col("smallest")[name]).alias("smallest"),
        F.max(F.col("smallest")[size]).alias("smallest_size"),
    )


def language_filter(datasets: DataFrame, tags: list[str], owners: list[str]) -> DataFrame:
    """Names of datasets with one of the language tags, or of a listed owner, in order without case.

    A name with an owner (``owner/name``) is kept for its owner only.
    """
    owned = F.contains("name", F.lit("/"))
    has_tag = F.arrays_overlap("languages", F.array(*[F.lit(t) for t in tags]))
    keep = F.when(owned, F.element_at(F.split("name", "/"), 1).isin(owners)).otherwise(F.coalesce(has_tag, F.lit(False)))
    return datasets.where(keep).select("name").orderBy(F.lower("name"), "name")

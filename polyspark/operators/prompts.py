"""Documents to prompts to scoring requests."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType, StringType

from polyspark.functions import expressions as X
from polyspark.functions.hashing import hash_hex, hash_int
from polyspark.functions.joins import skew_safe_join
from polyspark.functions.ranks import position_by, position_by_hash, running_total
from polyspark.functions.text import strip, truncate
from polyspark.sources.templates import PART, Template, template_key

BY = ["task", "template", "lang"]
TOP_ROWS = 10_000


def assign_doc_ids(df: DataFrame, by: list[str], order: str, out: str = "doc_id") -> DataFrame:
    """0-based position of a document within its task's split, by a numeric unique column."""
    return position_by(df, by, order, out)


def drop_invalid(df: DataFrame, valid: Column) -> DataFrame:
    """Keeps the documents a template can be used on."""
    return df.where(valid)


def drop_empty_targets(df: DataFrame) -> DataFrame:
    """The filter of translation tasks: no empty reference."""
    return drop_invalid(df, F.col("target") != "")


def shuffle_limit(
    df: DataFrame, by: list[str], id_col: str, seed: int, limit: int | None = None, out: str = "position"
) -> DataFrame:
    """Position in a seeded shuffle of each group, and only the first ``limit`` if given."""
    hashed = df.withColumn("_hash", hash_hex(seed, F.col(id_col)))
    if limit is not None and limit <= TOP_ROWS:
        # Spark keeps only the first rows of each partition before the shuffle.
        window = Window.partitionBy(*by).orderBy("_hash", id_col)
        top = hashed.withColumn("_row", F.row_number().over(window)).where(F.col("_row") <= limit)
        return top.withColumn(out, (F.col("_row") - 1).cast("bigint")).drop("_row", "_hash")
    placed = position_by_hash(hashed, by, "_hash", [F.col(id_col)], out).drop("_hash")
    return placed if limit is None else placed.where(F.col(out) < limit)


# --- templates to columns -------------------------------------------------------------------

# The span that marks a substituted value.
HIGHLIGHT = ("<span style='color: #F08080'>", "</span>")


def highlight(text: Column) -> Column:
    return F.concat(F.lit(HIGHLIGHT[0]), text, F.lit(HIGHLIGHT[1]))


def choose(items: Column, *seed) -> Column:
    """An element of an array picked by a hash of ``seed`` (else of the array); null for an empty array."""
    size = F.size(items)
    seed = seed or (F.to_json(items),)
    return F.when(size > 0, F.try_element_at(items, (hash_int(*seed) % F.greatest(size, F.lit(1)) + 1).cast("int")))


def modes(items: Column) -> Column:
    """All most frequent elements of a short array, in order of first appearance; null if empty."""
    distinct = F.array_distinct(items)
    counted = F.transform(
        distinct, lambda x: F.struct(F.size(F.filter(items, lambda y: y.eqNullSafe(x))).alias("n"), x.alias("x"))
    )
    most = F.array_max(F.transform(counted, lambda c: c["n"]))
    return F.when(F.size(items) > 0, F.transform(F.filter(counted, lambda c: c["n"] == most), lambda c: c["x"]))


FILTERS = X.FILTERS | {
    "highlight": lambda value: X.Value(highlight(value.column), StringType()),
    "choice": lambda value: X.Value(choose(value.column), value.type.elementType),
    "most_frequent": lambda value: X.Value(modes(value.column), value.type),
}


def _modes_of(kind: ArrayType) -> Callable[[Column], Column]:
    """``modes`` of arrays of any length; items must be equal in Python where they are in Spark."""

    @F.arrow_udf(kind)
    def run(items: pa.Array) -> pa.Array:
        rows = []
        for row in items.to_pylist():
            counts = Counter(row)
            most = max(counts.values())
            rows.append([item for item, n in counts.items() if n == most])
        return pa.array(rows, items.type)

    return run


def most_frequent(df: DataFrame, keys: list[str], items: str, out: str = "modes") -> DataFrame:
    """All most frequent elements of an array column of any length, per ``keys``.

    A row that has its keys for itself is counted where it is; the items of rows with equal keys, and items that are
    neither texts nor whole numbers, are exploded and grouped.
    """
    kind = df.schema[items].dataType
    rows = df.select(*keys, F.col(items).alias("_items")).where(F.size("_items") > 0)
    if not (kind.elementType == StringType() or isinstance(kind.elementType, IntegralType)):
        return _grouped_modes(rows, keys, out)
    rows = rows.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    alone = rows.where(F.col("_rows") == 1).select(*keys, _modes_of(kind)(F.col("_items")).alias(out))
    return alone.unionByName(_grouped_modes(rows.where(F.col("_rows") > 1), keys, out))


def _grouped_modes(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    counts = (
        rows.select(*keys, F.posexplode("_items").alias("_pos", "_item"))
        .groupBy(*keys, "_item")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_pos"))
    )
    best = counts.groupBy(*keys).agg(F.max("_n").alias("_n"))
    return (
        counts.join(best, [*keys, "_n"], "left_semi")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_item"))).alias("_ranked"))
        .select(*keys, F.transform("_ranked", lambda r: r["_item"]).alias(out))
    )


def _fill(names: dict[str, X.Value], text: str, cut: bool, mark: bool = False) -> Column:
    """A piece of template text as a column; data is never split again, so it may hold ``|||``."""
    pieces = re.split(r"\{\{(.*?)\}\}", text)
    parts = []
    for i, piece in enumerate(pieces):
        if i % 2 == 0:
            parts.append(F.lit(piece))
            continue
        value = X.text_of(X.expression(piece, names, FILTERS))
        if cut:
            value = truncate(value)
        parts.append(highlight(value) if mark else value)
    return F.concat(*parts)


def prompt_columns(df: DataFrame, template: Template, cut: bool = True, mark: bool = False) -> tuple[Column, Column]:
    """Prompt and target of a template, which may use its ``answer_choices``. It must have exactly one separator."""
    parts = template.jinja.split(PART)
    if len(parts) != 2:
        raise ValueError(f"template {template.name!r} must have one {PART}")
    names = X.fields(df)
    if template.answer_choices is not None:
        names["answer_choices"] = X.Value(answer_choices(df, template), ArrayType(StringType()))
    text, target = (strip(_fill(names, p, cut, mark)) for p in parts)
    return text, target


def answer_choices(df: DataFrame, template: Template) -> Column:
    """The answer choices of a document, which may use its fields; null without choices."""
    if template.answer_choices is None:
        return F.lit(None).cast("array<string>")
    names = X.fields(df)
    return F.array(*[strip(_fill(names, c, cut=False)) for c in template.answer_choices.split(PART)])


def fixed_choices(template: Template) -> Column:
    """The answer choices if they use no field, else null."""
    if template.answer_choices is None or "{{" in template.answer_choices:
        return F.lit(None).cast("array<string>")
    return F.array(*[F.lit(c.strip()) for c in template.answer_choices.split(PART)])


def render(df: DataFrame, templates: list[Template], cut: bool = True, mark: bool = False) -> DataFrame:
    """One row per document and template of its task: template, text, target, choices.

    Templates are expressions of one projection, so no join is made.
    """
    if "answer_choices" in df.columns:
        raise ValueError("answer_choices is a reserved field name")
    rows = []
    for t in templates:
        text, target = prompt_columns(df, t, cut, mark)
        rows.append(
            F.struct(
                F.lit(t.task).alias("task"),
                F.lit(t.name).alias("template"),
                F.lit(template_key(t.task, t.name)).alias("task_template"),
                text.alias("text_prompt"),
                target.alias("target"),
                answer_choices(df, t).alias("choices"),
                F.array(*[F.lit(m) for m in t.metrics]).cast("array<string>").alias("metrics"),
            )
        )
    every = F.array(*rows)
    if "task" in df.columns:
        every = F.filter(every, lambda r: r["task"] == F.col("task"))
    return df.select(*[c for c in df.columns if c != "task"], F.inline(every))


def cross_templates(docs: DataFrame, table: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Documents x the chosen rows of a template table of the same task."""
    if names is not None:
        table = table.where(F.col("name").isin(sorted(set(names))))
    return docs.join(table.withColumnRenamed("name", "template").withColumnRenamed("id", "template_id"), "task")


# --- few-shot examples ----------------------------------------------------------------------


def fewshot_ranks(pool: DataFrame, by: list[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """Seeded permutation of the pool (``by``, row_id, content), equal contents side by side.

    Returns (rows with ``rank``, contents with ``run_start``, ``run_length``).
    """
    narrow = pool.select(*by, "row_id", "content")
    contents = (
        narrow.groupBy(*by, "content")
        .agg(F.count(F.lit(1)).alias("run_length"))
        .withColumn("_order", hash_hex(seed, F.col("content")))
        .withColumn("_prefix", F.substring("_order", 1, 3))
    )
    contents = running_total(
        contents, by, ["_prefix"], [F.col("_order"), F.col("content")], F.col("run_length"), "run_start"
    ).drop("_prefix", "_order")
    inside = running_total(
        narrow.withColumn("_part", F.substring(hash_hex(F.col("row_id")), 1, 2)),
        [*by, "content"],
        ["_part"],
        [F.col("row_id")],
        F.lit(1),
        "_inside",
    ).drop("_part")
    ranked = skew_safe_join(inside, contents, [*by, "content"], "run_length", [F.col("row_id")])
    return ranked.select(*by, "row_id", (F.col("run_start") + F.col("_inside")).alias("rank")), contents


def fewshot_sample(pool: DataFrame, docs: DataFrame, k: int, seed: int, by: list[str] = BY) -> DataFrame:
    """``k`` different pool rows per document, none equal in content to the document.

    ``pool`` has ``by``, row_id, content and what an example carries; ``docs`` has
    ``by``, doc_id, content. The ranks left after taking out the document's own run
    are cut into k strata and one rank is drawn by hash from each, so every draw
    succeeds and no pair of documents is tied together. A group with fewer than k
    other rows is an error. Result: ``by``, doc_id, slot and the pool columns.
    """
    groups = [F.col(c) for c in by]
    payload = [c for c in pool.columns if c not in [*by, "content"]]
    ranked, contents = fewshot_ranks(pool, by, seed)
    sizes = contents.groupBy(*by).agg(F.sum("run_length").alias("_n"))
    own = skew_safe_join(
        docs.select(*by, "doc_id", "content"), contents, [*by, "content"], "run_length", [F.col("doc_id")], "left"
    ).select(
        *by,
        "doc_id",
        F.coalesce(F.col("run_start") + F.col("run_length"), F.lit(0)).alias("_from"),
        F.coalesce("run_length", F.lit(0)).alias("_own"),
    )
    free = F.col("_n") - F.col("_own")
    enough = F.when(free >= k, free).otherwise(
        F.raise_error(F.lit(f"fewer than {k} few-shot rows differ from a document")).cast("bigint")
    )
    drawn = (
        own.join(sizes, by)
        .withColumn("_free", enough)
        .withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        .withColumn("_low", F.floor(F.col("_j") * F.col("_free") / F.lit(k)))
        .withColumn("_high", F.floor((F.col("_j") + 1) * F.col("_free") / F.lit(k)))
        .withColumn("_at", F.col("_low") + hash_int(seed, *groups, F.col("doc_id"), F.col("_j")) % (F.col("_high") - F.col("_low")))
        .select(
            *by,
            "doc_id",
            ((F.col("_j") + hash_int(seed, *groups, F.col("doc_id"))) % k).cast("int").alias("slot"),
            ((F.col("_from") + F.col("_at")) % F.col("_n")).alias("rank"),
        )
    )
    examples = pool.select(*by, *payload).join(ranked, [*by, "row_id"])
    return drawn.join(examples, [*by, "rank"]).drop("rank")


def format_example(text: Column, target: Column, separator: str = " ") -> Column:
    if not separator.isspace():
        raise ValueError("the separator of prompt and target must be white space")
    return F.concat(text, F.lit(separator), target)


def fewshot_context(
    docs: DataFrame,
    sampled: DataFrame | None,
    k: int,
    by: list[str] = BY,
    source: str | None = None,
    separator: str = "\n",
) -> DataFrame:
    """Adds ctx, fewshot_idx, fewshot_source and fewshot_num to rendered documents."""
    if k == 0 or sampled is None:
        return docs.withColumns(
            {
                "ctx": F.col("text_prompt"),
                "fewshot_idx": F.array().cast("array<bigint>"),
                "fewshot_source": F.lit(None).cast("string"),
                "fewshot_num": F.lit(0),
            }
        )
    shots = sampled.groupBy(*by, "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("slot", "row_id", "example"))).alias("_shots")
    )
    labelled = F.array_join(F.transform("_shots", lambda s: s["example"]), separator)
    return (
        docs.join(shots, [*by, "doc_id"])
        .withColumns(
            {
                "ctx": F.concat(labelled, F.lit(separator), F.col("text_prompt")),
                "fewshot_idx": F.transform("_shots", lambda s: s["row_id"].cast("bigint")),
                "fewshot_source": F.lit(source).cast("string"),
                "fewshot_num": F.lit(k),
            }
        )
        .drop("_shots")
    )


# --- requests -------------------------------------------------------------------------------

# The three kinds of request.
LOGLIKELIHOOD = "loglikelihood"
GENERATION = "greedy_until"
ROLLING = "loglikelihood_rolling"


def choice_requests(df: DataFrame, separator: str = " ") -> DataFrame:
    """One log-likelihood request per answer choice. A document without choices is an error, as it would vanish."""
    others = [c for c in df.columns if c != "choices"]
    missing = F.raise_error(F.lit("a document has no answer choices")).cast("array<string>")
    choices = F.when(F.size("choices") > 0, F.col("choices")).otherwise(missing)
    return df.select(*others, F.posexplode(choices).alias("req_idx", "choice")).withColumns(
        {"req_type": F.lit(LOGLIKELIHOOD), "cont": F.concat(F.lit(separator), F.col("choice"))}
    )


def generation_requests(df: DataFrame, stops: list[str], max_length: int | None, k: int) -> DataFrame:
    """One generation request per document, with its stop strings, length limit and shot count."""
    args = F.struct(
        F.array(*[F.lit(s) for s in stops]).cast("array<string>").alias("stop_sequences"),
        F.lit(max_length).cast("int").alias("max_generation_length"),
        F.lit(k).alias("num_fewshot"),
    )
    return df.withColumns({"req_idx": F.lit(0), "req_type": F.lit(GENERATION), "args": args})


def perplexity_requests(df: DataFrame, text: str = "text", k: int = 0) -> DataFrame:
    """One rolling request per document: no context, the raw text."""
    if k != 0:
        raise ValueError("perplexity takes no few-shot examples")
    return df.withColumns(
        {"req_idx": F.lit(0), "req_type": F.lit(ROLLING), "ctx": F.lit(""), "cont": F.col(text)}
    )


# The line before a shown example, and the rows of a page.
EXAMPLE_DIVIDER = "!!@@##@@!! -- Example "
PAGE_ROWS = 50


def union_splits(splits: list[DataFrame]) -> DataFrame:
    """The rows of the chosen splits, each with its place in the list as ``split_order``."""
    out = None
    for i, df in enumerate(splits):
        df = df.withColumn("split_order", F.lit(i))
        out = df if out is None else out.unionByName(df)
    return out


def prompt_preview(df: DataFrame, n: int, by: list[str], order: list[str]) -> DataFrame:
    """The first ``n`` contexts per group, with a divider line."""
    window = Window.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(window))
        .where(F.col("_row") <= n)
        .withColumn("example", F.col("_row") - 1)
        .drop("_row")
        .withColumn(
            "shown", F.concat(F.lit(EXAMPLE_DIVIDER), F.col("example").cast("string"), F.lit("\n"), F.col("ctx"), F.lit("\n"))
        )
    )


def page(df: DataFrame, by: list[str], order: str, number: int, rows: int = PAGE_ROWS) -> DataFrame:
    """The rows of one page of each group."""
    placed = position_by(df.select(*by, order), by, order, "position")
    wanted = placed.where((F.col("position") >= number * rows) & (F.col("position") < (number + 1) * rows))
    return df.join(wanted, [*by, order])


def translation_direction(df: DataFrame, dataset: str, template: str) -> DataFrame:
    """Adds src_lang and ref_lang from a dataset name ``a-b``; flipped if the template does not name the pair."""
    first = F.element_at(F.split(dataset, "-"), 1)
    second = F.element_at(F.split(dataset, "-"), 2)
    named = F.contains(F.col(template), F.col(dataset))
    return df.withColumns(
        {"src_lang": F.when(named, first).otherwise(second), "ref_lang": F.when(named, second).otherwise(first)}
    )

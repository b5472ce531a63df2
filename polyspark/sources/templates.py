"""Prompt templates, declared in Python and turned into columns or a table."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

PART = "|||"


@dataclass(frozen=True)
class Template:
    """A prompt and its target, separated by ``|||``, with ``{{field}}`` places."""

    task: str
    name: str
    jinja: str
    answer_choices: str | None = None
    reference: str = ""
    id: str = ""
    original_task: bool = False
    choices_in_prompt: bool = False
    metrics: tuple[str, ...] = ()
    languages: tuple[str, ...] = field(default=("multi",))


# The texts of the two topic-classification tasks.
NEWS_TOPIC = Template(
    task="news_topic",
    name="news_topic",
    jinja='The topic of the news "{{sent}}" is |||  {{label}}',
    answer_choices="science/technology ||| travel ||| politics ||| sports ||| health ||| entertainment ||| geography",
    id="news_topic",
    metrics=("Accuracy",),
)
VERSE_TOPIC = Template(
    task="verse_topic",
    name="verse_topic",
    jinja='The topic of the verse "{{verse}}" is |||  {{label}}',
    answer_choices="Recommendation ||| Faith ||| Description ||| Sin ||| Grace ||| Violence",
    id="verse_topic",
    metrics=("Accuracy",),
)
BUILT_IN = [NEWS_TOPIC, VERSE_TOPIC]

TABLE_SCHEMA = (
    "task string, id string, name string, jinja string, reference string, answer_choices string, "
    "original_task boolean, choices_in_prompt boolean, metrics array<string>, languages array<string>, "
    "template_key string"
)


def template_key(task: str, name: str | None) -> str:
    return f"{task}+{name or 'null'}"


def templates_table(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """One row per template."""
    rows = []
    for t in templates:
        row = asdict(t)
        row["metrics"], row["languages"] = list(t.metrics), list(t.languages)
        row["template_key"] = template_key(t.task, t.name)
        rows.append(row)
    return spark.createDataFrame(rows, TABLE_SCHEMA)


def select_templates(
    templates: list[Template], task: str, names: str = "all_templates", index: int | None = None
) -> list[Template]:
    """Templates of a task: all, those of the original task, or a comma list; sorted, no repeats."""
    of_task = {t.name: t for t in templates if t.task == task}
    if names == "all_templates":
        chosen = sorted(of_task)
    elif names == "original_templates":
        chosen = [n for n, t in of_task.items() if t.original_task]
        if not chosen:
            raise ValueError(f"no original task templates for {task}")
    else:
        chosen = names.split(",")
    if index is not None:
        chosen = [chosen[index]]
    if not chosen:
        raise ValueError("at least one template is needed")
    unknown = [n for n in chosen if n not in of_task]
    if unknown:
        raise KeyError(f"unknown templates of {task}: {unknown}")
    return [of_task[n] for n in sorted(set(chosen))]

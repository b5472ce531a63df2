"""Metric tags of templates: what each makes of a scored document, as rows (metric, value, sums).

``value`` is a document's own figure. A corpus metric has none; its ``sums`` are added up over the
documents before its closed form is taken (``aggregates.aggregate_results``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyspark.operators import corpus_metrics as CM
from polyspark.operators import doc_metrics as M
from polyspark.operators.aggregates import ROUGE_FIGURES

SUMS = f"struct<{', '.join(f'{c}: bigint' for c in CM.BLEU_SUMS)}>"


@dataclass(frozen=True)
class Tag:
    """``choice`` tags read pick_choice's rows, others rows with target and pred (and source, if ``needs_source``)."""

    rows: Callable[[DataFrame, list[str]], DataFrame]
    choice: bool = False
    needs_source: bool = False


def _long(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    return M.long_metrics(df, keys, metrics).withColumn("sums", F.lit(None).cast(SUMS))


def _accuracy(picked: DataFrame, keys: list[str]) -> DataFrame:
    return _long(picked, keys, ["acc", "acc_norm"])


def _references(df: DataFrame) -> DataFrame:
    return df.withColumn("references", F.array("target"))


def _bleu(df: DataFrame, keys: list[str]) -> DataFrame:
    stats = CM.bleu_stats(_references(df), keys, pred="pred")
    value = F.lit(None).cast("double")
    return stats.select(*keys, F.lit("bleu").alias("metric"), value.alias("value"), F.struct(*[F.col(c).cast("bigint").alias(c) for c in CM.BLEU_SUMS]).alias("sums"))


def _rouge(df: DataFrame, keys: list[str]) -> DataFrame:
    return _long(M.rouge(_references(df), keys, pred="pred"), keys, ROUGE_FIGURES)


def _sari(df: DataFrame, keys: list[str]) -> DataFrame:
    return _long(M.sari(_references(df), keys, pred="pred"), keys, ["sari"])


TAGS: dict[str, Tag] = {
    "Accuracy": Tag(_accuracy, choice=True),
    "BLEU": Tag(_bleu),
    "ROUGE": Tag(_rouge),
    "SARI": Tag(_sari, needs_source=True),
}


def metric_rows(df: DataFrame, keys: list[str], tags: Iterable[str], choice: bool) -> DataFrame | None:
    """Rows (keys, metric, value, sums) of all documents by the tags in their ``metrics`` column.

    A tag of the other kind of template, or an unknown one, makes no rows, as it does for a template
    that carries it. None if no tag is left.
    """
    usable = [t for t in sorted(set(tags)) if t in TAGS and TAGS[t].choice == choice]
    parts = []
    for name in usable:
        if TAGS[name].needs_source and "source" not in df.columns:
            raise ValueError(f"{name} needs the raw text of a document")
        parts.append(TAGS[name].rows(df.where(F.array_contains("metrics", name)), keys))
    return reduce(DataFrame.unionByName, parts) if parts else None


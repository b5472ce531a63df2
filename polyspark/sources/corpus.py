"""Corpus and language-list readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {"txt": "text", "text": "text", "csv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet"}


def pick_text(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The text column (the named one if present, else the first) as ``text``, plus ``keep``."""
    source = text_col if text_col in df.columns else df.columns[0]
    return df.select(*keep, F.col(source).alias("text"))


def read_corpus(
    spark: SparkSession,
    paths: str | list[str],
    fmt: str | None = None,
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    keep_linebreaks: bool = True,
    lang_pattern: str | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Reads raw text: one row per line (txt) or per record (csv, json, parquet).

    The format is taken from the extension unless given. ``lang_pattern`` is a regular
    expression whose first group, matched against the file path, becomes ``lang``.
    Give ``schema`` for csv and json to save the pass that infers it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    extension = fmt or paths[0].rstrip("/").rsplit(".", 1)[-1]
    if extension not in FORMATS:
        raise ValueError(f"cannot read a corpus of format {extension!r}")
    reader = spark.read.format(FORMATS[extension])
    if schema:
        reader = reader.schema(schema)
    if FORMATS[extension] == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    raw = reader.load(paths)
    columns = list(keep)
    if lang_pattern:
        raw = raw.withColumn("lang", F.regexp_extract("_metadata.file_path", lang_pattern, 1))
        columns.append("lang")
        first = next(c for c in raw.columns if c != "lang")
        text_col = text_col if text_col in raw.columns else first
    df = pick_text(raw, text_col, tuple(columns))
    if FORMATS[extension] == "text" and keep_linebreaks:
        df = df.withColumn("text", F.concat("text", F.lit("\n")))
    return df


def read_lang_list(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``language  is_seen`` lines as (lang, is_seen, iso, script)."""
    raw = spark.read.csv(path, sep="\t", schema="lang string, is_seen int")
    return with_script(raw)


def with_script(langs: DataFrame) -> DataFrame:
    """Splits ``lang`` of the form iso_Script."""
    parts = F.split("lang", "_")
    return langs.withColumns({"iso": F.element_at(parts, 1), "script": F.try_element_at(parts, F.lit(2))})

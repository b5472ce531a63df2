"""Saved stages and result files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def stage_key(model: str, data: str, vocab_size: int, block_size: int | None = None) -> str:
    """Folder name of a saved stage."""
    stage = "tokens" if block_size is None else f"blocks_{block_size}"
    return "_".join([model, stage, data, f"{vocab_size}vocab"]).replace("/", "-")


def materialize(df: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Writes ``df`` unless a finished copy is there, and reads it back.

    A folder without its success marker is an interrupted write and is written anew.
    """
    spark = df.sparkSession
    if overwrite or not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Keys a slim result drops.
BULKY_KEYS = ["fixed_answer_choice_list", "prompt_id", "prompt_jinja", "prompt_original_task", "comment"]


def run_key(fields: dict[str, Column], limit: Column | None = None) -> Column:
    """Dotted ``k=v`` run name: null fields are skipped, ``/`` becomes ``-``, limited runs say so first."""
    pairs = [
        F.when(value.isNotNull(), F.concat(F.lit(f"{key}="), value.cast("string")))
        for key, value in fields.items()
    ]
    name = F.replace(F.concat_ws(".", *pairs), F.lit("/"), F.lit("-"))
    if limit is None:
        return name
    return F.when(limit.isNull(), name).otherwise(F.concat(F.lit("limited="), limit.cast("string"), F.lit("."), name))


def lang_of_path(path: Column) -> Column:
    """The last part of a data path."""
    return F.element_at(F.split(path, "/"), -1)


def slim_results(results: DataFrame) -> DataFrame:
    return results.drop(*BULKY_KEYS)


def write_results(
    results: DataFrame,
    examples: DataFrame,
    out: str,
    by: tuple[str, ...] = ("task", "lang"),
    mode: str = "overwrite",
) -> dict[str, str]:
    """Writes aggregate, slim and per-example json lines, partitioned by ``by``; returns the folders."""
    folders = {name: f"{out}/{name}" for name in ("agg", "slim", "examples")}
    for name, df in {"agg": results, "slim": slim_results(results), "examples": examples}.items():
        df.write.mode(mode).partitionBy(*by).json(folders[name])
    return folders


MANIFEST = (
    "run string, config map<string,string>, versions map<string,string>, "
    "result_rows bigint, example_rows bigint, schemas map<string,string>"
)


def publish_run(
    results: DataFrame,
    examples: DataFrame,
    out: str,
    run: str,
    config: dict[str, object],
    versions: dict[str, object],
    by: tuple[str, ...] = ("task", "lang"),
) -> str:
    """Writes the files of a run to ``out/run``, and last its manifest: configuration, versions, rows, columns.

    Readers go by finished manifests, so they see all of a run or nothing. A run that was cut off is written anew; a
    published one is an error, so that files never change under a reader. Rows are counted in the written files,
    as counts taken on the way would be wrong if a lost executor's work is repeated.
    """
    spark, folder = results.sparkSession, f"{out}/{run}"
    if path_exists(spark, f"{folder}/manifest/_SUCCESS"):
        raise FileExistsError(f"the run is published already: {folder}")
    files = write_results(results, examples, folder, by)
    rows = {kind: spark.read.text(files[kind]).count() for kind in ("agg", "examples")}
    columns = {"agg": results, "slim": slim_results(results), "examples": examples}
    as_text = lambda values: {k: v if isinstance(v, str) else json.dumps(v, sort_keys=True) for k, v in values.items()}
    manifest = (
        run, as_text(config), as_text(versions), rows["agg"], rows["examples"],
        {kind: df.schema.json() for kind, df in columns.items()},
    )
    spark.createDataFrame([manifest], MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return folder


def published_runs(spark: SparkSession, out: str) -> DataFrame:
    """The manifests of all published runs in a folder; empty if there is none."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/*/manifest/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    folders = sorted(f.getPath().getParent().toString() for f in found or ())
    if not folders:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*folders)


def read_run(spark: SparkSession, out: str, run: str, kind: str = "agg") -> DataFrame:
    """The agg, slim or examples table of a published run, with the types it was written from."""
    folder = f"{out}/{run}"
    if not path_exists(spark, f"{folder}/manifest/_SUCCESS"):
        raise FileNotFoundError(f"no published run: {folder}")
    schemas = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").first()["schemas"]
    schema = T.StructType.fromJson(json.loads(schemas[kind]))
    return spark.read.schema(schema).json(f"{folder}/{kind}").select(*schema.names)


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested struct fields as top-level columns named by their path."""

    def leaves(schema, path):
        for f in schema.fields:
            here = [*path, f.name]
            if f.dataType.typeName() == "struct":
                yield from leaves(f.dataType, here)
            else:
                yield here

    return df.select(
        *[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(df.schema, [])]
    )

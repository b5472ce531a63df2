"""Session settings the operators are written for."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a small shuffle before costly work (n-grams, Python) still uses every core
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where the split costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # rows differ in length: a batch of long texts ends by its bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Applies the settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a context: their Python need not have it installed.

    The driver serves the archive to executors, so it may lie in the driver's own folder.
    """
    context = spark.sparkContext
    if getattr(context, "_has_polyspark", None):
        return
    package = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="polyspark-"), "polyspark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent).as_posix())
    context.addPyFile(archive)
    context._has_polyspark = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and saved stages.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own, since its executors are this process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="polyspark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def saved(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: computed once, lineage cut.

    One pass, where ``checkpoint()`` computes its input a second time to write it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table that ``saved`` wrote, once nothing built from it will run again."""
    jvm, path = df.sparkSession._jvm, getattr(df, "saved_at", None)
    if path:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartitions a scan that has fewer splits than the cluster has cores; else leaves it alone.

    For input in a few files that cannot be split. A large table has many splits and
    gets no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def local_session(cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("polyspark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)

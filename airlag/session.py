"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Skewed joins and skewed writes are split at run time, and files are written
# at a size that keeps the file count of a large table low. Parquet files grow
# several times in memory; the factor keeps broadcasts within their size check.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def get_spark(app: str = "airlag", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Python workers that share this machine find the package where the driver
    did; on a cluster the package is installed or sent with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is not set, on a
    single machine, one beside the tables in ``spark.sql.warehouse.dir``. On a
    cluster that may be a local path that other executors do not see, so there
    the setting is needed."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base and not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def set_checkpoint_folder(spark: SparkSession) -> None:
    """Let ``checkpoint()`` write to that folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(application_folder(spark))


def application_folder(spark: SparkSession) -> str:
    """This application's part of the checkpoint folder, removed when it ends."""
    path = f"{checkpoint_folder(spark)}/airlag-{spark.sparkContext.applicationId}"
    files, target = _on_file_system(spark, path)
    if not files.exists(target):
        files.mkdirs(target)
        files.deleteOnExit(target)
    return path


_roots: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path for stored data: below the folder of the run that is going
    on (see ``run_scratch``), else below the application's."""
    base = _roots[-1] if _roots else application_folder(spark)
    return f"{base}/{uuid.uuid4().hex}"


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """One folder for all scratch data of a run, removed when the run ends."""
    root = scratch_dir(spark)
    _roots.append(root)
    try:
        yield root
    finally:
        _roots.remove(root)
        files, target = _on_file_system(spark, root)
        files.delete(target, True)


@contextmanager
def arrow_batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs run inside hand Python workers batches of about ``most`` bytes, not
    ten thousand rows of any length."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back, so that later uses start from files
    (column pruning still applies) and survive lost executors."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _on_file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of the file system itself."""
    files, target = _on_file_system(spark, path)
    return files.exists(target)


def list_folder(spark: SparkSession, path: str, suffix: str) -> list[tuple[str, str]]:
    """(path, name) of the files directly in a folder, by name."""
    files, target = _on_file_system(spark, path)
    found = [status for status in files.listStatus(target) if status.isFile()]
    pairs = [(s.getPath().toString(), s.getPath().getName()) for s in found]
    return sorted((p for p in pairs if p[1].endswith(suffix)), key=lambda pair: pair[1])

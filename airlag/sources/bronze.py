"""CSV batches into the bronze table."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlag.sources.csv_files import CsvFile, inspect_files, list_csv, read_csv
from airlag.sources.tables import AppendTable, utc_now

BATCH_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    ]
)


def inspect_all(spark: SparkSession, folder: str) -> list[CsvFile]:
    """Every CSV file of the folder, by name."""
    return inspect_files(spark, list_csv(spark, folder))


def ingest_csv(spark: SparkSession, folder: str, table: AppendTable) -> list[int]:
    """Append each non-empty file of ``folder`` as its own version, by name.

    Neighbouring files with the same schema are read and written in one job;
    their rows are told apart by the file they came from. A second run appends
    the files again.
    """
    return append_files(spark, inspect_all(spark, folder), table)


def new_files(spark: SparkSession, folder: str, table: AppendTable) -> dict[str, tuple[str, str]]:
    """Name -> (path, mark) of the files that the table has not loaded yet. A
    file is known by its name, size and time, so a changed one is new. Files are
    listed, not read, and held against the log in Spark."""
    listed = dict((name, path) for path, name in list_csv(spark, folder))
    files = spark.read.format("binaryFile").load(list(listed.values()))
    seen = F.concat_ws("|", F.element_at(F.split("path", "/"), -1), "length", F.unix_millis("modificationTime"))
    marked = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), seen.alias("token"))
    log = table.log()
    if log is not None:
        marked = marked.join(log.select("token"), "token", "left_anti")
    return {row.name: (listed[row.name], row.token) for row in marked.collect()}


def ingest_new(spark: SparkSession, folder: str, table: AppendTable) -> list[int]:
    """Append the files that are not in the table yet, as ``ingest_csv`` does."""
    found = new_files(spark, folder, table)
    if not found:
        return []
    files = inspect_files(spark, sorted(((path, name) for name, (path, _) in found.items()), key=lambda x: x[1]))
    return append_files(spark, files, table, tokens={name: mark for name, (_, mark) in found.items()})


def append_files(
    spark: SparkSession,
    files: list[CsvFile],
    table: AppendTable,
    token: str | None = None,
    tokens: dict[str, str] | None = None,
) -> list[int]:
    """Append inspected files; with a ``token``, or ``tokens`` by file name, at
    most once for each token."""
    added: list[int] = []
    filled = [f for f in files if not f.empty]
    for _, run in groupby(filled, key=lambda f: (f.schema.json(), f.layout)):
        batch = list(run)
        first = table.next_version()
        ids = [first + i for i in range(len(batch))]
        rows = tag_batches(spark, batch, ids)
        marks = [f"{token}/{f.name}" for f in batch] if token else tokens and [tokens[f.name] for f in batch]
        operation = "stream" if token else "append" if first else "overwrite"
        added += table.append(rows, ids, operation, marks)
    return added


def tag_batches(spark: SparkSession, batch: list[CsvFile], ids: list[int]) -> DataFrame:
    """Rows with ``source_file``, ``ingestion_timestamp`` and ``batch_id``.

    The tags are a row for each listed file, a list that the driver holds; sent to
    every task, they spare a shuffle of all rows by the file they came from.
    """
    tags = spark.createDataFrame(
        [(f.name, i, utc_now()) for f, i in zip(batch, ids)], BATCH_SCHEMA
    )
    rows = read_csv(spark, batch[0], [f.path for f in batch])
    columns = [*batch[0].schema.names, "source_file", "ingestion_timestamp", "batch_id"]
    lost = F.raise_error(F.concat(F.lit("unexpected file "), F.col("source_file")))
    return (
        rows.join(F.broadcast(tags), "source_file", "left")
        .withColumn("batch_id", F.coalesce("batch_id", lost.cast("bigint")))
        .select(*[F.col(c) for c in columns])
    )

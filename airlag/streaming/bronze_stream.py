"""Bronze as a stream: arriving CSV files become versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlag.sources.bronze import append_files
from airlag.sources.csv_files import inspect_files
from airlag.sources.tables import AppendTable


def new_files(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    """A stream of ``path, name`` of arriving CSV files. Of a binary file only
    the columns asked for are read, and its content is not."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


def ingest_stream(
    spark: SparkSession,
    folder: str,
    table: AppendTable,
    checkpoint: str,
    files_per_batch: int = 1,
) -> None:
    """Process all files not seen before by this checkpoint, then stop.

    The stream tells which files are new, by name and time alone: it reads no
    content. Each micro-batch types its files from all their cells and appends
    them, as a load of the folder does. What names a
    micro-batch is this checkpoint with the batch number, kept beside the
    version: a batch replayed after a failure adds nothing twice, and rows that
    came into the table another way stand in nobody's way. Files without rows
    add nothing.
    """
    files = new_files(spark, folder, files_per_batch)

    def append(batch: DataFrame, number: int) -> None:
        # At most files_per_batch names.
        found = sorted((tuple(row) for row in batch.collect()), key=lambda pair: pair[1])
        if found:
            append_files(spark, inspect_files(spark, found), table, token=f"{checkpoint}#{number}")

    query = (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

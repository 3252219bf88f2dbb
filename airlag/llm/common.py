"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlag.session import let_workers_import, materialize, scratch_dir

__all__ = [
    "balanced", "crc_remainder", "join_grown", "keep_rows", "let_workers_import", "materialize", "partitions",
    "read", "scratch_dir", "strings", "text_bytes",
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_grown(
    left: DataFrame, right: DataFrame, on: Column | list[str], how: str = "inner"
) -> DataFrame:
    """A join of two sides that both grow with the corpus. Neither has a size
    bound, so neither may be broadcast, however small it is in one run."""
    return left.join(right.hint("merge"), on, how)


def crc_remainder(doc_id: Column | str = "doc_id") -> Column:
    """``crc32`` of an id as text, modulo 4: remainder 2 marks held-out rows.
    A null id counts as the empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def strings(column: pa.Array) -> pa.Array:
    """An Arrow text column with null read as the empty text."""
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def keep_rows(docs: DataFrame, wanted: Callable[[pa.Array], np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose texts (null: empty) are wanted: a map over
    Arrow batches that leaves every column as it is."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted(strings(batch.column(place))), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, UTF-8 bytes) of a large-string column without nulls."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return bounds - bounds[0], whole[bounds[0] : bounds[-1]]


def balanced(texts: pa.Array, most: int) -> Iterator[slice]:
    """Row ranges of a large-string column that hold about ``most`` bytes each;
    a longer text is a range of its own."""
    bounds, _ = text_bytes(texts)
    begin, rows = 0, len(texts)
    while begin < rows:
        end = int(np.searchsorted(bounds, bounds[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), rows)
        yield slice(begin, end)
        begin = end

"""Token counts per document, without keeping any ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import strings
from airlag.llm.encode import encoder


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per input row.

    A map over Arrow batches, without a shuffle: only lengths leave Python. The
    encoder cuts each batch into calls of equal bytes, and long texts at places
    where the tokenizer splits anyway, so whole texts are counted in bounded
    memory. Null text counts as empty (0 bytes, 0 tokens); repeated rows and
    null ids stay as they are; other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts = strings(batch.column(1))
            tokens = encode.count(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(np.asarray(tokens > limit), pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

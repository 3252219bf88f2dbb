"""A training corpus from raw documents, in five stages.

Every stage gets what its predecessor kept, written as Parquet and read again.
All handle null and empty texts (they count as empty, and stay unless a stage's
rule takes them), null ids, rows that repeat, empty tables, and columns whose
names the operators use themselves; ties are settled by id, then by content.
Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlag.llm import quality
from airlag.llm.common import crc_remainder, let_workers_import, materialize, read
from airlag.llm.decontaminate import remove_contaminated
from airlag.llm.line_dedup import dedup_lines
from airlag.llm.near_dedup import keep_one
from airlag.llm.packing import pack
from airlag.llm.queries import WORD_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores at 0.5 or more. It is fitted on the
    stage's own labelled documents, without those that op9 holds out; without
    labels of both kinds nothing is rejected. Equal texts score alike."""
    let_workers_import(spark)
    labels = read(spark, sf_dir, "labels").where(crc_remainder() != 2)
    return quality.keep_good(docs, quality.fit(docs, labels))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 50 words or more; a
    document that loses all its lines goes. Rows that repeat id and text are one
    document and lose the same lines."""
    own = {c: f"__{c}" for c in ("n_lines", "n_removed", "removed") if c in docs.columns}
    found = dedup_lines(docs.withColumnsRenamed(own)).where("n_removed < n_lines")
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    found = found.withColumn("n_chars", changed).drop("n_lines", "n_removed", "removed")
    return found.withColumnsRenamed({hidden: c for c, hidden in own.items()}).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id;
    null and empty texts are one group, and a null id comes last."""
    return keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item (all the
    words of a shorter one); items without words hit nothing."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, placed in sequences of 4096. A null or empty text is one
    piece, the end id; every row, repeated or not, has pieces of its own."""
    return pack(docs, public_tokenizers.path(WORD_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A fitted model and a tokenizer are no SQL; the tests hold the stages against
#: plain versions of them: line dedup and decontamination against their SQL twins,
#: near dedup against all pairs, packing against the library, and the quality
#: stage against the scores of its model.
ORACLE_SQL = None

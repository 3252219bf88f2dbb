"""Fill values learned from training rows: medians and modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlag.functions.profiles import exact_median, with_range_ranks


def feature_values(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(feature, v, n): how often each known value of each column occurs."""
    pairs = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("v"))
                for c in columns
            ]
        )
    )
    return (
        df.select(pairs)
        .where(F.col("v").isNotNull())
        .groupBy("feature", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, fill): the exact median of each column."""
    counts = with_range_ranks(feature_values(df, columns, "double"), ["feature"])
    return counts.groupBy("feature").agg(exact_median().alias("fill"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, fill): the most frequent value, the smallest on ties."""
    counts = feature_values(df, columns, "string")
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("v").alias("value")))
    return counts.groupBy("feature").agg(best.alias("best")).select(
        "feature", F.col("best.value").alias("fill")
    )


def fill(df: DataFrame, fills: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of ``columns`` replaced by their ``fill``; one small row per
    column is looked up, and each column keeps its place."""
    found = fills.select(F.map_from_entries(F.collect_list(F.struct("feature", "fill"))))
    lookup = found.scalar()

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.col("fills")[name]).alias(name)

    wanted = set(columns)
    return df.withColumn("fills", lookup).select(
        *[filled(c) if c in wanted else F.col(c) for c in df.columns]
    )


def known_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [name for name in names if name in df.columns]


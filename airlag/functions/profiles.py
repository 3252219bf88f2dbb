"""Grouped delay measures built from one value-frequency table.

An exact quantile needs the ordered values of a group. Instead of moving rows,
the rows are first counted per (group, value): the map side already shrinks
them to one row per distinct delay, whatever the share of a hot group. Delays
are whole minutes inside the silver bounds, so a group has at most 421 values.
All other measures ride along as sums, so rows are shuffled once and the
counted table once; no join back is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlag.functions.columns import is_late
from airlag.session import materialize

P95 = 0.95


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, means: Sequence[str] = ()
) -> DataFrame:
    """Rows per (keys, value) as ``n``, with sum and count of each of ``means``."""
    sums: list[Column] = []
    for name in means:
        sums += [
            F.sum(name).alias(f"{name}__sum"),
            F.count(name).alias(f"{name}__n"),
        ]
    return df.groupBy(*keys, F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("n"), *sums
    )


def with_ranks(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``known`` (non-null rows of the group) and ``upto`` (rows with a
    value not above this one)."""
    group = Window.partitionBy(*keys)
    running = group.orderBy(F.col("v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    weight = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(F.lit(0))
    return (
        counts.withColumn("weight", weight)
        .withColumn("known", F.sum("weight").over(group))
        .withColumn("upto", F.sum("weight").over(running))
    )


def with_range_ranks(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``with_ranks``, for groups with any number of distinct values.

    Values are cut into ranges, each range is summed on its own, and a range's
    offset follows from the totals of the ranges before it: no task sees more
    than one range, and one row per range and group is all that meets. The
    counts are stored, so that both uses see the same ranges.
    """
    weight = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(F.lit(0))
    ranged = counts.withColumn("weight", weight).repartitionByRange(*keys, "v")
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "range").agg(F.sum("weight").alias("total"))
    group = Window.partitionBy(*keys, F.lit(0))
    earlier = group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys,
        "range",
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"),
        F.sum("total").over(group).alias("known"),
    )
    inside = Window.partitionBy(*keys, "range").orderBy(F.col("v").asc_nulls_first())
    running = F.sum("weight").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        ranged.withColumn("upto", running)
        .join(totals, [*keys, "range"])
        .withColumn("upto", F.col("upto") + F.col("before"))
        .drop("before", "range")
    )


def value_at(index: Column) -> Column:
    """The value at a zero-based position of the ordered group."""
    here = (index < F.col("upto")) & (index >= F.col("upto") - F.col("weight"))
    return F.max(F.when(here, F.col("v")))


def nearest_quantile(q: float) -> Column:
    """Nearest-rank quantile: the value at ``round((n - 1) * q)``."""
    return value_at(F.floor((F.col("known") - 1) * F.lit(q) + F.lit(0.5)))


def exact_median() -> Column:
    """Midpoint of the two middle values."""
    low = F.floor((F.col("known") - 1) / 2)
    high = F.ceil((F.col("known") - 1) / 2)
    return (value_at(low) + value_at(high)) / 2


def mean_of(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}__sum"), F.sum(f"{name}__n"))


def mean_value() -> Column:
    return F.try_divide(F.sum(F.col("v") * F.col("weight")), F.sum("weight"))


def late_rate() -> Column:
    late = F.when(is_late(F.col("v")), F.col("n")).otherwise(F.lit(0))
    return F.try_divide(F.sum(late), F.sum("weight"))


def delay_profile(
    df: DataFrame,
    keys: Sequence[str],
    measures: dict[str, Column],
    means: Sequence[str] = (),
    value: str = "arr_delay",
) -> DataFrame:
    """One row per ``keys`` with the given measures over the ranked counts;
    without keys, one row."""
    counts = value_counts(df, keys, value, means)
    ranked = with_ranks(counts, keys) if keys else with_range_ranks(counts, keys)
    return ranked.groupBy(*keys).agg(
        *[column.alias(name) for name, column in measures.items()]
    )

"""File layout: partition rebalancing and multi-column clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rebalance(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring rows of one partition together, in tasks of about equal size.

    Unlike a plain repartition, the adaptive planner splits a partition that
    is too large for one task and merges those that are small.
    """
    return df.hint("rebalance", *by)


def sortable(value: Column, kind: str) -> Column:
    """Numbers as they are; text as a whole number that grows with its first
    seven bytes."""
    if kind != "string":
        return value
    head = F.substring(F.rpad(value.cast("binary"), 7, F.lit(bytes(7))), 1, 7)
    return F.conv(F.hex(head), 16, 10).cast("bigint")


def range_bounds(df: DataFrame, names: Sequence[str], bits: int) -> dict[str, list]:
    """The ends of ``2**bits`` ranges of about as many rows each, for every
    column, from one scan and one aggregate. The driver gets the ends only."""
    kinds, parts = dict(df.dtypes), 1 << bits
    ends = [F.lit(i / parts) for i in range(1, parts)]
    accuracy = F.lit(64 * parts)
    found = df.agg(*[F.percentile_approx(sortable(F.col(n), kinds[n]), F.array(*ends), accuracy).alias(n) for n in names])
    return {n: row or [] for n, row in found.first().asDict().items()}


def bucket_of(value: Column, bounds: Sequence, bits: int) -> Column:
    """How many of the bounds lie below a value, by halving: no join, and as
    many steps as there are bits. Nulls are in bucket 0. Every step looks at the
    value, so it should be a column and not an expression."""
    if not bounds:
        return F.lit(0)
    ends = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.get(ends, at + step - 1) < value, step).otherwise(0)
    )
    # Two uses of the value also keep Spark from putting its expression into the steps.
    return F.when(value.isNull(), 0).otherwise(found)


def interleave(buckets: Sequence[Column], bits: int) -> Column:
    """Bit-interleaved key: bit i of column c lands at position i * n + c."""
    key = F.lit(0).cast("bigint")
    width = len(buckets)
    for bit in range(bits):
        for place, bucket in enumerate(buckets):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key.bitwiseOR(F.shiftleft(one, bit * width + width - 1 - place))
    return key


def zorder_layout(
    df: DataFrame,
    cluster_by: Sequence[str],
    partition_by: Sequence[str],
    spread_by: Sequence[str],
    files: int,
    bits: int = 8,
) -> DataFrame:
    """Rows arranged so that each file covers a small box of ``cluster_by``.

    Files never span partitions, so the partition columns lead the range key.
    ``spread_by`` ends it: when one box holds a large share of the rows, the
    range exchange can still cut through it.
    """
    kinds, bounds = dict(df.dtypes), range_bounds(df, cluster_by, bits)
    buckets = [bucket_of(F.col(f"{n}__value"), bounds[n], bits) for n in cluster_by]
    ranges = [*partition_by, "z", "spread"]
    return (
        df.withColumns({f"{n}__value": sortable(F.col(n), kinds[n]) for n in cluster_by})
        .withColumns({f"{n}__bucket": bucket for n, bucket in zip(cluster_by, buckets)})
        .withColumn("z", interleave([F.col(f"{n}__bucket") for n in cluster_by], bits))
        .withColumn("spread", F.xxhash64(*spread_by))
        .repartitionByRange(files, *ranges)
        .sortWithinPartitions(*ranges)
        .select(*df.columns)
    )

"""Keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def never_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Source rows replace target rows with equal keys; all others stay.

    With plain equality a null key part matches nothing, so such target rows
    skip the join (and its shuffle) altogether. ``null_safe`` treats nulls as
    equal. ``source`` must be unique on ``keys``.
    """
    if null_safe:
        left, right = target.alias("t"), source.select(*keys).alias("s")
        same = reduce(
            lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
        )
        kept = left.join(right, same, "left_anti")
    else:
        full = never_null(keys)
        kept = (
            target.where(full)
            .join(source.select(*keys).where(full), list(keys), "left_anti")
            .select(*target.columns)
            .unionByName(target.where(~full))
        )
    return kept.unionByName(source)

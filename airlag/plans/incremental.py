"""A run that takes only what came since the last one.

New files become batches; only batches after the last one that silver holds are
cleaned; of their rows those go into silver whose key it does not have, for the
earliest batch of a key wins. Marts and features are built again for the months
that these rows can change, and the folders of all other months pass into the
new versions as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlag.config import BUSINESS_KEY, PARTITIONS
from airlag.operators import clean as C
from airlag.operators import features
from airlag.plans.stages import (
    BATCH_ORDER, MARTS, Lakehouse, earliest, exact_column_case, maintain_silver, merged_mark,
    process_silver, run_ml,
)
from airlag.session import materialize, run_scratch
from airlag.sources.bronze import ingest_new

Months = list[tuple]


def last_merged(house: Lakehouse) -> int | None:
    """The last batch that silver holds, by the marks of its versions."""
    mark = F.regexp_extract("token", "^bronze:([0-9]+)$", 1).try_cast("bigint")
    return house.silver.log().agg(F.max(mark)).first()[0] if house.silver.exists() else None


def process_new_silver(house: Lakehouse, coalesce_layouts: bool = False) -> DataFrame | None:
    """Clean the batches after the last merged one and add their new rows.

    Returns the rows that were added, stored; all of silver if it was made by
    this call, or if nothing tells what it holds; None without any row.
    """
    done, newest = last_merged(house), house.bronze.version()
    if done is None:
        return None if process_silver(house, coalesce_layouts) is None else house.silver.read()
    if done >= newest:
        return None
    rows = C.clean(house.bronze.read(after=done), BATCH_ORDER, coalesce_layouts)
    return house.silver.insert(materialize(earliest(rows)), BUSINESS_KEY, PARTITIONS, merged_mark(newest))


def touched_months(house: Lakehouse, added: DataFrame) -> Months:
    """Partitions whose marts or features the added rows can change: their own
    months, and those of any row of the same date, whose load counts they share."""
    own = added.select(*PARTITIONS)
    dates = added.select("flight_date").distinct()
    shared = house.silver.read().join(dates, "flight_date", "left_semi").select(*PARTITIONS)
    return [tuple(row) for row in own.unionByName(shared).distinct().collect()]


def in_months(months: Months) -> Column:
    each = [
        reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(PARTITIONS, month)))
        for month in months
    ]
    return reduce(lambda a, b: a | b, each)


def process_new_gold(house: Lakehouse, months: Months) -> None:
    """Marts and features of the touched months; a table that is not parted by
    month yet is written whole, in parts."""
    silver = house.silver.read()
    tables = [(house.mart(name), build) for name, build in MARTS.items()]
    for table, build in [*tables, (house.features, features.ml_features)]:
        rows = silver.where(in_months(months)) if table.partitioned() else silver
        table.replace_partitions(build(rows), PARTITIONS, months)


def run_incremental(house: Lakehouse, coalesce_layouts: bool = False, learn: bool = True) -> Months:
    """All stages over what is new. Returns the touched months; without any,
    nothing after bronze is written. ``learn`` also fits the models anew."""
    with exact_column_case(house.spark), run_scratch(house.spark):
        ingest_new(house.spark, house.settings.path("raw"), house.bronze)
        added = process_new_silver(house, coalesce_layouts)
        months = [] if added is None or added.isEmpty() else touched_months(house, added)
        if months:
            maintain_silver(house)
            process_new_gold(house, months)
            if learn:
                run_ml(house)
        return months

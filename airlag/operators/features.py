"""Feature table: the label and six load counts per flight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlag.functions.columns import is_late

# Columns of the feature table.
FEATURE_COLUMNS = [
    "flight_date", "year", "month", "airline", "origin", "dest", "route", "distance",
    "hour", "day_of_week", "season", "dep_delay", "arr_delay",
]

# Output name -> columns that, with the date, say which flights are counted.
LOAD_COUNTS = {
    "origin_day_flights": ["origin"],
    "dest_day_flights": ["dest"],
    "airline_day_flights": ["airline"],
    "route_day_flights": ["route"],
    "origin_hour_flights": ["origin", "hour"],
    "route_hour_flights": ["route", "hour"],
}
#: Rows whose cells one task ranks; a task holds them once for each window.
ROWS_PER_TASK = 200_000
CELL = ["flight_date", "airline", "origin", "dest", "route", "hour"]


def load_counts(silver: DataFrame) -> DataFrame:
    """The six counts for every (date, airline, origin, dest, route, hour).

    Flights are counted per cell before anything is grouped by date, so a date
    that holds a large share of all flights still has at most one row per
    combination of airline, route and hour. One exchange by date then serves
    all six windows; its tasks follow from the number of rows, for left to
    itself it has as few as there are cores, and what a task holds grows with
    the table. ``silver`` is counted first, so it should be stored.
    """
    tasks = max(16, -(-silver.count() // ROWS_PER_TASK))
    cells = silver.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")).repartition(tasks, "flight_date")
    return cells.select(
        *CELL,
        *[
            F.sum("n").over(Window.partitionBy("flight_date", *by)).cast("int").alias(name)
            for name, by in LOAD_COUNTS.items()
        ],
    )


def ml_features(silver: DataFrame) -> DataFrame:
    """Thirteen silver columns, ``is_delayed`` and the six counts.

    Nulls form groups of their own, hence the null-safe match. The join is on
    the full cell, and a hot cell is split by the adaptive skew join.
    """
    counts = load_counts(silver).alias("c")
    rows = silver.select(*FEATURE_COLUMNS).alias("s")
    same_cell = None
    for name in CELL:
        match = F.col(f"s.{name}").eqNullSafe(F.col(f"c.{name}"))
        same_cell = match if same_cell is None else same_cell & match
    return rows.join(counts, same_cell).select(
        *[F.col(f"s.{name}") for name in FEATURE_COLUMNS],
        is_late(F.col("s.arr_delay")).cast("tinyint").alias("is_delayed"),
        *[F.col(f"c.{name}") for name in LOAD_COUNTS],
    )

"""Bronze to silver: name resolution, filters, derived columns, first-wins dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlag.config import ARR_DELAY_MAX, ARR_DELAY_MIN
from airlag.functions.columns import (
    column_for,
    dashed,
    flag_is_zero,
    normalize_code,
    required_column,
    route,
    scheduled_hour,
    season,
)

# Silver name -> accepted raw names, in order of preference.
RAW_NAMES = {
    "year": ("Year", "YEAR"),
    "month": ("Month", "MONTH"),
    "day_of_week": ("DayOfWeek", "DAY_OF_WEEK"),
    "cancelled": ("Cancelled", "CANCELLED"),
    "airline": ("IATA_Code_Marketing_Airline", "AIRLINE"),
    "flight_number": ("Flight_Number_Marketing_Airline", "FLIGHT_NUMBER"),
    "origin": ("Origin", "ORIGIN_AIRPORT"),
    "dest": ("Dest", "DESTINATION_AIRPORT"),
    "crs_dep_time": ("CRSDepTime", "SCHEDULED_DEPARTURE"),
    "dep_delay": ("DepDelay", "DEPARTURE_DELAY"),
    "crs_arr_time": ("CRSArrTime", "SCHEDULED_ARRIVAL"),
    "arr_delay": ("ArrDelay", "ARRIVAL_DELAY"),
    "distance": ("Distance", "DISTANCE"),
}
# Silver types of what bronze may hold as text, when some cell of
# the column was no number.
NUMBER_TYPES = {
    "year": "bigint", "month": "bigint", "day_of_week": "bigint", "cancelled": "double",
    "flight_number": "bigint", "crs_dep_time": "bigint", "dep_delay": "double",
    "crs_arr_time": "bigint", "arr_delay": "double", "distance": "double",
}
DIVERTED = ("Diverted", "DIVERTED")
DAY = ("DAY",)
FULL_DATE = ("FlightDate",)

# Columns of the silver table.
SILVER_COLUMNS = [
    "flight_date", "year", "month", "day_of_week", "airline", "flight_number",
    "origin", "dest", "crs_dep_time", "dep_delay", "crs_arr_time", "arr_delay",
    "distance", "hour", "season", "route",
]


def resolve_columns(
    df: DataFrame, carry: Sequence[str] = (), coalesce_layouts: bool = False
) -> DataFrame:
    """Raw columns of either layout under one set of names.

    ``diverted`` is present only if the input has it. ``carry`` columns pass
    through. With ``coalesce_layouts`` a frame that holds both layouts yields
    rows of both; by default the first name found wins.
    """
    df = numbers_from_text(df)
    raw = {
        name: required_column(df, names, coalesce_layouts)
        for name, names in RAW_NAMES.items()
    }
    diverted = column_for(df, DIVERTED, coalesce_layouts)
    columns = [
        flight_date(df, raw["year"], raw["month"], coalesce_layouts).alias("flight_date"),
        *[column.alias(name) for name, column in raw.items()],
    ]
    if diverted is not None:
        columns.append(diverted.alias("diverted"))
    return df.select(*columns, *carry)


def numbers_from_text(df: DataFrame) -> DataFrame:
    """Text columns that silver needs as numbers, read as such; a cell that is
    no number, or no whole one where that is needed, becomes null."""
    kinds = {raw: NUMBER_TYPES[name] for name, names in RAW_NAMES.items() if name in NUMBER_TYPES for raw in names}
    kinds |= {**dict.fromkeys(DIVERTED, "double"), **dict.fromkeys(DAY, "bigint")}
    changed = {}
    for name, kind in df.dtypes:
        if kind == "string" and name in kinds:
            number = F.col(name).try_cast("double")
            if kinds[name] == "bigint":
                whole = F.when(number == F.floor(number), number).try_cast("bigint")
                number = F.coalesce(F.col(name).try_cast("bigint"), whole)
            changed[name] = number
    return df.withColumns(changed) if changed else df


def flight_date(
    df: DataFrame, year: Column, month: Column, coalesce_layouts: bool = False
) -> Column:
    """Text date: the full date, else year-month-day, else year-month."""
    full, day = column_for(df, FULL_DATE), column_for(df, DAY)
    parts = dashed(year, month, day) if day is not None else dashed(year, month)
    if full is None:
        return parts
    if coalesce_layouts and day is not None:
        return F.coalesce(full.cast("string"), parts)
    return full.cast("string")


def keep_flown(df: DataFrame) -> DataFrame:
    """Not cancelled, not diverted, with an arrival delay inside the bounds."""
    kept = flag_is_zero(df, F.col("cancelled"))
    if "diverted" in df.columns:
        kept = kept & flag_is_zero(df, F.col("diverted"))
    delay = F.col("arr_delay")
    return df.where(
        kept & delay.isNotNull() & delay.between(ARR_DELAY_MIN, ARR_DELAY_MAX)
    )


def derive(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The 16 silver columns from the resolved ones."""
    codes = df.withColumns(
        {name: normalize_code(F.col(name)) for name in ("airline", "origin", "dest")}
    )
    return codes.withColumns(
        {
            "hour": scheduled_hour(F.col("crs_dep_time")),
            "season": season(F.col("month")),
            "route": route(F.col("origin"), F.col("dest")),
        }
    ).select(*SILVER_COLUMNS, *carry)


def clean(
    df: DataFrame, carry: Sequence[str] = (), coalesce_layouts: bool = False
) -> DataFrame:
    """Resolve, filter and derive; duplicates stay."""
    resolved = resolve_columns(df, carry, coalesce_layouts)
    return derive(keep_flown(resolved), carry)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys are equal here.

    Spark turns ``row_number = 1`` into a group limit that also runs before
    the shuffle, so a key with very many copies sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("copy_no", F.row_number().over(first))
        .where(F.col("copy_no") == 1)
        .drop("copy_no")
    )

"""Gold marts and the reports read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.functions.columns import delay_bucket, is_late
from airlag.functions.profiles import (
    P95,
    delay_profile,
    exact_median,
    late_rate,
    mean_of,
    mean_value,
    nearest_quantile,
)


def airline_delay(silver: DataFrame) -> DataFrame:
    mart = delay_profile(
        silver,
        ["year", "month", "airline"],
        {
            "flight_count": F.sum("n"),
            "avg_arr_delay": mean_value(),
            "median_arr_delay": exact_median(),
            "p95_arr_delay": nearest_quantile(P95),
            "delay_rate": late_rate(),
            "avg_dep_delay": mean_of("dep_delay"),
            "avg_distance": mean_of("distance"),
        },
        means=["dep_delay", "distance"],
    )
    return mart.orderBy("year", "month", F.desc_nulls_first("avg_arr_delay"))


def route_delay(silver: DataFrame) -> DataFrame:
    mart = delay_profile(
        silver,
        ["year", "month", "origin", "dest", "route"],
        {
            "flight_count": F.sum("n"),
            "avg_arr_delay": mean_value(),
            "median_arr_delay": exact_median(),
            "p95_arr_delay": nearest_quantile(P95),
            "delay_rate": late_rate(),
            "avg_distance": mean_of("distance"),
        },
        means=["distance"],
    )
    return mart.orderBy("year", "month", F.desc_nulls_first("avg_arr_delay"))


def time_delay(silver: DataFrame) -> DataFrame:
    mart = delay_profile(
        silver,
        ["year", "month", "day_of_week", "hour", "season"],
        {
            "flight_count": F.sum("n"),
            "avg_arr_delay": mean_value(),
            "median_arr_delay": exact_median(),
            "delay_rate": late_rate(),
            "avg_dep_delay": mean_of("dep_delay"),
        },
        means=["dep_delay"],
    )
    return mart.orderBy("year", "month", "day_of_week", "hour")


def airport_delay(silver: DataFrame) -> DataFrame:
    """Both roles of every airport from one scan.

    Rows are summed per route first; the two roles are unfolded from those
    sums, not from the flights.
    """
    legs = silver.groupBy("year", "month", "origin", "dest").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("arr_delay").alias("arr_sum"),
        F.count("arr_delay").alias("arr_n"),
        F.sum("dep_delay").alias("dep_sum"),
        F.count("dep_delay").alias("dep_n"),
        F.count_if(is_late(F.col("arr_delay"))).alias("late"),
    )
    ends = F.inline(
        F.array(
            F.struct(F.col("origin").alias("airport"), F.lit("origin").alias("airport_role")),
            F.struct(F.col("dest").alias("airport"), F.lit("destination").alias("airport_role")),
        )
    )
    sums = ["n", "arr_sum", "arr_n", "dep_sum", "dep_n", "late"]
    mart = (
        legs.select("year", "month", *sums, ends)
        .groupBy("year", "month", "airport", "airport_role")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )
    departing = F.when(
        F.col("airport_role") == "origin", F.try_divide(F.col("dep_sum"), F.col("dep_n"))
    )
    return mart.select(
        "year",
        "month",
        "airport",
        F.col("n").alias("flight_count"),
        departing.alias("avg_dep_delay"),
        F.try_divide(F.col("arr_sum"), F.col("arr_n")).alias("avg_arr_delay"),
        F.try_divide(F.col("late"), F.col("arr_n")).alias("delay_rate"),
        "airport_role",
    )


def overview(silver: DataFrame) -> DataFrame:
    """One row over all of silver.

    Distinct counts come from the table of (airline, origin, dest, route)
    combinations, so flights are not multiplied by the four distinct columns.
    """
    combos = silver.groupBy("airline", "origin", "dest", "route").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("flight_date").alias("first"),
        F.max("flight_date").alias("last"),
    )

    def n_unique(name: str):
        """Null counts as one value."""
        has_null = F.coalesce(F.max(F.col(name).isNull().cast("bigint")), F.lit(0))
        return F.count_distinct(name) + has_null

    delays = delay_profile(
        silver,
        [],
        {
            "mean_arr_delay": mean_value(),
            "median_arr_delay": exact_median(),
            "p95_arr_delay": nearest_quantile(P95),
            "delay_rate": late_rate(),
        },
    )
    names = delays.columns
    shape = combos.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.min("first").alias("min_flight_date"),
        F.max("last").alias("max_flight_date"),
        n_unique("airline").alias("airlines"),
        n_unique("origin").alias("origins"),
        n_unique("dest").alias("destinations"),
        n_unique("route").alias("routes"),
    )
    return shape.withColumn("delays", delays.select(F.struct(*names)).scalar()).select(
        *shape.columns, *[F.col(f"delays.{name}").alias(name) for name in names]
    )


def delay_histogram(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(delay_bucket(F.col("arr_delay")).alias("delay_bucket"))
        .agg(F.count(F.lit(1)).alias("flights"))
        .orderBy("delay_bucket")
    )


def mean_by_airline_origin_hour(silver: DataFrame) -> DataFrame:
    return silver.groupBy("airline", "origin", "hour").agg(
        F.avg("arr_delay").alias("avg_arr_delay")
    )


def month_mean(silver: DataFrame, year: int, month: int) -> DataFrame:
    """Means of one month; the predicate prunes partitions of a stored table."""
    return mean_by_airline_origin_hour(
        silver.where((F.col("year") == year) & (F.col("month") == month))
    )


def late_mean(silver: DataFrame) -> DataFrame:
    return mean_by_airline_origin_hour(silver.where(is_late(F.col("arr_delay"))))


def worst(mart: DataFrame, ties: list[str], n: int = 10) -> DataFrame:
    """The ``n`` rows with the highest mean delay."""
    return mart.orderBy(F.desc_nulls_first("avg_arr_delay"), *ties).limit(n)


def first_hours(mart: DataFrame, n: int = 24) -> DataFrame:
    return mart.orderBy("day_of_week", "hour", "year", "month", "season").limit(n)

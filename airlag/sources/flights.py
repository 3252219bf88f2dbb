"""Flights derived from the order tables, in the two raw layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the order lines that fix which of two equal keys came first.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# Names of layout A and of layout B.
LAYOUT_A_TO_B = {
    "Year": "YEAR",
    "Month": "MONTH",
    "DayOfWeek": "DAY_OF_WEEK",
    "Cancelled": "CANCELLED",
    "Diverted": "DIVERTED",
    "IATA_Code_Marketing_Airline": "AIRLINE",
    "Flight_Number_Marketing_Airline": "FLIGHT_NUMBER",
    "Origin": "ORIGIN_AIRPORT",
    "Dest": "DESTINATION_AIRPORT",
    "CRSDepTime": "SCHEDULED_DEPARTURE",
    "DepDelay": "DEPARTURE_DELAY",
    "CRSArrTime": "SCHEDULED_ARRIVAL",
    "ArrDelay": "ARRIVAL_DELAY",
    "Distance": "DISTANCE",
}
LAYOUT_A = ["FlightDate", *LAYOUT_A_TO_B]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout A over lineitem, orders, supplier, customer and nation.

    Join strategies are left to the optimizer: every side but ``nation`` grows
    with the data, so Spark broadcasts by measured size and splits hot keys.
    """
    nation = read_table(spark, sf_dir, "nation")
    origin = nation.select(
        F.col("n_nationkey").alias("origin_key"), F.lower("n_name").alias("Origin")
    )
    dest = nation.select(
        F.col("n_nationkey").alias("dest_key"),
        F.concat("n_name", F.lit(" ")).alias("Dest"),
    )
    orders = (
        read_table(spark, sf_dir, "orders")
        .join(read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "o_orderpriority", "c_nationkey")
    )
    line = (
        read_table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origin, F.col("s_nationkey") == F.col("origin_key"))
        .join(dest, F.col("c_nationkey") == F.col("dest_key"))
    )
    shipped = F.col("l_shipdate")
    days = F.datediff(shipped, F.col("o_orderdate"))

    def clock(part: Column) -> Column:
        return (part % 24) * 100 + F.col("l_suppkey") % 60

    return line.select(
        shipped.cast("date").alias("FlightDate"),
        F.year(shipped).cast("bigint").alias("Year"),
        F.month(shipped).cast("bigint").alias("Month"),
        (F.weekday(shipped) + 1).cast("bigint").alias("DayOfWeek"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1)
        .otherwise(0)
        .cast("bigint")
        .alias("Cancelled"),
        F.when(F.col("l_linenumber") == 7, 1).otherwise(0).cast("bigint").alias("Diverted"),
        F.concat(
            F.lit("  "), F.lower(F.expr("substr(o_orderpriority, 3)")), F.lit(" ")
        ).alias("IATA_Code_Marketing_Airline"),
        (F.col("l_suppkey") % 10).alias("Flight_Number_Marketing_Airline"),
        "Origin",
        "Dest",
        clock(F.col("l_partkey")).alias("CRSDepTime"),
        F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_quantity") - 25).alias("DepDelay"),
        clock(F.col("l_partkey") + 2).alias("CRSArrTime"),
        F.when(F.col("l_discount") == 0, None)
        .otherwise((((days % 480) + 480) % 480 - 90).cast("double"))
        .alias("ArrDelay"),
        F.floor(F.col("l_extendedprice") / 10).cast("double").alias("Distance"),
        *LINE_ORDER,
    )


def arrival_order(delay: str = "ArrDelay", distance: str = "Distance",
                  departure: str = "DepDelay", clock: str = "CRSDepTime") -> list[Column]:
    """Total order of the derived rows, used to pick the first of equal keys."""
    return [
        *[F.col(name) for name in LINE_ORDER],
        F.col(delay),
        F.col(distance),
        F.col(departure).asc_nulls_last(),
        F.col(clock),
    ]


def to_layout_b(df: DataFrame, with_day: bool = True) -> DataFrame:
    """The same flights under the other names: no full date, perhaps a day."""
    day = [F.dayofmonth("FlightDate").cast("bigint").alias("DAY")] if with_day else []
    renamed = [F.col(a).alias(b) for a, b in LAYOUT_A_TO_B.items()]
    return df.select(*renamed, *day, *LINE_ORDER)

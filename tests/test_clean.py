"""Edge rows of the bronze-to-silver step."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airlag.config import BUSINESS_KEY
from airlag.operators import clean as C
from airlag.operators.marts import airline_delay, delay_histogram, overview
from airlag.plans.stages import exact_column_case, silver_source
from airlag.sources.tables import append_merged

LAYOUT_A = (
    "FlightDate date, Year bigint, Month bigint, DayOfWeek bigint, Cancelled double, "
    "Diverted double, IATA_Code_Marketing_Airline string, "
    "Flight_Number_Marketing_Airline bigint, Origin string, Dest string, CRSDepTime bigint, "
    "DepDelay double, CRSArrTime bigint, ArrDelay double, Distance double"
)
LAYOUT_B = (
    "YEAR bigint, MONTH bigint, DAY bigint, DAY_OF_WEEK bigint, CANCELLED bigint, "
    "DIVERTED bigint, AIRLINE string, FLIGHT_NUMBER bigint, ORIGIN_AIRPORT string, "
    "DESTINATION_AIRPORT string, SCHEDULED_DEPARTURE bigint, DEPARTURE_DELAY double, "
    "SCHEDULED_ARRIVAL bigint, ARRIVAL_DELAY double, DISTANCE double"
)
ROW_A = dict(
    FlightDate=dt.date(2024, 1, 15), Year=2024, Month=1, DayOfWeek=1, Cancelled=0.0,
    Diverted=0.0, IATA_Code_Marketing_Airline="WN", Flight_Number_Marketing_Airline=1,
    Origin="ISP", Dest="PBI", CRSDepTime=1735, DepDelay=6.0, CRSArrTime=2035, ArrDelay=12.0,
    Distance=1052.0,
)
ROW_B = dict(
    YEAR=2015, MONTH=1, DAY=2, DAY_OF_WEEK=5, CANCELLED=0, DIVERTED=0, AIRLINE="AA",
    FLIGHT_NUMBER=7, ORIGIN_AIRPORT="JFK", DESTINATION_AIRPORT="LAX", SCHEDULED_DEPARTURE=5,
    DEPARTURE_DELAY=1.0, SCHEDULED_ARRIVAL=900, ARRIVAL_DELAY=15.0, DISTANCE=2475.0,
)


def rows_a(spark, *changes, schema=LAYOUT_A):
    return spark.createDataFrame([{**ROW_A, **c} for c in changes], schema)


def rows_b(spark, *changes):
    return spark.createDataFrame([{**ROW_B, **c} for c in changes], LAYOUT_B)


def values(df, *names):
    return [tuple(row) for row in df.select(*names).collect()]


def test_delay_bounds(spark):
    delays = [-61.0, -60.0, 360.0, 361.0, None, float("nan")]
    df = rows_a(spark, *[{"ArrDelay": d} for d in delays])
    assert sorted(values(C.clean(df), "arr_delay")) == [(-60.0,), (360.0,)]


def test_flags(spark):
    df = rows_a(spark, {"Cancelled": 1.0}, {"Diverted": 1.0}, {"Cancelled": None}, {})
    assert C.clean(df).count() == 1
    without = df.drop("Diverted")
    assert C.clean(without).count() == 2
    boolean = rows_a(spark, {}).withColumn("Cancelled", F.lit(False))
    assert C.clean(boolean).count() == 1


def test_hours(spark):
    clocks = [5, 59, 100, 2359, 2400, None]
    df = rows_a(spark, *[{"CRSDepTime": c} for c in clocks])
    found = dict(values(C.clean(df), "crs_dep_time", "hour"))
    assert found == {5: 0, 59: 0, 100: 1, 2359: 23, 2400: 24, None: None}
    assert dict(C.clean(df).dtypes)["hour"] == "tinyint"


def test_seasons(spark):
    df = rows_a(spark, *[{"Month": m} for m in [*range(1, 13), None]])
    found = dict(values(C.clean(df), "month", "season"))
    by_season = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
    expected = {m: s for s, months in by_season.items() for m in months}
    assert found == {m: expected.get(m, "Autumn") for m in [*range(1, 13), None]}


def test_codes_and_route(spark):
    df = rows_a(
        spark,
        {"Origin": "\t aa\n", "Dest": "\u00a0bb\u3000"},
        {"Origin": None, "Dest": "BB"},
    )
    found = values(C.clean(df), "origin", "dest", "route")
    assert found == [("AA", "BB", "AA-BB"), (None, "BB", None)]
    number = df.drop("Origin").withColumn("Origin", F.lit(12))
    assert values(C.clean(number), "origin")[0] == ("12",)


def test_flight_dates(spark):
    assert values(C.clean(rows_a(spark, {})), "flight_date") == [("2024-01-15",)]
    layout_b = rows_b(spark, {}, {"DAY": None})
    assert values(C.clean(layout_b), "flight_date") == [("2015-1-2",), (None,)]
    assert values(C.clean(layout_b.drop("DAY")), "flight_date") == [("2015-1",)] * 2


def test_missing_column(spark):
    with pytest.raises(ValueError, match="CRSDepTime.*SCHEDULED_DEPARTURE"):
        C.clean(rows_a(spark, {}).drop("CRSDepTime"))


def test_sample_row_shape(spark):
    row = C.clean(rows_a(spark, {})).first()
    assert row.__fields__ == C.SILVER_COLUMNS
    assert (row.hour, row.season, row.route) == (17, "Winter", "ISP-PBI")


def test_both_layouts(spark):
    with exact_column_case(spark):
        both = append_merged([rows_a(spark, {}), rows_b(spark, {})])
        tagged = both.withColumns({"batch_id": F.lit(0), "source_file": F.lit("f")})
        assert {"Year", "YEAR"} <= set(both.columns)
        # The first name found wins, so rows of the other layout have no flag.
        assert values(silver_source(tagged), "flight_date") == [("2024-01-15",)]
        merged = silver_source(tagged, coalesce_layouts=True)
        assert sorted(values(merged, "flight_date")) == [("2015-1-2",), ("2024-01-15",)]


def test_first_copy_wins(spark):
    copies = [{"DepDelay": float(i)} for i in range(3)]
    df = rows_a(spark, *copies).withColumns(
        {"batch_id": (F.col("DepDelay") < 2).cast("int"), "source_file": F.lit("f")}
    )
    assert values(silver_source(df), "dep_delay") == [(2.0,)]
    # Null key parts are equal when duplicates are removed.
    nulls = df.withColumn("Flight_Number_Marketing_Airline", F.lit(None).cast("bigint"))
    assert silver_source(nulls).count() == 1


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = C.clean(rows_a(spark, {}, {}))
    plan = C.keep_first(df, BUSINESS_KEY, [F.col("dep_delay")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def nearest(spark, numbers):
    df = rows_a(spark, *[{"ArrDelay": float(n)} for n in numbers])
    row = airline_delay(C.clean(df)).first()
    return row.p95_arr_delay, row.median_arr_delay


def test_quantiles(spark):
    assert nearest(spark, range(12)) == (10.0, 5.5)
    assert nearest(spark, [7]) == (7.0, 7.0)
    assert nearest(spark, [1, 2]) == (2.0, 1.5)
    assert nearest(spark, [3] * 19 + [50]) == (3.0, 3.0)


def test_late_is_above_fifteen(spark):
    df = C.clean(rows_a(spark, *[{"ArrDelay": d} for d in (15.0, 15.5, 16.0)]))
    assert airline_delay(df).first().delay_rate == pytest.approx(2 / 3)
    assert values(delay_histogram(df), "delay_bucket", "flights") == [("0..15", 1), ("16..60", 2)]


def test_overview_counts_null_as_a_value(spark):
    df = C.clean(rows_a(spark, {"Origin": None}, {"Origin": "X"}))
    row = overview(df).first()
    assert (row.rows, row.origins, row.routes, row.airlines) == (2, 2, 2, 1)
    empty = overview(df.where(F.lit(False))).first()
    assert (empty.rows, empty.origins, empty.mean_arr_delay) == (0, 0, None)


def test_text_dates_compare_as_text(spark):
    df = C.clean(rows_b(spark, {"MONTH": 10, "DAY": 1}, {"MONTH": 2, "DAY": 1}))
    assert overview(df).first().min_flight_date == "2015-10-1"

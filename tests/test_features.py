"""Load counts against a brute-force count, with hot dates and null keys."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from airlag.operators import features
from airlag.operators.features import FEATURE_COLUMNS, LOAD_COUNTS, ml_features
from airlag.session import materialize


def silver_rows(spark, n=900):
    """A third of the rows share one cell; some ends are null."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(n).select(
        F.when(hot, "2024-01-01").otherwise(F.concat(F.lit("2024-02-"), (i % 7).cast("string"))).alias("flight_date"),
        F.lit(2024).cast("bigint").alias("year"),
        F.lit(1).cast("bigint").alias("month"),
        F.when(hot, "AA").otherwise((i % 4).cast("string")).alias("airline"),
        F.when(hot, "JFK").when(i % 10 == 1, None).otherwise((i % 5).cast("string")).alias("origin"),
        F.when(hot, "LAX").when(i % 11 == 1, None).otherwise((i % 6).cast("string")).alias("dest"),
        F.lit(100.0).alias("distance"),
        F.when(hot, 9).when(i % 13 == 1, None).otherwise(i % 24).cast("tinyint").alias("hour"),
        F.lit(1).cast("bigint").alias("day_of_week"),
        F.lit("Winter").alias("season"),
        F.lit(None).cast("double").alias("dep_delay"),
        (i % 40).cast("double").alias("arr_delay"),
    ).withColumn("route", F.concat("origin", F.lit("-"), "dest"))


def test_counts_equal_brute_force(spark):
    rows = [r.asDict() for r in silver_rows(spark).collect()]
    found = [r.asDict() for r in ml_features(silver_rows(spark)).collect()]
    assert len(found) == len(rows)
    for name, by in LOAD_COUNTS.items():
        keys = ["flight_date", *by]
        count = Counter(tuple(r[k] for k in keys) for r in rows)
        assert all(f[name] == count[tuple(f[k] for k in keys)] for f in found)
        # Each group sums to one.
        assert round(sum(1 / f[name] for f in found)) == len(count)


def test_shape(spark):
    df = ml_features(silver_rows(spark))
    assert df.columns == [*FEATURE_COLUMNS, "is_delayed", *LOAD_COUNTS]
    types = dict(df.dtypes)
    assert types["is_delayed"] == "tinyint"
    assert all(types[name] == "int" for name in LOAD_COUNTS)
    late = {r.arr_delay for r in df.where("is_delayed = 1").collect()}
    assert min(late) == 16.0


def test_one_exchange_serves_all_windows(spark):
    plan = ml_features(silver_rows(spark))._jdf.queryExecution().executedPlan().toString()
    # The windows themselves sit on one exchange by date; the others belong to
    # the cell count and to the join.
    by_date = [
        line for line in plan.splitlines() if "Exchange hashpartitioning(flight_date" in line
    ]
    assert sum("REPARTITION" in line for line in by_date) == 1
    assert plan.count("Window [") + plan.count("Window(") >= 1


def test_tasks_of_load_counts_follow_the_rows(spark, monkeypatch):
    rows = materialize(silver_rows(spark))
    monkeypatch.setattr(features, "ROWS_PER_TASK", 30)
    plan = features.load_counts(rows)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(flight_date#\d+, 30\), REPARTITION_BY_NUM", plan)

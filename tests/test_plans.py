"""Shapes of physical plans: what is pushed down and what is shuffled."""

from __future__ import annotations

import pytest

from airlag.operators import features, marts, ranking
from airlag.plans.queries import silver
from airlag.session import materialize


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    return materialize(silver(spark, sf_dir))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_late_mean_pushes_filter_and_columns(stored):
    plan = plan_of(marts.late_mean(stored))
    assert "GreaterThan(arr_delay,15.0)" in plan
    assert "ReadSchema: struct<airline:string,origin:string,arr_delay:double,hour:tinyint>" in plan
    assert shuffles(marts.late_mean(stored)) == 1


@pytest.mark.parametrize("build", [marts.airline_delay, marts.route_delay, marts.time_delay])
def test_marts_shuffle_flights_once(stored, build):
    """One exchange of pre-counted flights, one of the counts, one scan."""
    plan = plan_of(build(stored))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in plan or "partial_count" in plan


def test_airports_need_one_scan(stored):
    assert plan_of(marts.airport_delay(stored)).count("FileScan") == 1


def test_sampling_does_not_shuffle_the_table(stored):
    plan = plan_of(ranking.sample_exact(stored, 100, 1))
    assert "TakeOrderedAndProject" not in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize(
    "build", [marts.airline_delay, marts.overview, features.ml_features, marts.airport_delay]
)
def test_no_cross_join_and_no_python(stored, build):
    plan = plan_of(build(stored))
    for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "collect_list"):
        assert name not in plan

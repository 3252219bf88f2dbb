"""Every registered query against its SQL twin, or for rows when it has none."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from compare import connect, difference

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


def test_every_twin_has_a_query():
    from airlag.plans.oracle import ORACLE as stated

    assert set(stated) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(name, spark, sf_dir, con):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(name, spark, sf_dir):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns[:3] == ["year", "month", "airline"]
    assert not df.isEmpty()

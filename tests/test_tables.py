"""Versioned tables: append, merge, versions, layout."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airlag.config import BUSINESS_KEY, CLUSTER_BY, PARTITIONS
from airlag.operators.layout import interleave
from airlag.operators.merge import merge_upsert
from airlag.plans.queries import silver
from airlag.session import materialize
from airlag.sources import tables
from airlag.sources.tables import (
    AppendTable,
    SnapshotTable,
    expired_versions,
    table_summary,
)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return materialize(silver(spark, sf_dir))


@pytest.fixture
def snapshot(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "table"))


def same_rows(left, right):
    names = sorted(left.columns)
    left, right = left.select(*names), right.select(*names)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_append_widens_and_fills(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, 5)], "a bigint, b bigint"))
    table.append(spark.createDataFrame([(2, 2.5, "x")], "a bigint, b double, c string"))
    table.append(spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date"))
    found = {tuple(r) for r in table.read().collect()}
    day = dt.date(2024, 1, 1)
    assert found == {
        (1, 5.0, None, None, 0), (2, 2.5, "x", None, 1), (None, None, None, day, 2)
    }
    assert dict(table.read().dtypes)["b"] == "double"
    assert table.read(0).columns == ["a", "b", "batch_id"]
    assert table.version() == 2


def test_replayed_batch_adds_nothing(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    batch = spark.range(3).withColumn("batch_id", F.lit(0).cast("bigint"))
    assert table.append(batch, [0]) == [0]
    assert table.append(batch, [0]) == []
    assert table.read().count() == 3


def test_unlogged_batch_is_replaced(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    spark.range(9).write.parquet(f"{table.path}/data/batch_id=0")
    assert not table.exists()
    table.append(spark.range(3))
    assert table.read().count() == 3


def test_merge_updates_inserts_and_keeps(spark, rows, snapshot):
    snapshot.write(rows.where("year <= 1996"), PARTITIONS)
    source = materialize(rows.where("year >= 1996").withColumn("distance", F.lit(-1.0)))
    snapshot.merge(source, BUSINESS_KEY, PARTITIONS)
    expected = rows.where("year < 1996").unionByName(source)
    assert same_rows(snapshot.read(), expected)
    assert same_rows(snapshot.previous(), rows.where("year <= 1996"))
    # Folders without a matched row pass into the new version unchanged.
    live = snapshot._entry(None).folders
    assert all(f.startswith("commit=0") for f in live if "year=1995" in f)
    assert all(f.startswith("commit=1") for f in live if "year=1996" in f)


def test_merge_twice_equals_once(spark, rows, snapshot):
    snapshot.write(rows, PARTITIONS)
    snapshot.merge(rows, BUSINESS_KEY, PARTITIONS)
    assert same_rows(snapshot.read(), rows)
    assert snapshot.version() == 1


def test_a_matched_row_can_change_its_partition(spark, snapshot):
    schema = "k bigint, year bigint, v string"
    snapshot.write(spark.createDataFrame([(1, 2000, "a"), (2, 2000, "b")], schema), ["year"])
    snapshot.merge(spark.createDataFrame([(1, 2001, "c")], schema), ["k"], ["year"])
    assert {tuple(r) for r in snapshot.read().collect()} == {(1, 2001, "c"), (2, 2000, "b")}


def test_null_keys_never_match(spark):
    schema = "k bigint, v string"
    target = spark.createDataFrame([(1, "old"), (None, "old")], schema)
    source = spark.createDataFrame([(1, "new"), (None, "new")], schema)
    plain = merge_upsert(target, source, ["k"])
    assert sorted(plain.collect(), key=str) == sorted(
        [(1, "new"), (None, "new"), (None, "old")], key=str
    )
    safe = merge_upsert(target, source, ["k"], null_safe=True)
    assert sorted(safe.collect(), key=str) == sorted([(1, "new"), (None, "new")], key=str)


def test_null_partition_values_survive(spark, snapshot):
    schema = "k bigint, year bigint"
    df = spark.createDataFrame([(1, None), (2, 2000)], schema)
    snapshot.write(df, ["year"])
    snapshot.merge(spark.createDataFrame([(1, None)], schema), ["k"], ["year"])
    assert same_rows(snapshot.read(), df)


def test_text_partition_values_survive(spark, snapshot):
    schema = "k bigint, place string"
    df = spark.createDataFrame([(1, "a b:c+d%"), (2, "x")], schema)
    snapshot.write(df, ["place"])
    snapshot.merge(df.where("k = 1"), ["k"], ["place"])
    assert same_rows(snapshot.read(), df)


def test_compact_joins_small_files(spark, rows, snapshot):
    snapshot.write(rows.where("hour < 12"), PARTITIONS)
    snapshot.merge(rows.where("hour >= 12"), BUSINESS_KEY, PARTITIONS)
    before = snapshot.files().count()
    assert snapshot.compact(PARTITIONS) == 2
    assert snapshot.files().count() < before
    assert same_rows(snapshot.read(), rows)
    assert snapshot.compact(PARTITIONS) == 2


def test_cluster_keeps_rows_and_splits_a_hot_box(spark, rows, snapshot):
    hot = rows.withColumns({"origin": F.lit("A"), "dest": F.lit("B"), "hour": F.lit(1).cast("tinyint")})
    hot = hot.withColumns({"year": F.lit(1995).cast("bigint"), "month": F.lit(1).cast("bigint")})
    snapshot.write(hot, PARTITIONS)
    size = snapshot.files().agg(F.sum("length")).first()[0]
    snapshot.cluster(CLUSTER_BY, PARTITIONS, BUSINESS_KEY, target_bytes=size // 4, bits=3)
    assert same_rows(snapshot.read(), hot)
    assert snapshot.files().count() >= 4


def test_interleave(spark):
    row = spark.range(1).select(interleave([F.lit(0b11), F.lit(0b01), F.lit(0b10)], 2))
    assert row.first()[0] == 0b101110


def test_partition_filters(spark, rows, snapshot):
    snapshot.write(rows, PARTITIONS)
    month = snapshot.read().where("year = 1995 and month = 1").select("arr_delay")
    plan = month._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "year" in filters and "month" in filters
    assert "ReadSchema: struct<arr_delay:double>" in plan


def test_versions(spark, snapshot):
    assert snapshot.version() is None and not snapshot.exists()
    with pytest.raises(FileNotFoundError):
        snapshot.read()
    snapshot.write(spark.range(2))
    assert snapshot.previous() is None
    snapshot.write(spark.range(5))
    assert (snapshot.read(0).count(), snapshot.read().count()) == (2, 5)
    with pytest.raises(FileNotFoundError):
        snapshot.read(9)


def test_empty_partitioned_write(spark, snapshot):
    empty = spark.createDataFrame([], "k bigint, year bigint")
    snapshot.write(empty, ["year"])
    assert snapshot.read().count() == 0


def test_summary(spark, tmp_path):
    full = AppendTable(spark, str(tmp_path / "full"))
    full.append(spark.range(4))
    none = SnapshotTable(spark, str(tmp_path / "none"))
    found = {tuple(r) for r in table_summary(spark, {"a": full, "b": none}).collect()}
    assert found == {("a", True, 4, 0), ("b", False, 0, None)}


def test_expired_versions(spark):
    now = dt.datetime(2024, 1, 31)
    days = [(("t", i, now - dt.timedelta(days=d))) for i, d in enumerate([20, 8, 7, 3])]
    log = spark.createDataFrame(
        [*days, ("old", 0, now - dt.timedelta(days=90))],
        "table string, version bigint, committed_at timestamp_ntz",
    )
    found = expired_versions(log, F.lit(now).cast("timestamp_ntz"), 168)
    assert {(r.table, r.version) for r in found.collect()} == {("t", 0), ("t", 1)}


def test_clustering_tasks_are_small_beside_its_files(rows, snapshot, monkeypatch):
    snapshot.write(rows, PARTITIONS)
    size = snapshot.files().agg(F.sum("length")).first()[0]
    monkeypatch.setattr(tables, "TASK_BYTES", size // 6)
    asked, plain = [], tables.zorder_layout
    monkeypatch.setattr(tables, "zorder_layout", lambda *a: asked.append(a[4]) or plain(*a))
    snapshot.cluster(CLUSTER_BY, PARTITIONS, BUSINESS_KEY, bits=3)
    assert asked[0] >= 6 and snapshot.read().exceptAll(rows).isEmpty()

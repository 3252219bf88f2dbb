"""CSV ingest in batches and as a stream."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airlag.config import Settings
from airlag.operators.layout import bucket_of, range_bounds, sortable, zorder_layout
from airlag.plans.queries import RAW_KEY, by_raw_key
from airlag.plans.stages import (
    Lakehouse,
    load_bronze,
    process_silver,
    run_all,
    write_time_travel_sample,
)
from airlag.session import materialize, path_exists, run_scratch
from airlag.sources.bronze import append_files, ingest_csv, inspect_all, tag_batches
from airlag.sources.csv_files import CELL_TYPES, _kinds_of, list_csv
from airlag.sources.tables import AppendTable
from airlag.streaming.bronze_stream import ingest_stream, new_files


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    return folder


@pytest.fixture
def table(spark, tmp_path):
    return AppendTable(spark, str(tmp_path / "bronze"))


def put(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + ("\n" if lines else ""))


def test_listing(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        list_csv(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        list_csv(spark, str(raw))
    put(raw, "b.csv", "a", "1")
    put(raw, "a.csv", "a", "1")
    put(raw, "c.txt", "a", "1")
    (raw / "sub").mkdir()
    put(raw / "sub", "d.csv", "a", "1")
    assert [name for _, name in list_csv(spark, str(raw))] == ["a.csv", "b.csv"]


def test_no_cell_is_lost(spark, raw, table):
    """Types come from all rows; one cell that does not fit makes a column text."""
    rows = [f"{i},{i},1.5,2024-01-15,w,true" for i in range(150)]
    put(raw, "x.csv", "n,i,f,d,t,b", *rows, "5.5,7,2,zz,w,FALSE", ",x,,,,")
    ingest_csv(spark, str(raw), table)
    df = table.read()
    assert df.dtypes[:6] == [
        ("n", "double"), ("i", "string"), ("f", "double"), ("d", "string"), ("t", "string"), ("b", "boolean"),
    ]
    assert df.count() == 152
    late = df.where("n = 5.5").first()
    assert (late.i, late.f, late.d, late.b) == ("7", 2.0, "zz", False)
    assert df.where("i = 'x'").first().n is None
    assert df.where("i is null or d is null").count() == 1


def test_a_late_fraction_reaches_silver(spark, raw, tmp_path):
    put(raw, "a.csv", HEADER_A, *[flight(n, f"{n % 50}") for n in range(120)], flight(200, "5.5"), flight(201, "bad"))
    house = Lakehouse(spark, Settings(data_root=str(tmp_path)))
    load_bronze(house)
    process_silver(house)
    assert house.bronze.read().where("ArrDelay = 'bad'").count() == 1
    silver = house.silver.read()
    assert silver.count() == 121
    assert silver.where("flight_number = 200").first().arr_delay == 5.5


def test_line_breaks_in_quotes(spark, raw, table):
    put(raw, "a.csv", "n,t", '1,"two', 'lines"', '2,"say ""so"""', "3,plain")
    put(raw, "b.csv", "n,t", "4,x")
    assert ingest_csv(spark, str(raw), table) == [0, 1]
    found = {r.n: r.t for r in table.read().collect()}
    assert found == {1: "two\nlines", 2: 'say "so"', 3: "plain", 4: "x"}


def test_odd_headers(spark, raw):
    put(raw, "a.csv", "a,,a,B", "1,2,3,4")
    put(raw, "b.csv", '"x', 'y",z', "1,2")
    found = inspect_all(spark, str(raw))
    assert found[0].schema.names == ["a0", "_c1", "a2", "B"]
    assert found[1].schema.names == ["x\ny", "z"] and not found[1].empty


def test_empty_files(spark, raw, table):
    put(raw, "a.csv", "n")
    put(raw, "b.csv", "n", "1")
    assert ingest_csv(spark, str(raw), table) == [0]
    put(raw, "c.csv")
    with pytest.raises(ValueError, match="c.csv"):
        ingest_csv(spark, str(raw), table)


def test_files_are_versions_and_columns_merge(spark, raw, table):
    put(raw, "a 1.csv", "n,m", "1,2")
    put(raw, "b.csv", "n,m", "3,4", "5,6")
    put(raw, "c.csv", "n,extra", "7.5,x")
    assert ingest_csv(spark, str(raw), table) == [0, 1, 2]
    df = table.read()
    assert [r.rows for r in table.log().orderBy("version").collect()] == [1, 2, 1]
    found = {(r.n, r.m, r.extra, r.source_file, r.batch_id) for r in df.collect()}
    assert found == {
        (1.0, 2, None, "a 1.csv", 0), (3.0, 4, None, "b.csv", 1),
        (5.0, 6, None, "b.csv", 1), (7.5, None, "x", "c.csv", 2),
    }
    stamps = df.select("source_file", "ingestion_timestamp").distinct()
    assert stamps.count() == 3
    assert dict(df.dtypes)["ingestion_timestamp"] == "timestamp_ntz"
    assert table.read(0).count() == 1
    # A second run appends everything again.
    assert ingest_csv(spark, str(raw), table) == [3, 4, 5]
    assert table.read().count() == 8


def test_stream_equals_batch_and_resumes(spark, raw, table, tmp_path):
    for i in range(3):
        put(raw, f"{i}.csv", "n,day", f"{i},2024-01-0{i + 1}")
    checkpoint = str(tmp_path / "checkpoint")
    ingest_stream(spark, str(raw), table, checkpoint)
    assert table.version() == 2
    ingest_stream(spark, str(raw), table, checkpoint)
    assert table.read().count() == 3
    # A wider type and a new column, in later files only.
    put(raw, "3.csv", "n,day,more", "3.5,2024-01-04,x")
    ingest_stream(spark, str(raw), table, checkpoint)
    streamed = {(r.n, r.day, r.more, r.source_file) for r in table.read().collect()}
    batch = AppendTable(spark, str(tmp_path / "batch"))
    ingest_csv(spark, str(raw), batch)
    assert streamed == {(r.n, r.day, r.more, r.source_file) for r in batch.read().collect()}
    assert (3.5, dt.date(2024, 1, 4), "x", "3.csv") in streamed


def test_a_stream_adds_to_a_loaded_table(spark, raw, table, tmp_path):
    put(raw, "a.csv", "n", "1")
    put(raw, "b.csv", "n", "2")
    ingest_csv(spark, str(raw), table)
    other = tmp_path / "other"
    other.mkdir()
    # A file with a header only lies between two others.
    for i, rows in enumerate((["3"], [], ["4", "5"])):
        put(other, f"{i}.csv", "n", *rows)
    for checkpoint in ("one", "one", "two"):
        ingest_stream(spark, str(other), table, str(tmp_path / checkpoint))
    assert sorted(r.n for r in table.read().collect()) == [1, 2, 3, 3, 4, 4, 5, 5]


def test_a_replayed_batch_adds_nothing(spark, raw, table):
    put(raw, "a.csv", "n", "1")
    put(raw, "b.csv", "n", "2.5")
    files = inspect_all(spark, str(raw))
    assert append_files(spark, files, table, token="s#0") == [0, 1]
    assert append_files(spark, files, table, token="s#0") == []
    assert append_files(spark, files, table, token="s#1") == [2, 3]
    assert table.read().count() == 4


def test_empty_batches(spark, table):
    none = spark.createDataFrame([], "n bigint")
    assert table.append(none) == [0]
    assert table.read().columns == ["n", "batch_id"] and table.read().count() == 0
    table.append(spark.range(2).select(F.col("id").alias("n")))
    assert [r.rows for r in table.log().orderBy("version").collect()] == [0, 2]
    assert table.read().count() == 2


HEADER_A = (
    "FlightDate,Year,Month,DayOfWeek,Cancelled,Diverted,IATA_Code_Marketing_Airline,"
    "Flight_Number_Marketing_Airline,Origin,Dest,CRSDepTime,DepDelay,CRSArrTime,ArrDelay,Distance"
)
HEADER_B = (
    "YEAR,MONTH,DAY,DAY_OF_WEEK,CANCELLED,DIVERTED,AIRLINE,FLIGHT_NUMBER,ORIGIN_AIRPORT,"
    "DESTINATION_AIRPORT,SCHEDULED_DEPARTURE,DEPARTURE_DELAY,SCHEDULED_ARRIVAL,ARRIVAL_DELAY,DISTANCE"
)


def flight(number: int, delay: str) -> str:
    return f"2024-01-01,2024,1,1,0.0,0.0,wn,{number},isp,pbi,1735,1.0,2035,{delay},1052.0"


def test_all_stages_on_both_layouts(spark, raw, tmp_path):
    a = [
        f"2024-01-{d:02d},2024,1,1,0.0,0.0, wn ,{n},isp,pbi,1735,{n}.0,2035,{(d * n) % 60}.0,1052.0"
        for d in range(1, 21)
        for n in range(1, 11)
    ]
    b = ["2015,1,2,5,0,0,AA,7,JFK,LAX,5,1,900,15,2475"]
    put(raw, "a.csv", HEADER_A, *a)
    put(raw, "b.csv", HEADER_B, *b)
    house = Lakehouse(spark, Settings(data_root=str(tmp_path), sample_rows=150))
    run_all(house, coalesce_layouts=True)
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    assert house.silver.read().count() == 201
    assert house.mart("airline_delay").read().agg({"flight_count": "sum"}).first()[0] == 201
    runs = house.runs.read()
    assert runs.count() == 7
    # The bound holds for what classifiers are fitted on, and for nothing else.
    assert {(r.training_rows, r.test_rows) for r in runs.collect()} == {(201, 41)}
    # The second run merges the same rows and makes new versions.
    version = house.silver.version()
    run_all(house, coalesce_layouts=True)
    assert house.silver.read().count() == 201
    assert house.silver.version() > version
    # Run records are kept; the second run adds its own.
    runs = house.runs.read()
    assert runs.count() == 14
    assert runs.select("run_id", "run_at").distinct().count() == 2
    assert write_time_travel_sample(house)
    sample = spark.read.option("header", True).csv(
        f"{tmp_path}/logs/silver_time_travel_previous_version.csv"
    )
    assert sample.count() == 5 and len(sample.columns) == 16


def test_inference_reads_a_quoted_header(spark, raw):
    put(raw, "q.csv", '"a","b, c"', '1,"x"')
    (found,) = inspect_all(spark, str(raw))
    assert found.schema.names == ["a", "b, c"]
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "string"]


def test_a_run_leaves_no_scratch_behind(spark):
    with run_scratch(spark) as root:
        stored = materialize(spark.range(3))
        assert path_exists(spark, root) and stored.count() == 3
        assert root in stored.inputFiles()[0]
    assert not path_exists(spark, root)
    assert not materialize(spark.range(3)).inputFiles()[0].startswith(root)


def test_a_quoted_file_is_read_by_many_tasks(spark, raw, table, monkeypatch):
    """Records that cross lines and blocks; blocks of 300 bytes."""
    rows = [(i, f'cell {i}\n"say" {"x" * (i % 40)}\n\nend' if i % 3 else f"plain {i}") for i in range(200)]
    lines = ["n,t"]
    lines += [f'{n},"{t.replace(chr(34), chr(34) * 2)}"' if "\n" in t else f"{n},{t}" for n, t in rows]
    put(raw, "a.csv", *lines)
    put(raw, "b.csv", "n,t", '7,"x', 'y"')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        files = inspect_all(spark, str(raw))
        assert [f.layout for f in files] == ["quoted", "quoted"]
        assert [f.dataType.simpleString() for f in files[0].schema] == ["bigint", "string"]
        assert spark.read.text(files[0].path).rdd.getNumPartitions() > 20
        ingest_csv(spark, str(raw), table)
        found = sorted((r.n, r.t) for r in table.read().where("source_file = 'a.csv'").collect())
        assert found == rows
        assert [r.t for r in table.read().where("source_file = 'b.csv'").collect()] == ["x\ny"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quotes_inside_plain_cells(spark, raw, table):
    """They open nothing; such a file is read from its start to its end."""
    put(raw, "a.csv", "n,t", '1,5" pipe', "2,x", '3,"two', 'lines"')
    assert inspect_all(spark, str(raw))[0].layout == "whole"
    ingest_csv(spark, str(raw), table)
    assert {r.n: r.t for r in table.read().collect()} == {1: '5" pipe', 2: "x", 3: "two\nlines"}


def test_headers_that_come_again(spark, raw, table):
    put(raw, "a.csv", "n,t", "1,x", "n,t", "2,y")
    put(raw, "b.csv", "t,n", "x,1")
    put(raw, "c.csv", "n,t", "3,z")
    found = inspect_all(spark, str(raw))
    assert [[f.dataType.simpleString() for f in x.schema] for x in found] == [
        ["string", "string"], ["string", "bigint"], ["bigint", "string"],
    ]
    ingest_csv(spark, str(raw), table)
    assert table.read().count() == 5


def test_the_stream_reads_no_content(spark, raw, tmp_path):
    put(raw, "a 1.csv", "n", "1")
    put(raw, "b.txt", "n", "1")
    query = new_files(spark, str(raw), 1).writeStream.format("memory").queryName("names")
    query = query.option("checkpointLocation", str(tmp_path / "names")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.name, r.path.endswith("/raw/a 1.csv")) for r in spark.table("names").collect()] == [("a 1.csv", True)]
    plan = query._jsq.explainInternal(False)
    assert "ReadSchema: struct<path:string>" in plan


def test_sortable_text_keeps_its_order(spark):
    words = ["", "A", "AB", "ABCDEFG", "ABCDEFH", "B", "a", "zz", "é", "日本"]
    df = spark.createDataFrame([(w,) for w in words], "w string").withColumn("k", sortable(F.col("w"), "string"))
    rows = sorted(df.collect(), key=lambda r: r.w.encode())
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_buckets_follow_bounds(spark):
    df = spark.range(1000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(100)).cast("int"))
    bounds = range_bounds(df, ["v"], 3)["v"]
    placed = df.withColumn("b", bucket_of(F.col("v"), bounds, 3)).collect()
    assert len(bounds) == 7
    assert all(r.b == sum(x < r.v for x in bounds) for r in placed)
    assert {r.b for r in placed} == set(range(8))


def test_a_row_is_made_sortable_once(spark):
    words = spark.range(100).select((F.col("id") % 7).cast("string").alias("w"), F.lit("p").alias("p"))
    placed = zorder_layout(words, ["w"], ["p"], ["w"], files=2, bits=3)
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    steps = [line for line in plan.splitlines() if "aggregate(" in line]
    # The steps to a bucket look at a column, and do not take the text apart again.
    assert steps and not [line for line in steps if "conv(" in line]
    assert sorted(r.w for r in placed.collect()) == sorted(r.w for r in words.collect())


def test_csv_files_are_dealt_without_a_look_at_all_rows(spark):
    rows = spark.range(60).select(*[(F.col("id") % 20).alias(name) for name in RAW_KEY], "id")
    dealt = by_raw_key(rows)
    assert "rangepartitioning" not in dealt._jdf.queryExecution().executedPlan().toString()
    places = dealt.withColumn("at", F.spark_partition_id()).groupBy(*RAW_KEY).agg(F.count_distinct("at").alias("n"))
    assert [r.n for r in places.collect()] == [1] * 20


def test_types_of_cells_need_no_sort(spark, raw, monkeypatch):
    """Lines are typed by sums that fit in place, whatever the headers."""
    put(raw, "a.csv", "n,m", "1,123456789012345678901", "+2,1")
    put(raw, "b.csv", "n,m", "1.5,2024-01-15")
    put(raw, "c.csv", "m", "2024-01-15 10:00:00", "")
    plans, collect = [], type(spark.range(0)).collect

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(spark.range(0)), "collect", kept)
    found = inspect_all(spark, str(raw))
    assert [[k.dataType.typeName() for k in f.schema] for f in found] == [
        ["long", "double"], ["double", "date"], ["timestamp_ntz"],
    ]
    typed = [p for p in plans if "bit_and" in p]
    assert typed and not any("SortAggregate" in p for p in typed)


def test_loading_shuffles_no_rows(spark, raw, table):
    put(raw, "a.csv", "n", "1")
    put(raw, "b.csv", "n", "2")
    rows = tag_batches(spark, inspect_all(spark, str(raw)), [4, 5])
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.n, r.batch_id) for r in rows.collect()) == [(1, 4), (2, 5)]


ODD_CELLS = [
    "0", "7", "-7", "+7", "007", "-0", "999999999999999999", "9223372036854775807", "9223372036854775808",
    "1" * 400, "1.", ".5", "-.5e3", "1e5", "123e-5", "1.5x", "NaN", "nan", "Infinity", "-Infinity", "I", "1,5",
    "2024-01-15", "2024-1-5", "2024-02-31", "2024-01-15 10:00", "2024-01-15T10:00:00.5", "2024-01-15T25", "true",
    "TRUE", "fAlse", "f", "", " 1", "1 ", "1\n", "+", "-", ".", "x", "\u0661", None,
]


def test_quick_looks_find_the_same_types(spark):
    df = spark.createDataFrame([(c,) for c in ODD_CELLS], "c string")
    cell, bits = F.col("c"), F.lit(0)
    for place, (kind, look) in enumerate(CELL_TYPES):
        bits = bits + F.when(cell.rlike(look) & cell.try_cast(kind).isNotNull(), 1 << place).otherwise(0)
    plain = F.when(cell.isNotNull(), bits)
    rows = materialize(df).select("c", _kinds_of(cell).alias("found"), plain.alias("plain")).collect()
    assert [r for r in rows if r.found != r.plain] == [] and len({r.plain for r in rows}) >= 6

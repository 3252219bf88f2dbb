"""Runs that take only what came since the last one."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from test_csv import HEADER_A, put

from airlag.config import Settings
from airlag.plans.incremental import last_merged, run_incremental
from airlag.plans.stages import MARTS, Lakehouse, process_gold, process_silver
from airlag.sources.bronze import ingest_csv


def flights(month: int, first: int, last: int, delay: float = 5.0, origin: str = "isp") -> list[str]:
    return [
        f"2024-{month:02d}-{1 + n % 20:02d},2024,{month},1,0.0,0.0,wn,{n},{origin},pbi,1735,1.0,2035,{delay + n % 9},1052.0"
        for n in range(first, last)
    ]


def digests(house: Lakehouse) -> dict[str, str]:
    """Folder and hash of every data file of the newest versions."""
    tables = {"silver": house.silver, "features": house.features, **{m: house.mart(m) for m in MARTS}}
    found = {}
    for name, table in tables.items():
        for folder in table.folders():
            for file in sorted(Path(table.path, "data", folder).glob("*.parquet")):
                found[f"{name}:{folder}/{file.name}"] = hashlib.sha256(file.read_bytes()).hexdigest()
    return found


def content(house: Lakehouse) -> dict[str, list]:
    tables = {"silver": house.silver, "features": house.features, **{m: house.mart(m) for m in MARTS}}
    return {name: sorted(map(str, table.read().collect())) for name, table in tables.items()}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    put(folder, "a.csv", HEADER_A, *flights(1, 0, 30), *flights(2, 0, 30))
    put(folder, "b.csv", HEADER_A, *flights(3, 0, 30))
    return folder


def test_untouched_months_stay_as_they_are(spark, raw, tmp_path):
    house = Lakehouse(spark, Settings(data_root=str(tmp_path)))
    assert sorted(run_incremental(house, learn=False)) == [(2024, 1), (2024, 2), (2024, 3)]
    before, versions = digests(house), house.silver.version()

    # Nothing new: nothing is written.
    assert run_incremental(house, learn=False) == []
    assert digests(house) == before and house.silver.version() == versions

    # Known keys with other values lose against the earlier file; new ones are added.
    put(raw, "c.csv", HEADER_A, *flights(2, 10, 45, delay=60.0), *flights(3, 5, 9))
    assert run_incremental(house, learn=False) == [(2024, 2)]
    after = digests(house)
    for key, value in before.items():
        if "month=2" not in key:
            assert after[key] == value
    assert {k for k in after if "month=2" not in k} == {k for k in before if "month=2" not in k}
    assert any("month=2" in k for k in set(after) - set(before))
    assert last_merged(house) == 2

    # The same as one run over all files.
    whole = Lakehouse(spark, Settings(data_root=str(tmp_path / "whole")))
    ingest_csv(spark, str(raw), whole.bronze)
    process_silver(whole)
    process_gold(whole)
    assert content(house) == content(whole)


def test_a_changed_file_is_new_and_null_keys_come_once(spark, raw, tmp_path):
    house = Lakehouse(spark, Settings(data_root=str(tmp_path)))
    run_incremental(house, learn=False)
    rows = house.silver.read().count()
    put(raw, "b.csv", HEADER_A, *flights(3, 0, 31), *[x.replace(",isp,", ",,") for x in flights(3, 40, 42)])
    assert run_incremental(house, learn=False) == [(2024, 3)]
    assert house.silver.read().count() == rows + 3
    assert run_incremental(house, learn=False) == []
    assert house.silver.read().count() == rows + 3


def test_dates_that_span_partitions_are_built_again(spark, raw, tmp_path):
    """Load counts are per date, whatever month the file names."""
    house = Lakehouse(spark, Settings(data_root=str(tmp_path)))
    run_incremental(house, learn=False)
    line = flights(1, 90, 91)[0].replace("2024,1,1", "2024,2,1")
    put(raw, "c.csv", HEADER_A, line)
    assert sorted(run_incremental(house, learn=False)) == [(2024, 1), (2024, 2)]
    whole = Lakehouse(spark, Settings(data_root=str(tmp_path / "whole")))
    ingest_csv(spark, str(raw), whole.bronze)
    process_silver(whole)
    process_gold(whole)
    assert content(house) == content(whole)

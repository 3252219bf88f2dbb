"""The five stages over one data root: bronze, silver, maintenance, gold, models."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlag.config import BUSINESS_KEY, CLUSTER_BY, PARTITIONS, Settings
from airlag.operators import clean as C
from airlag.operators import features, marts, models
from airlag.session import materialize, run_scratch, set_checkpoint_folder
from airlag.sources.bronze import ingest_csv
from airlag.sources.csv_files import write_report_csv
from airlag.sources.tables import AppendTable, SnapshotTable, VersionedTable, utc_now

MARTS = {
    "airline_delay": marts.airline_delay,
    "airport_delay": marts.airport_delay,
    "route_delay": marts.route_delay,
    "time_delay": marts.time_delay,
}
SAMPLE_ROWS = 5
BATCH_ORDER = ["batch_id", "source_file"]


@dataclass(frozen=True)
class Lakehouse:
    """The tables of one data root."""

    spark: SparkSession
    settings: Settings

    @property
    def bronze(self) -> AppendTable:
        return AppendTable(self.spark, self.settings.path("bronze"))

    @property
    def silver(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.settings.path("silver"))

    def mart(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, self.settings.path("gold", "analytics", name))

    @property
    def features(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.settings.path("gold", "ml_features"))

    @property
    def runs(self) -> AppendTable:
        return AppendTable(self.spark, self.settings.path("ml", "model_runs"))

    def summary_tables(self) -> dict[str, VersionedTable]:
        return {
            "bronze": self.bronze,
            "silver": self.silver,
            "gold_ml_features": self.features,
        }


@contextmanager
def exact_column_case(spark: SparkSession):
    """Raw layouts may differ only in the case of their column names."""
    key = "spark.sql.caseSensitive"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def load_bronze(house: Lakehouse) -> list[int]:
    return ingest_csv(house.spark, house.settings.path("raw"), house.bronze)


def silver_source(bronze: DataFrame, coalesce_layouts: bool = False) -> DataFrame:
    """All of bronze cleaned, one row per business key: the earliest batch wins."""
    return earliest(C.clean(bronze, BATCH_ORDER, coalesce_layouts))


def earliest(rows: DataFrame) -> DataFrame:
    rest = [name for name in C.SILVER_COLUMNS if name not in BUSINESS_KEY]
    order = [F.col(name) for name in [*BATCH_ORDER, *rest]]
    return C.keep_first(rows, BUSINESS_KEY, order).select(*C.SILVER_COLUMNS)


def process_silver(house: Lakehouse, coalesce_layouts: bool = False) -> int | None:
    """Create silver, or merge all of bronze into it; None when no row is left."""
    rows = C.clean(house.bronze.read(), BATCH_ORDER, coalesce_layouts)
    if rows.isEmpty():  # before the dedup, so that the first row found answers
        return None
    mark = merged_mark(house.bronze.version())
    if house.silver.exists():
        return house.silver.merge(materialize(earliest(rows)), BUSINESS_KEY, PARTITIONS, mark)
    return house.silver.write(earliest(rows), PARTITIONS, token=mark)


def merged_mark(batch: int) -> str:
    """What a silver version is marked with: the last batch that is in it."""
    return f"bronze:{batch}"


def maintain_silver(house: Lakehouse) -> None:
    """Compact, cluster, and store a few rows of the previous version."""
    silver = house.silver
    if not silver.exists():
        return
    silver.compact(PARTITIONS)
    silver.cluster(CLUSTER_BY, PARTITIONS, spread_by=BUSINESS_KEY)
    write_time_travel_sample(house)


def write_time_travel_sample(house: Lakehouse) -> bool:
    """False when there is no earlier version or it can no longer be read."""
    previous = house.silver.previous()
    if previous is None:
        return False
    path = house.settings.path("logs", "silver_time_travel_previous_version.csv")
    try:
        write_report_csv(time_travel_sample(previous), path, SAMPLE_ROWS)
    except PySparkException:
        return False
    return True


def time_travel_sample(version: DataFrame) -> DataFrame:
    rest = [name for name in C.SILVER_COLUMNS if name not in BUSINESS_KEY]
    return version.orderBy(*BUSINESS_KEY, *rest).limit(SAMPLE_ROWS)


def process_gold(house: Lakehouse) -> None:
    """Every mart and the feature table, each overwritten as a new version."""
    silver = house.silver.read()
    for name, build in MARTS.items():
        house.mart(name).write(build(silver))
    house.features.write(features.ml_features(silver))


def run_ml(house: Lakehouse) -> bool:
    """Train the seven models and add their records to those of earlier runs;
    False when there is nothing to train on."""
    if not house.features.exists():
        return False
    table = house.features.read()
    if table.isEmpty() or not {models.DELAY, models.LATE} <= set(table.columns):
        return False
    used = models.used_columns(table)
    if not used:
        return False
    set_checkpoint_folder(house.spark)
    settings = house.settings
    data = models.prepare(table, settings.sample_rows, materialize, settings.train_tasks)
    runs = models.regression_runs(data) + models.classification_runs(data)
    records = models.model_runs(runs, data, used, house.features.version())
    stamp = {"run_id": F.lit(uuid.uuid4().hex), "run_at": F.lit(utc_now()).cast("timestamp_ntz")}
    house.runs.append(records.withColumns(stamp))
    for run in runs:
        ranked = run.model and models.feature_importance(run.model, data.features)
        if ranked is not None:
            name = f"{run.task}_{run.name}_feature_importance.csv"
            write_report_csv(ranked, house.settings.path("ml", name), len(data.features))
    return True


def run_stages(house: Lakehouse, coalesce_layouts: bool = False) -> None:
    """All five stages in order; the first failure stops the rest. What they
    store on the way is removed at the end."""
    with run_scratch(house.spark):
        load_bronze(house)
        process_silver(house, coalesce_layouts)
        maintain_silver(house)
        process_gold(house)
        run_ml(house)


def run_all(house: Lakehouse, coalesce_layouts: bool = False) -> None:
    """The stages for files of either layout, or of both."""
    with exact_column_case(house.spark):
        run_stages(house, coalesce_layouts)

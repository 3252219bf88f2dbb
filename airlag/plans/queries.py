"""The registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlag.config import (
    BUSINESS_KEY,
    CLUSTER_BY,
    PARTITIONS,
    RETENTION_HOURS,
    SEED,
    TEST_FRACTION,
    Settings,
)
from airlag.functions.columns import is_late
from airlag.operators import clean as C
from airlag.operators import features, impute, marts, metrics, models, ranking
from airlag.plans.incremental import run_incremental
from airlag.plans.stages import MARTS, Lakehouse, run_stages, time_travel_sample
from airlag.session import materialize, scratch_dir
from airlag.sources import tables
from airlag.sources.bronze import ingest_csv, inspect_all
from airlag.sources.csv_files import read_csv, write_report_csv
from airlag.sources.flights import LAYOUT_A, LINE_ORDER, arrival_order, flights, to_layout_b
from airlag.sources.tables import AppendTable, SnapshotTable
from airlag.streaming.bronze_stream import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(flights(spark, sf_dir), carry=LINE_ORDER)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_of_each_key(cleaned(spark, sf_dir))


def first_of_each_key(rows: DataFrame) -> DataFrame:
    order = arrival_order("arr_delay", "distance", "dep_delay", "crs_dep_time")
    return C.keep_first(rows, BUSINESS_KEY, order).select(*C.SILVER_COLUMNS)


def _on_silver(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(silver(spark, sf_dir))


def _on_stored_silver(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """For operators that read silver twice: it is derived and stored once."""
    return lambda spark, sf_dir: operator(materialize(silver(spark, sf_dir)))


def _cleaned_columns(*names: str) -> Query:
    return lambda spark, sf_dir: cleaned(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", *names
    )


def silver_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = C.keep_flown(C.resolve_columns(flights(spark, sf_dir), carry=LINE_ORDER))
    return kept.select(*LINE_ORDER, "cancelled", "diverted", "arr_delay")


def normalize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = C.resolve_columns(flights(spark, sf_dir), carry=LINE_ORDER)
    codes = ["airline", "origin", "dest"]
    return raw.select(
        "l_orderkey", "l_linenumber", *[C.normalize_code(raw[c]).alias(c) for c in codes]
    )


def resolve_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.resolve_columns(to_layout_b(flights(spark, sf_dir)))


def _flight_date_b(with_day: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = to_layout_b(flights(spark, sf_dir), with_day)
        return C.clean(raw, carry=LINE_ORDER).select(
            "l_orderkey", "l_linenumber", "flight_date"
        )

    return query


CORE: dict[str, Query] = {
    "silver_clean": lambda spark, sf_dir: cleaned(spark, sf_dir).select(*C.SILVER_COLUMNS),
    "silver_dedup": silver,
    "silver_filter": silver_filter,
    "silver_hour": _cleaned_columns("crs_dep_time", "hour"),
    "silver_season": _cleaned_columns("month", "season"),
    "silver_route": _cleaned_columns("origin", "dest", "route"),
    "normalize_codes": normalize_codes,
    "resolve_columns": resolve_columns,
    "flight_date_iso": _cleaned_columns("flight_date"),
    "flight_date_ymd": _flight_date_b(True),
    "flight_date_ym": _flight_date_b(False),
    "airline_delay": _on_silver(marts.airline_delay),
    "p95_nearest": _on_silver(
        lambda s: marts.airline_delay(s).select("year", "month", "airline", "p95_arr_delay")
    ),
    "airport_delay": _on_silver(marts.airport_delay),
    "route_delay": _on_silver(marts.route_delay),
    "time_delay": _on_silver(marts.time_delay),
    "silver_overview": _on_stored_silver(marts.overview),
    "delay_histogram": _on_silver(marts.delay_histogram),
    "airline_origin_hour": _on_silver(marts.late_mean),
    "top_airlines": _on_silver(
        lambda s: marts.worst(marts.airline_delay(s), ["year", "month", "airline"])
    ),
    "top_routes": _on_silver(
        lambda s: marts.worst(marts.route_delay(s), ["year", "month", "origin", "dest"])
    ),
    "time_head": _on_silver(lambda s: marts.first_hours(marts.time_delay(s))),
    "ml_features": _on_stored_silver(features.ml_features),
}


def _after(year: int, df: DataFrame) -> DataFrame:
    return df.where(F.col("year") >= year)


def _until(year: int, df: DataFrame) -> DataFrame:
    return df.where(F.col("year") <= year)


def early_report(df: DataFrame) -> DataFrame:
    """Silver as first reported: delays were estimated five minutes lower."""
    lower = F.greatest(F.col("arr_delay") - 5, F.lit(-60.0))
    return _until(1996, df).withColumn("arr_delay", lower)


def merged_table(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """Version 0: early reports up to 1996; version 1: all from 1995 merged in."""
    rows = materialize(silver(spark, sf_dir))
    table = SnapshotTable(spark, scratch_dir(spark))
    table.write(early_report(rows), PARTITIONS)
    table.merge(_after(1995, rows), BUSINESS_KEY, PARTITIONS)
    return table


def silver_table(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    table = SnapshotTable(spark, scratch_dir(spark))
    table.write(silver(spark, sf_dir), PARTITIONS)
    return table


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_table(spark, sf_dir).read()


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_table(spark, sf_dir).previous()


def partition_pruned_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.month_mean(silver_table(spark, sf_dir).read(), 1995, 1)


def small_files_table(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """Silver arriving in two halves of the day, so that a month has two folders."""
    rows = materialize(silver(spark, sf_dir))
    table = SnapshotTable(spark, scratch_dir(spark))
    table.write(rows.where("hour < 12"), PARTITIONS)
    table.merge(rows.where("hour >= 12"), BUSINESS_KEY, PARTITIONS)
    return table


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = small_files_table(spark, sf_dir)
    table.compact(PARTITIONS)
    return table.read()


def zorder_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = silver_table(spark, sf_dir)
    table.cluster(CLUSTER_BY, PARTITIONS, spread_by=BUSINESS_KEY, bits=5)
    return table.read()


def gold_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airline mart, overwritten once; the newest version is read back."""
    rows = materialize(silver(spark, sf_dir))
    table = SnapshotTable(spark, scratch_dir(spark))
    table.write(marts.airline_delay(_until(1996, rows)))
    table.write(marts.airline_delay(rows))
    return table.read()


def append_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries: the first without ``Diverted`` and with whole distances."""
    raw = flights(spark, sf_dir)
    table = AppendTable(spark, scratch_dir(spark))
    first = raw.where(F.col("Year") <= 1995).drop("Diverted")
    table.append(first.withColumn("Distance", F.col("Distance").cast("bigint")))
    table.append(raw.where(F.col("Year") > 1995))
    return table.read()


def expired_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with one version per month of flights; now is the last shipment."""
    raw = flights(spark, sf_dir)
    log = raw.groupBy("Year", "Month").agg(
        F.max("FlightDate").cast("timestamp_ntz").alias("committed_at"),
        F.count(F.lit(1)).alias("rows"),
    ).select(
        F.lit("silver").alias("table"),
        (F.col("Year") * 12 + F.col("Month")).alias("version"),
        "rows",
        "committed_at",
    )
    log = materialize(log)
    now = log.select(F.max("committed_at")).scalar()
    return tables.expired_versions(log, now, RETENTION_HOURS)


def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = AppendTable(spark, scratch_dir(spark))
    bronze.append(flights(spark, sf_dir))
    return tables.table_summary(
        spark,
        {
            "bronze": bronze,
            "silver": merged_table(spark, sf_dir),
            "gold_ml_features": SnapshotTable(spark, scratch_dir(spark)),
        },
    )


TABLES: dict[str, Query] = {
    "table_scan": lambda spark, sf_dir: merged_table(spark, sf_dir).read(),
    "silver_partitioned": lambda spark, sf_dir: silver_table(spark, sf_dir).read(),
    "partition_pruned_mean": partition_pruned_mean,
    "gold_write": gold_write,
    "append_schema_merge": append_schema_merge,
    "merge_upsert": merge_upsert,
    "time_travel": time_travel,
    "time_travel_sample": lambda spark, sf_dir: time_travel_sample(time_travel(spark, sf_dir)),
    "compact": compact,
    "zorder_layout": zorder_layout,
    "expired_versions": expired_versions,
    "table_summary": table_summary,
}


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The flights as CSV files."""
    folder = scratch_dir(spark)
    _write_csv(by_raw_key(flights(spark, sf_dir)), folder)
    return folder


# The raw columns of the business key.
RAW_KEY = [
    "FlightDate", "IATA_Code_Marketing_Airline", "Flight_Number_Marketing_Airline", "Origin", "Dest",
]


def by_raw_key(raw: DataFrame) -> DataFrame:
    """Dealt by the raw business key: no year is one task, equal keys share a file.
    By hash, for ranges would derive all rows twice, once to find their ends."""
    return raw.repartition(*RAW_KEY)


def _write_csv(df: DataFrame, folder: str) -> None:
    (
        df.write.mode("append")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def bronze_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per year over all listed files, and whether every row names one."""
    folder = csv_folder(spark, sf_dir)
    files = inspect_all(spark, folder)
    rows = read_csv(spark, files[0], [f.path for f in files])
    listed = F.col("source_file").isin([f.name for f in files])
    return rows.groupBy(F.col("Year").cast("bigint").alias("Year")).agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(listed).alias("named")
    )


def bronze_table(spark: SparkSession, folder: str) -> DataFrame:
    table = AppendTable(spark, scratch_dir(spark))
    ingest_csv(spark, folder, table)
    return table.read()


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_table(spark, csv_folder(spark, sf_dir)).select(*LAYOUT_A, *LINE_ORDER)


def bronze_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per year, and whether each file has one load time and one version."""
    table = materialize(bronze_table(spark, csv_folder(spark, sf_dir)))
    tags = table.groupBy("source_file").agg(
        F.count_distinct("ingestion_timestamp", "batch_id").alias("n"),
        F.bool_and(F.col("ingestion_timestamp").isNotNull()).alias("timed"),
    )
    once = tags.agg(F.bool_and((F.col("n") == 1) & F.col("timed")))
    return (
        table.groupBy("Year")
        .agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("source_file").isNotNull()).alias("named"))
        .withColumn("loaded_once", once.scalar())
    )


def bronze_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights per year after loading a folder that also has a header-only file."""
    folder = csv_folder(spark, sf_dir)
    _write_csv(flights(spark, sf_dir).where(F.lit(False)), folder)
    return bronze_table(spark, folder).groupBy("Year").agg(F.count(F.lit(1)).alias("rows"))


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = csv_folder(spark, sf_dir)
    table = AppendTable(spark, scratch_dir(spark))
    checkpoint = scratch_dir(spark)
    ingest_stream(spark, folder, table, checkpoint, files_per_batch=4)
    ingest_stream(spark, folder, table, checkpoint, files_per_batch=4)
    return table.read().select(*LAYOUT_A, *LINE_ORDER)


def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten worst airline months, written as one CSV file and read back."""
    report = CORE["top_airlines"](spark, sf_dir)
    path = scratch_dir(spark)
    write_report_csv(report, path, rows=10)
    return spark.read.schema(report.schema).option("header", True).csv(path)


FILES: dict[str, Query] = {
    "bronze_files": bronze_files,
    "bronze_scan": bronze_scan,
    "bronze_provenance": bronze_provenance,
    "bronze_skip_empty": bronze_skip_empty,
    "bronze_stream": bronze_stream,
    "csv_sink": csv_sink,
}

SAMPLE_QUERY_ROWS = 5_000
#: Numbers of few values, between any two of which a tree may split.
STUMP_NUMBERS = ["num__hour", "num__day_of_week"]


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, stored as the model stage finds it, with the hash
    that orders its rows."""
    table = QUERIES["ml_features"](spark, sf_dir)
    return materialize(ranking.with_order_key(table, table.columns, SEED))


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sample_exact(feature_table(spark, sf_dir), SAMPLE_QUERY_ROWS, SEED)


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = feature_table(spark, sf_dir)
    return ranking.stratified_split(table, models.LATE, SEED, TEST_FRACTION).drop(ranking.ORDER_KEY)


def model_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feature table with its split, stored."""
    return materialize(split(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str, classify: bool = True) -> models.Prepared:
    table = feature_table(spark, sf_dir)
    settings = Settings()
    rows = settings.sample_rows if classify else 0
    return models.prepare(table, rows, materialize, settings.train_tasks)


def with_gaps(parts: DataFrame) -> DataFrame:
    """Values go missing wherever the departure delay is unknown."""
    known = F.col("dep_delay").isNotNull()
    gone = ["distance", "hour", "airline", "season"]
    return parts.withColumns({c: F.when(known, F.col(c)) for c in gone})


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = with_gaps(model_parts(spark, sf_dir))
    fills = impute.medians(parts.where(~F.col("is_test")), models.NUMERIC)
    return impute.fill(parts, fills, models.NUMERIC).select(
        "flight_date", "route", "is_test", *models.NUMERIC
    )


def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = with_gaps(model_parts(spark, sf_dir))
    fills = impute.modes(parts.where(~F.col("is_test")), models.CATEGORICAL)
    return impute.fill(parts, fills, models.CATEGORICAL).select(
        "flight_date", "is_test", *models.CATEGORICAL
    )


def slot_totals(data: models.Prepared) -> DataFrame:
    """(feature, total): each vector slot summed over the test rows.

    The summarizer multiplies a mean by a count; rounding restores the sum.
    """
    spark = data.test.sparkSession
    names = spark.createDataFrame(
        list(enumerate(data.features)), "place int, feature string"
    )
    totals = data.test.select(Summarizer.sum(F.col("features")).alias("s"))
    slots = totals.select(F.posexplode(vector_to_array("s")).alias("place", "total"))
    return slots.join(names, "place").select("feature", F.round("total", 6).alias("total"))


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows per category slot; the slots come from the training rows."""
    return slot_totals(prepared(spark, sf_dir, classify=False)).where(F.col("feature").startswith("cat__"))


def ml_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_totals(prepared(spark, sf_dir, classify=False))


PREDICTION_COLUMNS = ["flight_date", "airline", "route", "hour", models.DELAY, models.LATE]


def baseline_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = model_parts(spark, sf_dir)
    train, test = parts.where("not is_test"), parts.where("is_test")
    return models.baseline_mean(train, test).select(*PREDICTION_COLUMNS, "prediction")


def baseline_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = model_parts(spark, sf_dir)
    train, test = parts.where("not is_test"), parts.where("is_test")
    return models.baseline_mode(train, test).select(*PREDICTION_COLUMNS, "prediction", "score")


def _residuals(build: Callable[[models.Prepared], Estimator], *by: str) -> Query:
    """Training rows, labels and residuals, summed: zero where a least-squares
    model has a constant of its own, unpenalised, for every group."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = prepared(spark, sf_dir, classify=False)
        fitted = build(data).fit(data.train).transform(data.train)
        left = F.sum(F.col("prediction") - F.col(models.DELAY)) / F.count(F.lit(1))
        return fitted.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(models.DELAY).alias("label_total"),
            F.abs(F.round(left, 3)).alias("mean_residual"),
        )

    return query


def forest_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test row, and whether its prediction lies among the training labels."""
    data = prepared(spark, sf_dir, classify=False)
    model = models.forest_regression(**models.PIPELINE_FOREST).fit(models.forest_rows(data))
    low, high = data.train.agg(F.min(models.DELAY), F.max(models.DELAY)).first()
    inside = F.col("prediction").between(low, high).alias("in_range")
    return model.transform(data.test).select(*PREDICTION_COLUMNS, inside)


def forest_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test row, and whether its prediction is a class."""
    data = prepared(spark, sf_dir)
    model = models.forest_classification(**models.PIPELINE_FOREST).fit(data.fit)
    known = F.col("prediction").isin(0.0, 1.0).alias("in_range")
    return model.transform(data.test).select(*PREDICTION_COLUMNS, known)


def _stump(data: models.Prepared, rows: DataFrame, label: str) -> DataFrame:
    slots = [n for n in data.features if n.startswith("cat__") or n in STUMP_NUMBERS]
    found = models.best_split(rows, label, slots, data.features)
    return found.withColumn("prediction", F.round("prediction", 6))


def regression_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two sides of the first split of a tree over all training rows."""
    data = prepared(spark, sf_dir, classify=False)
    return _stump(data, data.train, models.DELAY)


def classification_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the rows that classifiers are fitted on."""
    data = prepared(spark, sf_dir)
    return _stump(data, data.fit, models.LATE)


def logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, late flights and mean residual of the rows that were fitted; the
    constant is unpenalised, so probabilities sum to the late flights."""
    data = prepared(spark, sf_dir)
    model = models.logistic_regression(data.fit_rows).fit(data.fit)
    left = F.avg(F.col("score") - F.col(models.LATE))
    return models.with_score(model.transform(data.fit)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(models.LATE).cast("bigint")).alias("late"),
        F.abs(F.round(left, 3)).alias("mean_residual"),
    )


def classification_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test row, whether its score is a probability, and whether it
    decides the prediction."""
    data = prepared(spark, sf_dir)
    model = models.logistic_regression(data.fit_rows).fit(data.fit)
    scored = models.with_score(model.transform(data.test))
    decided = (F.col("score") > 0.5) == (F.col("prediction") == 1)
    return scored.select(
        *PREDICTION_COLUMNS,
        F.col("score").between(0, 1).alias("in_range"),
        (decided | (F.col("score") == 0.5)).alias("decides"),
    )


def guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed predictions for the metrics: the arrival is as late as the departure."""
    guess = F.coalesce(F.col("dep_delay"), F.lit(0.0))
    late = is_late(guess).cast("int")
    label = is_late(F.col(models.DELAY)).cast("tinyint")
    return silver(spark, sf_dir).select(
        models.DELAY, label.alias(models.LATE), guess.alias("guess"), late.alias("guess_late")
    )


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variance in r2 is not a whole number: six decimals are compared."""
    table = metrics.regression_metrics(guesses(spark, sf_dir), models.DELAY, "guess")
    return table.withColumn("r2", F.round("r2", 6))


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = guesses(spark, sf_dir)
    return metrics.classification_metrics(rows, models.LATE, "guess_late")


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(guesses(spark, sf_dir), models.LATE, "guess")


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slots of both forests; importances of one forest sum to one."""
    data = prepared(spark, sf_dir)
    forests = {
        "regression": models.forest_regression(**models.PIPELINE_FOREST).fit(models.forest_rows(data)),
        "classification": models.forest_classification(**models.PIPELINE_FOREST).fit(data.fit),
    }
    ranked = [
        models.feature_importance(model, data.features).withColumn("task", F.lit(task))
        for task, model in forests.items()
    ]
    whole = F.round(F.sum("importance").over(Window.partitionBy("task")), 6)
    return ranked[0].unionByName(ranked[1]).select(
        "task", "feature", F.col("importance").between(0, 1).alias("in_range"), whole.alias("total")
    )


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run records; metrics only of the baselines, which SQL can state."""
    data = prepared(spark, sf_dir)
    runs = models.regression_runs(data) + models.classification_runs(data)
    table = models.model_runs(runs, data, models.NUMERIC + models.CATEGORICAL, 0)
    baseline = F.col("model_type").startswith("Dummy")
    confusion = sum((F.col(f"confusion_{c}") for c in ("fp", "fn", "tp")), F.col("confusion_tn"))
    return table.select(
        "task", "model_type", "train_rows", "test_rows", "training_rows", "gold_table_version",
        confusion.alias("confusion_total"),
        *[F.when(baseline, F.round(m, 6)).alias(m) for m in ("mae", "accuracy", "f1", "roc_auc")],
    )


def _board(runs: list[models.Run], metric: str, descending: bool, *exact: str) -> DataFrame:
    """A leaderboard's models, whether the one before each is no worse, whether
    each metric is that of the model's own test rows, and how the baseline does.

    Both facts are taken anew, from where the models stand and from what they
    predict, and not from the order by which the board was made.
    """
    rows = models.leaderboard(runs, metric, descending).collect()
    values = [row[metric] for row in rows]
    steps = [a >= b if descending else a <= b for a, b in zip(values, values[1:])]
    label = models.LATE if descending else models.DELAY
    again = {run.name: METRIC_AGAIN[metric](run.predicted, label) for run in runs}
    facts = [
        (
            row.model, ordered, abs(again[row.model] - row[metric]) < 1e-9,
            *[round(row[m], 6) if row.model.startswith("Dummy") else None for m in exact],
        )
        for row, ordered in zip(rows, [True, *steps])
    ]
    schema = "model string, in_order boolean, as_predicted boolean, " + ", ".join(f"{m} double" for m in exact)
    return runs[0].predicted.sparkSession.createDataFrame(facts, schema)


def _rmse_again(rows: DataFrame, label: str) -> float:
    left = F.col("prediction") - F.col(label)
    return rows.agg(F.sqrt(F.avg(left * left))).first()[0]


def _f1_again(rows: DataFrame, label: str) -> float:
    late, said = F.col(label) == 1, F.col("prediction") == 1
    hit, either = rows.agg(F.count_if(late & said), F.count_if(late) + F.count_if(said)).first()
    return 2 * hit / either if either else 0.0


METRIC_AGAIN = {"rmse": _rmse_again, "f1": _f1_again}


def regression_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir, classify=False)
    runs = models.regression_runs(data, models.REPORT_FOREST, with_linear=False)
    return _board(runs, "rmse", False, "mae", "rmse")


def classification_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = prepared(spark, sf_dir)
    runs = models.classification_runs(data, models.REPORT_FOREST)
    return _board(runs, "f1", True, "accuracy", "f1", "roc_auc")


@contextmanager
def staged(spark: SparkSession, sf_dir: str) -> Iterator[Lakehouse]:
    """All five stages over the flights as CSV files."""
    root = scratch_dir(spark)
    _write_csv(by_raw_key(flights(spark, sf_dir)), f"{root}/raw")
    house = Lakehouse(spark, Settings(data_root=root))
    # The flights have one layout, so the case setting may stay as it is.
    run_stages(house)
    yield house


def stages_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airline mart after all stages."""
    with staged(spark, sf_dir) as house:
        return house.mart("airline_delay").read()


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four marts, the feature table and the run records after all stages:
    rows, flights and sums of means per table, year and month."""
    with staged(spark, sf_dir) as house:
        facts = []
        for name in MARTS:
            mart = house.mart(name).read()
            facts.append(
                mart.groupBy(F.lit(name).alias("table"), "year", "month").agg(
                    F.count(F.lit(1)).alias("rows"),
                    F.sum("flight_count").cast("bigint").alias("flights"),
                    F.round(F.sum("avg_arr_delay"), 4).alias("delays"),
                    F.round(F.sum("delay_rate"), 4).alias("rates"),
                )
            )
        table = house.features.read()
        loads = sum((F.col(c) for c in features.LOAD_COUNTS), F.lit(0))
        facts.append(
            table.groupBy(F.lit("ml_features").alias("table"), "year", "month").agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum(loads).cast("bigint").alias("flights"),
                F.round(F.sum(models.DELAY), 4).alias("delays"),
                F.sum(F.col(models.LATE).cast("double")).alias("rates"),
            )
        )
        runs = house.runs.read()
        none = F.lit(None)
        facts.append(
            runs.groupBy(F.lit("model_runs").alias("table")).agg(
                F.count(F.lit(1)).alias("rows"), F.max("training_rows").alias("flights")
            ).select(
                "table", none.cast("bigint").alias("year"), none.cast("bigint").alias("month"), "rows",
                "flights", none.cast("double").alias("delays"), none.cast("double").alias("rates"),
            )
        )
        result = facts[0]
        for part in facts[1:]:
            result = result.unionByName(part)
        return result


def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airline mart after a run over the flights of the first half of each
    year and one more over those that came later."""
    root = scratch_dir(spark)
    rows = materialize(flights(spark, sf_dir))
    house = Lakehouse(spark, Settings(data_root=root))
    for part in (F.col("Month") <= 6, F.col("Month") > 6):
        _write_csv(by_raw_key(rows.where(part)), f"{root}/raw")
        run_incremental(house, learn=False)
    return house.mart("airline_delay").read()


LEARN: dict[str, Query] = {
    "sample_exact": sample,
    "stratified_split": split,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "one_hot": one_hot,
    "ml_matrix": ml_matrix,
    "baseline_mean": baseline_mean,
    "baseline_mode": baseline_mode,
    "linear_regression": _residuals(lambda data: models.linear_regression(), "airline"),
    "ridge_regression": _residuals(lambda data: models.ridge_regression(data.train)),
    "forest_regression": forest_regression,
    "regression_stump": regression_stump,
    "classification_stump": classification_stump,
    "logistic_regression": logistic_regression,
    "forest_classification": forest_classification,
    "classification_scores": classification_scores,
    "regression_metrics": regression_metrics,
    "classification_metrics": classification_metrics,
    "roc_auc": roc_auc,
    "feature_importance": feature_importance,
    "model_runs": model_runs,
    "regression_leaderboard": regression_leaderboard,
    "classification_leaderboard": classification_leaderboard,
    "stages_end_to_end": stages_end_to_end,
    "pipeline_end_to_end": pipeline_end_to_end,
    "incremental_run": incremental_run,
}

QUERIES: dict[str, Query] = {**CORE, **TABLES, **FILES, **LEARN}

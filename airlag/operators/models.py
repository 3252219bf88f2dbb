"""Preprocessing, the seven models, their predictions and run records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlag.config import SEED, TEST_FRACTION
from airlag.operators.forest import ForestModel, ForestRegression
from airlag.operators.impute import known_columns, medians, modes
from airlag.operators.metrics import classification_metrics, regression_metrics, roc_auc
from airlag.operators.ranking import ORDER_KEY, mark_first, stratified_split, with_order_key

# Feature lists, label names and model names of the run records.
NUMERIC = [
    "distance", "hour", "day_of_week", "origin_day_flights", "dest_day_flights",
    "airline_day_flights", "route_day_flights", "origin_hour_flights", "route_hour_flights",
]
CATEGORICAL = ["airline", "origin", "dest", "season", "route"]
DELAY, LATE = "arr_delay", "is_delayed"

# Pipeline forests and the smaller-but-deeper report forests.
PIPELINE_FOREST = {"numTrees": 50, "maxDepth": 5}
REPORT_FOREST = {"numTrees": 40, "maxDepth": 6}
ITERATIONS = 1000
#: Training rows that a forest reads in one task.
ROWS_PER_TASK = 1_000_000
#: Slots up to which Spark solves least squares from one pass over the rows.
NORMAL_SLOTS = 4096


@dataclass(frozen=True)
class Prepared:
    """Assembled training and test rows, stored, plus what made them.

    ``fit`` holds the training rows that classifiers are fitted on.
    """

    train: DataFrame
    test: DataFrame
    fit: DataFrame
    stages: PipelineModel
    features: list[str]
    train_rows: int
    test_rows: int
    fit_rows: int


@dataclass(frozen=True)
class Preprocessor:
    """Fill values and category slots learned from training rows."""

    numeric: list[str]
    categorical: list[str]
    fills: dict[str, object]
    stages: PipelineModel

    def filled(self, df: DataFrame) -> DataFrame:
        return _named(df, self.numeric, self.categorical, self.fills)

    def transform(self, df: DataFrame) -> DataFrame:
        """Labels and the assembled vector; other columns stay too."""
        return self.stages.transform(self.filled(df))


def _named(df: DataFrame, numeric, categorical, fills) -> DataFrame:
    return df.withColumns(
        {
            **{
                f"num__{c}": F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c)))
                for c in numeric
            },
            **{f"text__{c}": F.coalesce(F.col(c), F.lit(fills.get(c))) for c in categorical},
        }
    )


def fit_preprocessor(train: DataFrame) -> Preprocessor:
    """Median and mode fill, one slot per known category, one vector.

    The driver receives one fill value per column and the category lists; both
    are bounded by the number of columns, airports and routes. An unknown
    category has no slot of its own and gives zeros.
    """
    numeric = known_columns(train, NUMERIC)
    categorical = known_columns(train, CATEGORICAL)
    fills: dict[str, object] = {}
    if numeric:
        fills |= {row.feature: row.fill for row in medians(train, numeric).collect()}
    if categorical:
        fills |= {row.feature: row.fill for row in modes(train, categorical).collect()}
    stages = []
    if categorical:
        stages = [
            StringIndexer(
                inputCols=[f"text__{c}" for c in categorical],
                outputCols=[f"index__{c}" for c in categorical],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"index__{c}" for c in categorical],
                outputCols=[f"cat__{c}" for c in categorical],
                dropLast=True,
            ),
        ]
    columns = [f"num__{c}" for c in numeric] + [f"cat__{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=columns, outputCol="features"))
    model = Pipeline(stages=stages).fit(_named(train, numeric, categorical, fills))
    return Preprocessor(numeric, categorical, fills, model)


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Slot names of an assembled vector, in slot order."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [slot["name"] for slot in slots]


def prepare(
    feature_table: DataFrame,
    classifier_rows: int,
    store: Callable[[DataFrame], DataFrame],
    tasks: int = 16,
    seed: int = SEED,
) -> Prepared:
    """Split, fit the preprocessing on all training rows and store both parts,
    each for itself, so that scoring reads no training row.

    At most ``classifier_rows`` training rows, the first by hash, are taken for
    fitting classifiers, and lie in ``tasks`` partitions in the order of their
    hashes, whatever the cluster; 0 leaves that part empty, and its work undone.
    Fills, slots, baselines and regressors use all training rows, and all test
    rows are scored; these lie as they come. ``store`` must persist a frame
    where all executors can read it again. A column ``ORDER_KEY`` of the table,
    if it has one, is taken for the hash of its rows.
    """
    columns = [c for c in feature_table.columns if c != ORDER_KEY]
    keyed = feature_table
    if ORDER_KEY not in keyed.columns:
        keyed = store(with_order_key(feature_table, columns, seed))
    parts = store(stratified_split(keyed, LATE, seed, TEST_FRACTION))
    train = parts.where(~F.col("is_test"))
    prep = fit_preprocessor(train)
    ready = (prep.transform(parts.where(F.col("is_test") == part)) for part in (False, True))
    train, test = (store(rows.select(*columns, ORDER_KEY, "features")) for rows in ready)
    names = vector_names(train)
    train_rows, test_rows = train.count(), test.count()
    fit, fit_rows = train.limit(0), min(classifier_rows, train_rows)
    if fit_rows:
        take = train.sparkSession.range(1).select(F.lit(classifier_rows).cast("bigint").alias("take"))
        chosen = mark_first(train, take, columns, seed, keep_rest=False).drop("chosen")
        fit = in_fixed_order(chosen, tasks)
    return Prepared(train, test, fit, prep.stages, names, train_rows, test_rows, fit_rows)


def in_fixed_order(rows: DataFrame, tasks: int) -> DataFrame:
    """Stored rows in ``tasks`` partitions by hash, in the order of the hash.

    A forest draws its samples by partition and place, so rows that are placed
    by their content give one forest, however they lay before.
    """
    place = F.xxhash64(ORDER_KEY)
    return rows.repartition(tasks, place).sortWithinPartitions(place, ORDER_KEY).checkpoint()


def forest_rows(data: Prepared, tasks: int = 16, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All training rows, placed for a forest. How many partitions there are
    follows from the number of rows alone, so it grows with the table and does
    not depend on the cluster. (One fit of all trees passes over the rows once
    for each level; a tree by itself, bagged by hash, would do so for each tree.)
    Rows without the hash column were not prepared here and lie as they come.
    """
    if ORDER_KEY not in data.train.columns:
        return data.train
    rows = data.train.select("features", DELAY, ORDER_KEY)
    return in_fixed_order(rows, max(tasks, -(-data.train_rows // rows_per_task)))


def used_columns(feature_table: DataFrame) -> list[str]:
    return known_columns(feature_table, NUMERIC + CATEGORICAL)


# --- models -----------------------------------------------------------------


def linear_regression() -> LinearRegression:
    return LinearRegression(labelCol=DELAY, regParam=0.0, maxIter=ITERATIONS)


def ridge_regression(train: DataFrame, alpha: float = 1.0) -> LinearRegression:
    """Ridge with penalty ``alpha`` on the sum of squares.

    Spark divides by the number of rows and by the label's deviation (that of
    all rows in the normal equations, else that of a sample), so the penalty is
    rescaled to mean the same. The normal equations take one pass over the rows;
    the search takes one for every step and holds all rows meanwhile, so it is
    left to vectors that are too long for them.
    """
    one = train.select("features").first()
    normal = one is not None and len(one.features) <= NORMAL_SLOTS
    spread = F.stddev_pop if normal else F.stddev_samp
    n, deviation = train.agg(F.count(F.lit(1)), spread(DELAY)).first()
    return LinearRegression(
        labelCol=DELAY,
        regParam=alpha * (deviation or 0.0) / n,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal" if normal else "l-bfgs",
        maxIter=ITERATIONS,
        tol=1e-9,
    )


def forest_regression(numTrees: int, maxDepth: int) -> ForestRegression:
    """Not Spark ML's, which spells every row out with all its slots, hundreds
    of them, and visits each one for each tree and level."""
    return ForestRegression(DELAY, numTrees, maxDepth, SEED)


def logistic_regression(fit_rows: int) -> LogisticRegression:
    """Unit inverse penalty on the summed loss, as a mean loss."""
    return LogisticRegression(
        labelCol=LATE, regParam=1.0 / fit_rows, standardization=False, maxIter=ITERATIONS
    )


def forest_classification(numTrees: int, maxDepth: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=LATE, featureSubsetStrategy="sqrt", seed=SEED,
        numTrees=numTrees, maxDepth=maxDepth,
    )


def best_split(rows: DataFrame, label: str, slots: list[str], names: list[str]) -> DataFrame:
    """``slot, side, least, most, rows, prediction`` of the two sides of a tree
    of depth 1 over ``slots`` without sampling: the split that a forest's trees
    choose first. Labels of 0 and 1 in a column of whole numbers are classes;
    each class then weighs as many rows as the other one has, for Spark merges
    two sides that predict the same class.
    """
    classes = dict(rows.dtypes)[label] != "double"
    kind = DecisionTreeClassifier if classes else DecisionTreeRegressor
    sliced = VectorSlicer(inputCol="features", outputCol="slots", indices=[names.index(s) for s in slots])
    narrow = sliced.transform(rows)
    tree = kind(labelCol=label, featuresCol="slots", maxDepth=1, seed=SEED)
    if classes:
        of_class = {row[label]: float(row["count"]) for row in rows.groupBy(label).count().collect()}
        weight = F.when(F.col(label) == 1, of_class.get(0, 1.0)).otherwise(of_class.get(1, 1.0))
        narrow, tree = narrow.withColumn("weight", weight), tree.setWeightCol("weight")
    model = tree.fit(narrow)
    at = int(model.featureImportances.toArray().argmax())
    shown = model.transform(narrow)
    found = vector_to_array("probability")[1] if classes else F.col("prediction")
    sides = shown.select(vector_to_array("slots")[at].alias("v"), found.alias("prediction"))
    order = Window.orderBy("least")
    return (
        sides.groupBy("prediction")
        .agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count(F.lit(1)).alias("rows"))
        .withColumn("side", F.when(F.row_number().over(order) == 1, "low").otherwise("high"))
        .select(F.lit(slots[at]).alias("slot"), "side", "least", "most", "rows", "prediction")
    )


def baseline_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    """Every test row gets the training mean."""
    mean = train.select(F.avg(DELAY)).scalar()
    return test.withColumn("prediction", mean)


def baseline_mode(train: DataFrame, test: DataFrame) -> DataFrame:
    """Every test row gets the most frequent class, and its certainty as score."""
    counts = train.groupBy(LATE).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col(LATE).alias("value")))
    mode = counts.agg(best.alias("best")).select(F.col("best.value").cast("double")).scalar()
    return test.withColumn("prediction", mode).withColumn(
        "score", F.when(F.col("prediction") == 1, 1.0).otherwise(0.0)
    )


def with_score(predicted: DataFrame) -> DataFrame:
    """Score = probability of the late class."""
    return predicted.withColumn("score", vector_to_array("probability")[1])


def feature_importance(model: Model | ForestModel, names: list[str]) -> DataFrame | None:
    """(feature, importance) of a forest, highest first; None for others."""
    if not hasattr(model, "featureImportances"):
        return None
    spark = SparkSession.active()
    pairs = list(zip(names, model.featureImportances.toArray().tolist()))
    table = spark.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


@dataclass(frozen=True)
class Run:
    """One fitted model with its scored test rows."""

    task: str
    name: str
    predicted: DataFrame
    model: Model | ForestModel | None = None


def regression_runs(
    data: Prepared, forest: dict[str, int] = PIPELINE_FOREST, with_linear: bool = True
) -> list[Run]:
    """Baseline, least squares (optional), ridge and forest on one split."""

    def fitted(name: str, estimator: Estimator) -> Run:
        model = estimator.fit(data.train)
        return Run("regression", name, model.transform(data.test), model)

    runs = [Run("regression", "DummyMeanRegressor", baseline_mean(data.train, data.test))]
    if with_linear:
        runs.append(fitted("LinearRegression", linear_regression()))
    runs.append(fitted("RidgeRegression", ridge_regression(data.train)))
    model = forest_regression(**forest).fit(forest_rows(data))
    runs.append(Run("regression", "RandomForestRegressor", model.transform(data.test), model))
    return runs


def classification_runs(data: Prepared, forest: dict[str, int] = PIPELINE_FOREST) -> list[Run]:
    def fitted(name: str, estimator: Estimator) -> Run:
        model = estimator.fit(data.fit)
        return Run("classification", name, with_score(model.transform(data.test)), model)

    return [
        Run("classification", "DummyMostFrequentClassifier", baseline_mode(data.train, data.test)),
        fitted("LogisticRegression", logistic_regression(data.fit_rows)),
        fitted("RandomForestClassifier", forest_classification(**forest)),
    ]


def run_metrics(run: Run) -> DataFrame:
    """One row of metrics for a run."""
    if run.task == "regression":
        return regression_metrics(run.predicted, DELAY).drop("rows")
    area = roc_auc(run.predicted, LATE).scalar()
    return classification_metrics(run.predicted, LATE).withColumn("roc_auc", area)


def leaderboard(runs: list[Run], order_by: str, descending: bool) -> DataFrame:
    """Metrics of all runs of one task, best first."""
    rows = [
        run_metrics(run).select(F.lit(run.name).alias("model"), "*") for run in runs
    ]
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return table.orderBy(F.desc(order_by) if descending else F.asc(order_by), "model")


RUN_METRICS = [
    "mae", "mse", "rmse", "r2", "accuracy", "precision", "recall", "f1", "roc_auc",
    "confusion_tn", "confusion_fp", "confusion_fn", "confusion_tp",
]


def model_runs(
    runs: list[Run], data: Prepared, features_used: list[str], gold_version: int | None
) -> DataFrame:
    """One record per model: parameters, sizes, table version and metrics.

    ``training_rows`` is the size of the whole table; the two parts are kept
    beside it.
    """
    records = []
    for run in runs:
        metrics = run_metrics(run)
        have = set(metrics.columns)
        records.append(
            metrics.select(
                F.lit(run.task).alias("task"),
                F.lit(run.name).alias("model_type"),
                F.to_json(F.array(*[F.lit(c) for c in features_used])).alias("features_used"),
                F.lit(data.train_rows).cast("bigint").alias("train_rows"),
                F.lit(data.test_rows).cast("bigint").alias("test_rows"),
                F.lit(data.train_rows + data.test_rows).cast("bigint").alias("training_rows"),
                F.lit(gold_version).cast("bigint").alias("gold_table_version"),
                *[
                    (F.col(m) if m in have else F.lit(None)).cast("double").alias(m)
                    for m in RUN_METRICS
                ],
            )
        )
    table = records[0]
    for record in records[1:]:
        table = table.unionByName(record)
    return table

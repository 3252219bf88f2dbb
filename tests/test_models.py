"""Sampling, splitting, filling, metrics and models."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from airlag.operators import forest, impute, metrics, models, ranking
from airlag.session import materialize


@pytest.fixture(scope="module")
def numbers(spark):
    """1,000 rows of which a third are copies of one row."""
    i = F.col("id")
    return materialize(
        spark.range(1000).select(
            F.when(i % 3 == 0, -1).otherwise(i).alias("k"), (i % 3 == 0).cast("int").alias("late")
        )
    )


@pytest.mark.parametrize("n", [0, 1, 200, 700, 999, 1000, 5000])
def test_sample_has_the_exact_size(numbers, n):
    found = Counter(r.k for r in ranking.sample_exact(numbers, n, 42).collect())
    assert sum(found.values()) == min(n, 1000)
    have = Counter(r.k for r in numbers.collect())
    assert all(found[k] <= have[k] for k in found)


def test_sample_is_the_order_of_the_hash(numbers):
    rows = numbers.select("k", ranking.order_hash(["k", "late"], 7).alias("h")).collect()
    expected = sorted(r.h for r in rows)[:450]
    found = ranking.sample_exact(numbers, 450, 7).select(
        ranking.order_hash(["k", "late"], 7).alias("h")
    )
    assert sorted(r.h for r in found.collect()) == expected


def test_split_is_stratified(numbers):
    parts = ranking.stratified_split(numbers, "late", 42)
    counts = {(r.late, r.is_test): r["count"] for r in parts.groupBy("late", "is_test").count().collect()}
    assert counts == {(0, True): 133, (0, False): 533, (1, True): 67, (1, False): 267}
    assert parts.groupBy().sum("k").first()[0] == numbers.groupBy().sum("k").first()[0]


def test_split_does_not_deal_rows_by_class(spark, numbers):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    # As for a table of any size: Spark may not take the cuts for small.
    spark.conf.set(key, "-1")
    try:
        parts = ranking.stratified_split(numbers, "late", 42)
        plan = parts._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert parts.where("is_test").count() == 200
    finally:
        spark.conf.set(key, before)


def test_split_with_one_class(spark):
    parts = ranking.stratified_split(spark.range(11).withColumn("late", F.lit(0)), "late", 1)
    assert parts.where("is_test").count() == 3


def test_split_keeps_rows_without_a_label(spark):
    late = F.when(F.col("id") % 10 > 0, (F.col("id") % 3 == 0).cast("int"))
    df = materialize(spark.range(100).withColumn("late", late))
    parts = ranking.stratified_split(df, "late", 42)
    assert parts.count() == 100 and parts.select("id").distinct().count() == 100
    assert parts.where("is_test").count() == 20
    assert parts.where("late is null and is_test").count() == 2


@pytest.fixture(scope="module")
def flights_table(spark):
    i = F.col("id")
    columns = {c: (F.pmod(F.xxhash64(i, F.lit(c)), F.lit(50))).cast("double") for c in models.NUMERIC}
    columns |= {c: F.concat(F.lit(c), i % 4) for c in models.CATEGORICAL}
    columns |= {models.DELAY: F.col("distance") - 20, models.LATE: (F.col("distance") > 35).cast("tinyint")}
    df = spark.range(1000)
    for name, column in columns.items():
        df = df.withColumn(name, column)
    return materialize(df)


def test_only_classifier_fitting_is_bounded(flights_table):
    data = models.prepare(flights_table, 100, materialize, tasks=4)
    assert (data.train_rows, data.test_rows, data.fit_rows) == (800, 200, 100)
    assert (data.train.count(), data.test.count(), data.fit.count()) == (800, 200, 100)
    whole = models.prepare(flights_table, 5000, materialize, tasks=4)
    assert whole.fit.count() == 800
    columns = flights_table.columns
    assert data.test.select(*columns).exceptAll(whole.test.select(*columns)).isEmpty()
    mean = data.train.agg(F.avg(models.DELAY)).first()[0]
    assert models.baseline_mean(data.train, data.test).first().prediction == mean


def test_forests_do_not_depend_on_the_input_partitions(flights_table):
    found = []
    for parts in (2, 7):
        moved = materialize(flights_table.repartition(parts, "distance"))
        data = models.prepare(moved, 0, materialize)
        placed = models.forest_rows(data, tasks=2, rows_per_task=100)
        # As many partitions as the rows ask for, wherever they lay.
        assert placed.rdd.getNumPartitions() == 8
        forest = models.forest_regression(numTrees=5, maxDepth=3).fit(placed)
        rows = forest.transform(data.test).select("id", "prediction").collect()
        found.append(sorted(map(tuple, rows)))
    assert found[0] == found[1]


def test_only_classifier_rows_lie_in_fixed_partitions(flights_table):
    data = models.prepare(flights_table, 100, materialize, tasks=3)
    assert data.fit.rdd.getNumPartitions() == 3
    for part in (data.train, data.test):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "FileScan" in plan
    assert models.prepare(flights_table, 0, materialize).fit.isEmpty()


def test_rows_are_hashed_once(spark, numbers):
    keyed = ranking.with_order_key(numbers, numbers.columns, 42)
    stored = materialize(keyed)
    plan = ranking.sample_exact(stored, 100, 42)._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan
    parts = ranking.stratified_split(stored, "late", 42)
    assert "md5" not in parts._jdf.queryExecution().executedPlan().toString()
    expected = ranking.stratified_split(numbers, "late", 42)
    assert parts.drop(ranking.ORDER_KEY).exceptAll(expected).isEmpty()
    assert ranking.sample_exact(stored, 100, 42).exceptAll(ranking.sample_exact(numbers, 100, 42)).isEmpty()


def test_best_split(planted):
    df, x, y = planted
    rows = models.best_split(df, "arr_delay", ["a", "b"], ["a", "b", "c"]).orderBy("least").collect()
    # Spark proposes a few dozen thresholds of a continuous feature.
    low = x[:, 0] <= rows[0].most
    assert rows[0].slot == "a" and [r.rows for r in rows] == [low.sum(), (~low).sum()]
    assert [r.prediction for r in rows] == pytest.approx([y[low].mean(), y[~low].mean()])
    assert rows[0].most < rows[1].least and [r.side for r in rows] == ["low", "high"]


def test_large_counts_unfold(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CHUNK", 10)
    df = spark.createDataFrame([("a", 3), ("b", 35), ("c", 0), ("d", 20)], "v string, n bigint")
    found = ranking.repeat_rows(df, "n").groupBy("v").count()
    assert {tuple(r) for r in found.collect()} == {("a", 3), ("b", 35), ("d", 20)}


def test_fills(spark):
    df = spark.createDataFrame(
        [(1, "b"), (2, "a"), (None, "a"), (10, "b"), (4, None)], "n int, t string"
    )
    filled = impute.fill(df, impute.medians(df, ["n"]), ["n"])
    assert sorted(r.n for r in filled.collect()) == [1.0, 2.0, 3.0, 4.0, 10.0]
    filled = impute.fill(df, impute.modes(df, ["t"]), ["t"])
    assert Counter(r.t for r in filled.collect()) == {"a": 3, "b": 2}


def test_regression_metrics(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "label double, prediction double")
    row = metrics.regression_metrics(df).first()
    mse = ((y - p) ** 2).mean()
    assert row.mae == pytest.approx(abs(y - p).mean())
    assert row.rmse == pytest.approx(math.sqrt(mse))
    assert row.r2 == pytest.approx(1 - mse / y.var())


def test_class_metrics_without_cases(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = metrics.classification_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.0, 0.0, 0.0)
    assert (row.confusion_tn, row.confusion_fp, row.confusion_fn, row.confusion_tp) == (1, 0, 1, 0)


def test_auc(spark):
    i = F.col("id")
    df = spark.range(3000).select(
        (F.pmod(F.xxhash64(i), F.lit(3)) == 0).cast("int").alias("label"),
        # A third of the rows share one score.
        F.when(i % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64(i, F.lit(1)), F.lit(997)) / 997).alias("score"),
    )
    expected = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", numBins=0
    ).evaluate(df)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(expected, abs=1e-12)
    assert metrics.roc_auc(df.where("label = 1")).first()[0] == 0.5


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = x @ np.array([3.0, -2.0, 0.5]) + 4 + rng.normal(scale=0.5, size=400)
    rows = [(Vectors.dense(a), float(b), int(b > 4)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, ["features", "arr_delay", "is_delayed"]).repartition(4).cache()
    return df, x, y


def test_ridge_meets_the_closed_form(planted):
    df, x, y = planted
    model = models.ridge_regression(df).fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    weights = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), weights, atol=1e-5)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ weights, abs=1e-5)


@pytest.mark.parametrize("most, solver", [(4096, "normal"), (2, "l-bfgs")])
def test_ridge_takes_one_pass_where_slots_allow(planted, monkeypatch, most, solver):
    monkeypatch.setattr(models, "NORMAL_SLOTS", most)
    df, x, y = planted
    ridge = models.ridge_regression(df, alpha=50.0)
    assert ridge.getSolver() == solver
    xc, yc = x - x.mean(0), y - y.mean()
    weights = np.linalg.solve(xc.T @ xc + 50 * np.eye(3), xc.T @ yc)
    assert np.allclose(ridge.fit(df).coefficients.toArray(), weights, atol=1e-5)


def test_scoring_reads_no_training_row(flights_table):
    data = models.prepare(flights_table, 100, materialize, tasks=4)
    train, test = (set(rows.inputFiles()) for rows in (data.train, data.test))
    assert train and test and not train & test
    assert data.train.columns == data.test.columns == [*flights_table.columns, ranking.ORDER_KEY, "features"]


def test_logistic_meets_its_optimum(planted):
    df, x, y = planted
    model = models.logistic_regression(len(y)).fit(df)
    w, b, t = model.coefficients.toArray(), model.intercept, (y > 4).astype(float)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # The gradient of the summed loss plus half the squared weights vanishes.
    assert np.abs(x.T @ (p - t) + w).max() < 1e-2
    assert abs((p - t).sum()) < 1e-2


def test_models_beat_their_baselines(planted):
    df, _, _ = planted
    data = models.Prepared(df, df, df, None, ["a", "b", "c"], 400, 400, 400)
    board = models.leaderboard(models.regression_runs(data), "rmse", False).collect()
    assert board[-1].model == "DummyMeanRegressor"
    assert board[-1].r2 == pytest.approx(0, abs=1e-9)
    board = models.leaderboard(models.classification_runs(data), "f1", True).collect()
    assert min(r.roc_auc for r in board) == 0.5
    assert all(r.roc_auc > 0.95 for r in board if r.model != "DummyMostFrequentClassifier")
    total = [r.confusion_tn + r.confusion_fp + r.confusion_fn + r.confusion_tp for r in board]
    assert set(total) == {400}


def test_unknown_categories_have_no_slot(spark):
    columns = "distance double, airline string"
    train = spark.createDataFrame([(1.0, "A"), (None, "B"), (3.0, None), (2.0, "B")], columns)
    prep = models.fit_preprocessor(train)
    assert prep.fills == {"distance": 2.0, "airline": "B"}
    other = spark.createDataFrame([(None, "A"), (5.0, "Z"), (6.0, None)], columns)
    ready = prep.transform(other)
    assert models.vector_names(ready) == ["num__distance", "cat__airline_A", "cat__airline_B"]
    assert [list(r.features.toArray()) for r in ready.select("features").collect()] == [
        [2.0, 1.0, 0.0], [5.0, 0.0, 0.0], [6.0, 0.0, 1.0]
    ]


def test_importance_names_every_slot(planted):
    df, _, _ = planted
    forest = models.forest_regression(numTrees=5, maxDepth=4).fit(df)
    ranked = models.feature_importance(forest, ["a", "b", "c"]).collect()
    assert ranked[0].feature == "a" and sum(r.importance for r in ranked) == pytest.approx(1)
    assert models.feature_importance(models.linear_regression().fit(df), ["a"]) is None


def grown_by_hand(x, y, w, cuts, depth):
    """Predictions of a tree that tries all slots and cuts, row by row."""
    mean = (w * y).sum() / w.sum()
    best, found = 1e-9, None
    for slot in range(x.shape[1] if depth else 0):
        for cut in cuts[slot]:
            left = x[:, slot] <= cut
            a, b = w[left].sum(), w[~left].sum()
            if a and b:
                gain = (w * y)[left].sum() ** 2 / a + (w * y)[~left].sum() ** 2 / b - mean**2 * w.sum()
                if gain > best + 1e-9:
                    best, found = gain, left
    if found is None:
        return np.full(len(y), mean)
    out = np.empty(len(y))
    for side in (found, ~found):
        out[side] = grown_by_hand(x[side], y[side], w[side], cuts, depth - 1)
    return out


def test_forest_is_that_of_all_slots_and_cuts(spark):
    rng = np.random.default_rng(5)
    kind = rng.integers(0, 30, 500)
    x = np.zeros((500, 33))
    x[:, 0], x[:, 1] = rng.integers(-20, 60, 500), rng.integers(0, 3, 500)
    x[np.arange(500), 3 + kind] = 1
    y = np.round(10 * (kind % 3) + 5 * (x[:, 0] > 7) * x[:, 1] + rng.normal(size=500), 2) * 4
    at = [np.flatnonzero(row) for row in x]
    vectors = [Vectors.dense(x[i]) if i % 5 == 0 else Vectors.sparse(33, at[i], x[i][at[i]]) for i in range(500)]
    rows = spark.createDataFrame([(v, float(b)) for v, b in zip(vectors, y)], ["features", "label"]).coalesce(1)
    cuts = forest.thresholds(rows, 33)
    assert list(cuts[1]) == [0.5, 1.5] and list(cuts[2]) == [] and list(cuts[3]) == [0.5]
    assert len(cuts[0]) == 31
    parts = np.searchsorted(cuts[0], x[:, 0])
    assert np.bincount(parts).max() < 500 / 32 + np.bincount((x[:, 0] + 20).astype(int)).max()
    bins = forest.Bins(cuts)
    stored = forest.binned(rows, bins, 3, 42).collect()
    # Of 33 slots, a row keeps those alone in which it lies elsewhere than 0 does.
    assert max(len(r.codes) for r in stored) <= 3
    drawn = np.array([list(r.drawn) for r in stored])
    model = forest.ForestRegression("label", 3, 3, 42).fit(rows)
    by_hand = np.mean([grown_by_hand(x, y, drawn[:, t], cuts, 3) for t in range(3)], axis=0)
    found = [r.prediction for r in model.transform(rows).collect()]
    assert found == pytest.approx(by_hand)
    assert sum(model.featureImportances.toArray()) == pytest.approx(1)


def test_forest_is_as_good_as_that_of_spark(planted):
    df, _, y = planted
    ours = models.forest_regression(20, 5).fit(df).transform(df)
    theirs = RandomForestRegressor(
        labelCol=models.DELAY, featureSubsetStrategy="all", seed=42, numTrees=20, maxDepth=5
    ).fit(df).transform(df)
    errors = [metrics.regression_metrics(p, models.DELAY).first().rmse for p in (ours, theirs)]
    assert errors[0] == pytest.approx(errors[1], rel=0.15)


def test_forest_refuses_rows_without_a_label(spark):
    rows = spark.createDataFrame([(Vectors.dense(1.0), 1.0), (Vectors.dense(2.0), None)], ["features", "label"])
    with pytest.raises(Exception, match="labels must not be null"):
        forest.ForestRegression("label", 2, 2, 42).fit(rows)
    same = rows.select("features", F.lit(3.0).alias("label"))
    model = forest.ForestRegression("label", 2, 2, 42).fit(same)
    assert {r.prediction for r in model.transform(same).collect()} == {3.0}
    assert not model.featureImportances.toArray().any()

"""Model quality from (label, prediction, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """mae, mse, rmse, r2 and the number of rows, in one pass."""
    error = F.col(label) - F.col(prediction)
    mse = F.avg(error * error)
    spread = F.var_pop(label)
    # A constant label leaves nothing to explain: perfect is 1, all else 0.
    flat = F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(spread == 0, flat).otherwise(1 - F.try_divide(mse, spread))
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        r2.alias("r2"),
        F.count(F.lit(1)).alias("rows"),
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, precision, recall, F1 and the four confusion counts; a ratio
    without cases is 0."""

    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    counts = df.agg(
        cell(0, 0).alias("tn"),
        cell(0, 1).alias("fp"),
        cell(1, 0).alias("fn"),
        cell(1, 1).alias("tp"),
    )
    return counts.select(
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        tn.alias("confusion_tn"),
        fp.alias("confusion_fp"),
        fn.alias("confusion_fn"),
        tp.alias("confusion_tp"),
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", ranges: int | None = None
) -> DataFrame:
    """Area under the ROC curve; 0.5 when only one class is present.

    Counted per distinct score, then cut into score ranges. Each range knows
    the pairs won inside it; the wins against lower ranges follow from the
    ranges' totals; there are as many ranges as shuffle partitions. Equal scores
    are one row and so never part. No task sees
    more than one range, and the last window sees one row per range.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        df.groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).cast("double").alias("pos"),
            F.count_if(F.col(label) == 0).cast("double").alias("neg"),
        )
        .repartitionByRange(ranges, "score")
        .withColumn("range", F.spark_partition_id())
    )
    inside = Window.partitionBy("range").orderBy("score")
    below = F.sum("neg").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("neg")
    per_range = (
        counts.withColumn("wins", F.col("pos") * (below + F.col("neg") / 2))
        .groupBy("range")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    earlier = Window.partitionBy(F.lit(0)).orderBy("range")
    lower = F.sum("neg").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("neg")
    totals = per_range.withColumn("won", F.col("wins") + F.col("pos") * lower).agg(
        F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    area = F.try_divide(F.col("won"), F.col("pos") * F.col("neg"))
    return totals.select(F.coalesce(area, F.lit(0.5)).alias("roc_auc"))

"""Metrics of binary predictions.

Rows are reduced to counts in one pass with map-side combine; everything after that
works on a handful of rows. Rows without a label count nowhere, and a ratio without a
denominator is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.functions.scoring import threshold_flag

COUNTS = ["true_positive", "false_positive", "true_negative", "false_negative"]


def ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """tp, fp, tn, fn of a 0/1 prediction in one row."""
    actual = F.col(label)
    return df.agg(
        F.count_if((actual == 1) & (predicted == 1)).alias("true_positive"),
        F.count_if((actual == 0) & (predicted == 1)).alias("false_positive"),
        F.count_if((actual == 0) & (predicted == 0)).alias("true_negative"),
        F.count_if((actual == 1) & (predicted == 0)).alias("false_negative"),
    )


def add_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 of the positive class, accuracy and specificity."""
    tp, fp, tn, fn = (F.col(name) for name in COUNTS)
    rates = counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "accuracy": ratio(tp + tn, tp + fp + tn + fn),
            "specificity": ratio(tn, tn + fp),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", ratio(p * r * 2, p + r))


def binary_metrics(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    return add_rates(confusion_counts(df, label, predicted))


def threshold_metrics(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] = fields.THRESHOLDS
) -> DataFrame:
    """Counts and rates at every threshold, from one pass over the rows.

    A row is reduced to its label and the number of thresholds its score reaches. Since
    thresholds ascend, that histogram of at most 2 x (thresholds + 1) cells answers all
    of them; the rows themselves are never multiplied.
    """
    steps = sorted(thresholds)
    reached = sum((threshold_flag(F.col(score), F.lit(t)) for t in steps), F.lit(0))
    cells = (
        df.filter(F.col(label).isin(0, 1))
        .groupBy(F.col(label).cast("int").alias("actual"), reached.alias("reached"))
        .agg(F.count("*").alias("n"))
    )
    # an empty cell, so that every threshold has its row even without labelled rows
    nothing = df.sparkSession.range(1).select(
        F.lit(0).alias("actual"), F.lit(0).alias("reached"), F.lit(0).cast("bigint").alias("n")
    )
    levels = [
        F.struct(F.lit(t).cast("double").alias("threshold"), F.lit(i).alias("step"))
        for i, t in enumerate(steps, start=1)
    ]
    swept = cells.unionByName(nothing).withColumn("at", F.explode(F.array(*levels)))
    flagged = F.col("reached") >= F.col("at.step")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    positive = F.col("actual") == 1
    counts = swept.groupBy(F.col("at.threshold").alias("threshold")).agg(
        total(positive & flagged).alias("true_positive"),
        total(~positive & flagged).alias("false_positive"),
        total(~positive & ~flagged).alias("true_negative"),
        total(positive & ~flagged).alias("false_negative"),
    )
    return add_rates(counts).select(
        "threshold", *COUNTS, "precision", "recall", "f1", "accuracy", "specificity"
    )


def best_threshold(metrics: DataFrame) -> DataFrame:
    """The row with the best F1; of equals, the lower threshold, which catches more returns."""
    return metrics.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def tuned_predictions(
    df: DataFrame, metrics: DataFrame, label: str, prediction: str, score: str
) -> DataFrame:
    """Rows re-scored at the best threshold, which stays a scalar subquery."""
    chosen = best_threshold(metrics).select("threshold").scalar()
    return df.select(
        F.col(label).cast("int").alias("returned"),
        F.col(prediction).cast("int").alias("default_prediction"),
        F.col(score).alias("return_probability"),
        chosen.alias("selected_threshold"),
    ).select(
        "returned",
        "default_prediction",
        threshold_flag(F.col("return_probability"), F.col("selected_threshold")).alias(
            "tuned_prediction"
        ),
        "return_probability",
        "selected_threshold",
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (actual, predicted) as found; empty cells are absent."""
    return (
        df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted"))
        .agg(F.count("*").alias("n"))
        .orderBy("actual", "predicted")
    )


def dense_confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """All four cells of a 0/1 matrix, empty ones as 0."""
    grid = df.sparkSession.range(4).select(
        F.floor(F.col("id") / 2).cast("int").alias("actual"),
        (F.col("id") % 2).cast("int").alias("predicted"),
        F.lit(0).cast("bigint").alias("n"),
    )
    found = confusion_matrix(df, label, prediction).select(
        F.col("actual").cast("int"), F.col("predicted").cast("int"), "n"
    )
    cells = found.filter(F.col("actual").isin(0, 1) & F.col("predicted").isin(0, 1))
    return (
        cells.unionByName(grid)
        .groupBy("actual", "predicted")
        .agg(F.sum("n").alias("n"))
        .orderBy("actual", "predicted")
    )


def class_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of each class that occurs."""
    cells = confusion_matrix(df.filter(F.col(label).isNotNull()), label, prediction)
    # each cell counts once for its actual and once for its predicted class
    sides = cells.withColumn(
        "side",
        F.explode(
            F.array(
                F.struct(F.col("actual").cast("int").alias("class"), F.lit(True).alias("is_actual")),
                F.struct(
                    F.col("predicted").cast("int").alias("class"), F.lit(False).alias("is_actual")
                ),
            )
        ),
    ).select("side.*", (F.col("actual") == F.col("predicted")).alias("hit"), "n")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    per_class = (
        sides.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            total(F.col("is_actual") & F.col("hit")).alias("hits"),
            total(F.col("is_actual")).alias("support"),
            total(~F.col("is_actual")).alias("predicted"),
        )
        .withColumns(
            {
                "precision": ratio(F.col("hits"), F.col("predicted")),
                "recall": ratio(F.col("hits"), F.col("support")),
            }
        )
    )
    p, r = F.col("precision"), F.col("recall")
    return per_class.withColumn("f1", ratio(p * r * 2, p + r))


def accuracy_and_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and support-weighted F1 in one row, from one pass over the rows."""
    f1, support = F.col("f1"), F.col("support")
    return class_scores(df, label, prediction).agg(
        ratio(F.sum("hits"), F.sum(support)).alias("accuracy"),
        ratio(F.sum(f1 * support), F.sum(support)).alias("f1_weighted"),
    )


def weighted_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1 of the classes averaged by their support (not the positive-class F1)."""
    f1, support = F.col("f1"), F.col("support")
    return class_scores(df, label, prediction).agg(
        ratio(F.sum(f1 * support), F.sum(support)).alias("f1_weighted")
    )


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).agg(
        ratio(F.count_if(F.col(label) == F.col(prediction)), F.count("*")).alias("accuracy")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class and averaged: precision, recall, F1, support.

    Each class row also feeds both averages, so the counts behind it are made once.
    """
    metrics = ["precision", "recall", "f1"]
    feeds = F.array(
        F.struct(F.col("class").cast("string").alias("class_label"), F.lit(1).alias("weight")),
        F.struct(F.lit("macro avg").alias("class_label"), F.lit(1).alias("weight")),
        F.struct(F.lit("weighted avg").alias("class_label"), F.col("support").alias("weight")),
    )
    fed = class_scores(df, label, prediction).withColumn("feed", F.explode(feeds))
    weight = F.col("feed.weight")
    return fed.groupBy(F.col("feed.class_label").alias("class_label")).agg(
        *[ratio(F.sum(F.col(m) * weight), F.sum(weight)).alias(m) for m in metrics],
        F.sum("support").alias("support"),
    )


def roc_auc(df: DataFrame, label: str, score: str, bins: int = 0) -> float | None:
    """Area under the ROC curve of a score; ``bins=0`` uses every distinct score.

    None if there are not both classes, where the area is undefined.

    Spark's evaluator combines equal scores before it sorts, and sorts by range.
    """
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    )
    labelled = df.select(F.col(label).cast("double").alias(label), score).dropna()
    classes = labelled.agg(F.min(label).alias("low"), F.max(label).alias("high")).first()
    if classes["low"] == classes["high"]:
        return None
    return evaluator.evaluate(labelled)


def metrics_row(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Driver-side metric values as a one-row table."""
    schema = ", ".join(f"{name} double" for name in values)
    return df.sparkSession.createDataFrame([tuple(values.values())], schema)


def sorted_metrics(metrics: DataFrame) -> DataFrame:
    """Metric rows, of which there is one per threshold, in report order with their place."""
    order = [F.desc("f1"), F.asc("threshold")]
    return metrics.withColumn("place", F.row_number().over(Window.orderBy(*order))).orderBy("place")


def metric_value(comparison: DataFrame, keyword: str, metric: str) -> DataFrame:
    """A metric of the first model whose name contains the keyword in any case, else 0."""
    hit = F.lower("model_name").contains(keyword.lower())
    first = F.min(F.when(hit, F.struct("model_name", F.col(metric).alias("value"))))
    return comparison.agg(
        F.coalesce(first["value"].cast("double"), F.lit(0.0)).alias("value")
    )

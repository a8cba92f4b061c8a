"""Feature layer, split, two forests, threshold tuning and comparison, stage by stage.

Every stage reads what it needs from the layers below one path and writes its own, all in one
format, so a failed stage is repeated without those before it:
``prepare`` -> ``train``, ``balance`` -> ``tune`` -> ``compare``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.functions.scoring import threshold_flag
from orderlens.operators import comparison, evaluation, forest, schema, skew, splits, transactions
from orderlens.plans import scoring
from orderlens.sources import layers, registry, scratch

EXPERIMENT = "order-return-prediction"
PLAIN, BALANCED = "None", "balanced"
RUN_LOG = "rf_train_runs"


@dataclass
class ForestSettings:
    """Sizes of the two forests; smaller ones are for trials.

    ``options`` go to both forests: ``hash_features``, or any of Spark's own, such as
    ``maxMemoryInMB``, ``cacheNodeIds`` and ``subsamplingRate``.
    """

    trees: int = fields.FOREST_TREES
    depth: int = fields.FOREST_DEPTH
    balanced_trees: int = fields.BALANCED_TREES
    balanced_depth: int = fields.BALANCED_DEPTH
    options: Mapping[str, object] = field(default_factory=dict)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def read(spark: SparkSession, path: str, name: str, fmt: str) -> DataFrame:
    return layers.read_layer(spark, f"{path}/{name}", fmt)


def write_splits(
    silver: DataFrame,
    path: str,
    split_keys: Sequence[str] = (fields.SPLIT_KEY,),
    min_count: int = fields.RARE_MIN_COUNT,
    fmt: str = layers.DEFAULT_FORMAT,
    validation_percent: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Write the feature layer once, then its splits and the scoring defaults of the training rows.

    Splitting by order keeps the lines of an order on one side. With ``validation_percent``
    that share of all orders, taken from the training side, chooses the threshold, so that
    the test rows only measure it.
    """
    features = layers.write_layer(
        transactions.feature_layer(silver, min_count, keep=split_keys), f"{path}/rf_features", fmt
    )
    tagged = splits.tag_split(features, split_keys, validation_percent=validation_percent)
    written = {
        part: layers.write_layer(splits.take_split(tagged, part), f"{path}/rf_{part}_split", fmt)
        for part in (splits.TRAIN, splits.TEST, splits.VALIDATION)
        if part != splits.VALIDATION or validation_percent
    }
    train = written[splits.TRAIN]
    layers.write_layer(
        scoring.defaults_table(silver.sparkSession, scoring.training_means(train)),
        f"{path}/rf_defaults",
        fmt,
    )
    # what later batches are compared with
    layers.write_layer(
        skew.histograms(train, *forest.feature_columns(train)), f"{path}/rf_histograms", fmt
    )
    return train, written[splits.TEST]


def evaluate_model(predictions: DataFrame, probability: str = "return_probability") -> DataFrame:
    """One-row AUC, accuracy and support-weighted F1 of the default predictions."""
    auc = evaluation.roc_auc(predictions, fields.LABEL, probability)
    scores = evaluation.accuracy_and_f1(predictions, fields.LABEL, "default_prediction")
    return scores.select(
        F.lit(auc).cast("double").alias("test_auc"),
        F.col("accuracy").alias("test_accuracy"),
        F.col("f1_weighted").alias("test_f1"),
    )


def _log_run(
    predictions: DataFrame, path: str, fmt: str, run_id: str, weighting: str, train_rows: int,
    trees: int, depth: int,
) -> DataFrame:
    """Append one row of the log that both models share, and return it."""
    scored = forest.with_probability(predictions)
    values = evaluate_model(scored).first().asDict()
    flagged = threshold_flag(F.col("return_probability"), F.lit(fields.SERVING_THRESHOLD))
    served = evaluation.binary_metrics(scored, fields.LABEL, flagged).first().asDict()
    values |= {
        "train_rows": train_rows,
        "test_rows": predictions.count(),
        "num_trees": trees,
        "max_depth": depth,
    }
    row = registry.run_log_row(
        predictions.sparkSession, run_id, EXPERIMENT, values, utc_now()
    ).withColumns(
        {
            "class_weighting": F.lit(weighting),
            "serving_threshold": F.lit(fields.SERVING_THRESHOLD),
            **{c: F.lit(served[c]) for c in evaluation.COUNTS},
            **{f"served_{c}": F.lit(served[c]) for c in ("accuracy", "precision", "recall", "f1")},
        }
    )
    layers.append_rows(row, f"{path}/{RUN_LOG}", fmt, run_id)
    return row


def _fit(
    spark: SparkSession, path: str, settings: ForestSettings, fmt: str, weighting: str
) -> tuple[str, DataFrame]:
    """Fit a forest on the stored split; write model and predictions; log. Returns its run id."""
    train, test = (read(spark, path, f"rf_{part}_split", fmt) for part in (splits.TRAIN, splits.TEST))
    if weighting == BALANCED:
        prefix, trees, depth = "rf_balanced", settings.balanced_trees, settings.balanced_depth
        model = forest.train_balanced_forest(train, trees, depth, **settings.options)
    else:
        prefix, trees, depth = "rf", settings.trees, settings.depth
        model = forest.train_random_forest(train, trees, depth, **settings.options)
    forest.save_model(model, f"{path}/{prefix}_model")
    run_id = uuid.uuid4().hex
    parts = {"": test}
    if layers.exists(spark, f"{path}/rf_{splits.VALIDATION}_split"):
        parts["validation_"] = read(spark, path, f"rf_{splits.VALIDATION}_split", fmt)
    for part, rows in parts.items():
        predictions = forest.batch_predict(model, rows).withColumns(
            {"run_id": F.lit(run_id), "probability": vector_to_array("probability")}
        )
        layers.write_layer(predictions, f"{path}/{prefix}_{part}predictions", fmt)
    predictions = read(spark, path, f"{prefix}_predictions", fmt)
    schema.require_nonempty(predictions, "predictions")
    _log_run(predictions, path, fmt, run_id, weighting, train.count(), trees, depth)
    return run_id, predictions


def job_train(
    spark: SparkSession, path: str, settings: ForestSettings | None = None,
    fmt: str = layers.DEFAULT_FORMAT,
) -> tuple[str, DataFrame]:
    """The plain forest on the stored splits: its run id and its test predictions."""
    return _fit(spark, path, settings or ForestSettings(), fmt, PLAIN)


def job_balance(
    spark: SparkSession, path: str, settings: ForestSettings | None = None,
    fmt: str = layers.DEFAULT_FORMAT,
) -> tuple[str, DataFrame]:
    """The forest with balanced classes on the stored splits."""
    return _fit(spark, path, settings or ForestSettings(), fmt, BALANCED)


def out_of_fold(
    train: DataFrame,
    folds: int,
    settings: ForestSettings,
    split_keys: Sequence[str] = (fields.SPLIT_KEY,),
    path: str | None = None,
    fmt: str = layers.DEFAULT_FORMAT,
) -> tuple[DataFrame, DataFrame]:
    """Scores of all training rows by models that did not see them, and what each model saw.

    Rows fall into folds by a hash of their order, so the lines of an order are in one. Fold k
    is scored by a plain forest fitted on the other folds. Returns ``split_keys``, label,
    probability and ``fold`` of every row, and the distinct ``split_keys`` that the model of
    each ``fold`` was fitted on. Both are written, below ``path`` or as scratch.
    """
    if folds < 2:
        raise ValueError("at least two folds are needed")
    fold = (splits.split_bucket(*split_keys) % folds).cast("int")
    rows = train.withColumn("fold", fold)
    scored, seen = [], []
    for k in range(folds):
        others = rows.where(F.col("fold") != k)
        model = forest.train_random_forest(
            others.drop("fold"), settings.trees, settings.depth, **settings.options
        )
        held = forest.batch_predict(model, rows.where(F.col("fold") == k), keep=[*split_keys, "fold"])
        scored.append(forest.with_probability(held))
        seen.append(others.select(*split_keys, F.lit(k).alias("fold")).distinct())

    def stored(parts: list[DataFrame], name: str) -> DataFrame:
        together = reduce(DataFrame.unionByName, parts)
        if path is None:
            return scratch.durable(together, name)
        return layers.write_layer(together, f"{path}/{name}", fmt)

    return stored(scored, "rf_out_of_fold"), stored(seen, "rf_fold_training")


def job_fold(
    spark: SparkSession, path: str, folds: int, settings: ForestSettings | None = None,
    split_keys: Sequence[str] = (fields.SPLIT_KEY,), fmt: str = layers.DEFAULT_FORMAT,
) -> DataFrame:
    """Out-of-fold scores of the stored training split, from which ``job_tune`` then chooses."""
    train = read(spark, path, f"rf_{splits.TRAIN}_split", fmt)
    return out_of_fold(train, folds, settings or ForestSettings(), split_keys, path, fmt)[0]


def job_tune(
    spark: SparkSession, path: str, fmt: str = layers.DEFAULT_FORMAT
) -> tuple[DataFrame, DataFrame]:
    """Threshold metrics of the stored predictions, and test predictions at the best threshold.

    The threshold is chosen on out-of-fold scores where there are some, else on the validation
    rows where there are some. Metrics of all parts are stored; those of the test rows are
    what a comparison reports.
    """
    predictions = read(spark, path, "rf_predictions", fmt)
    run_id = predictions.select("run_id").first()["run_id"]

    def sweep(rows: DataFrame, name: str) -> DataFrame:
        scored = rows if "return_probability" in rows.columns else forest.with_probability(rows)
        metrics = evaluation.threshold_metrics(scored, fields.LABEL, "return_probability")
        return layers.write_layer(
            metrics.withColumn("run_id", F.lit(run_id)), f"{path}/{name}", fmt
        )

    metrics = sweep(predictions, "rf_threshold_metrics")
    choosing = metrics
    if layers.exists(spark, f"{path}/rf_out_of_fold"):
        held = read(spark, path, "rf_out_of_fold", fmt)
        choosing = sweep(held, "rf_fold_threshold_metrics")
    elif layers.exists(spark, f"{path}/rf_validation_predictions"):
        held = read(spark, path, "rf_validation_predictions", fmt)
        choosing = sweep(held, "rf_validation_threshold_metrics")
    tuned = layers.write_layer(
        evaluation.tuned_predictions(
            forest.with_probability(predictions), choosing, fields.LABEL,
            "default_prediction", "return_probability",
        ),
        f"{path}/rf_tuned_predictions",
        fmt,
    )
    return metrics, tuned


def job_compare(
    spark: SparkSession, path: str, fmt: str = layers.DEFAULT_FORMAT, csv: bool = True
) -> dict[str, DataFrame]:
    """Compare the newest runs of both models from stored layers; check all outputs."""
    log = layers.read_log(spark, f"{path}/{RUN_LOG}", fmt)

    def run_of(name: str) -> DataFrame:
        run_id = read(spark, path, name, fmt).select("run_id").first()["run_id"]
        return log.where(F.col("run_id") == run_id)

    metrics = read(spark, path, "rf_threshold_metrics", fmt)
    chosen = read(spark, path, "rf_tuned_predictions", fmt).select("selected_threshold").first()
    plain = run_of("rf_predictions")
    balanced = run_of("rf_balanced_predictions").select(
        "run_id", "test_auc", "train_rows", "test_rows", *evaluation.COUNTS,
        *[F.col(f"served_{m}").alias(f"test_{m}") for m in ("accuracy", "precision", "recall", "f1")],
    )
    compared = layers.write_layer(
        comparison.model_comparison(
            comparison.tuned_model_row(
                plain, metrics.where(F.col("threshold") == chosen["selected_threshold"])
            ),
            comparison.fixed_threshold_row(balanced),
            utc_now(),
        ),
        f"{path}/rf_model_comparison",
        fmt,
    )
    if csv:
        layers.write_csv_single(compared, f"{path}/rf_model_comparison_csv")
    names = (
        "rf_features", "rf_train_split", "rf_test_split", "rf_defaults", "rf_predictions",
        "rf_balanced_predictions", "rf_threshold_metrics", "rf_tuned_predictions",
    )
    written = {name: read(spark, path, name, fmt) for name in names}
    written["rf_model_comparison"] = compared
    stored = {name: layers.stored_fingerprint(spark, f"{path}/{name}") for name in written}
    written[RUN_LOG] = log
    required = {
        "rf_model_comparison": fields.COMPARISON_COLUMNS,
        "rf_threshold_metrics": ["threshold", "f1", "run_id"],
        RUN_LOG: ["run_id", "class_weighting", "num_trees", "max_depth", "logged_at_utc"],
    }
    check = layers.artifact_check(written, required, stored)
    failed = [row["layer"] for row in check.collect() if not row["ok"]]
    failed += [m for m in ("rf_model", "rf_balanced_model") if not layers.exists(spark, f"{path}/{m}")]
    if failed:
        raise ValueError(f"missing or empty outputs: {', '.join(failed)}")
    return written


def job_train_tune_compare(
    silver: DataFrame,
    path: str,
    settings: ForestSettings | None = None,
    split_keys: Sequence[str] = (fields.SPLIT_KEY,),
    min_count: int = fields.RARE_MIN_COUNT,
    fmt: str = layers.DEFAULT_FORMAT,
    validation_percent: int = 0,
    folds: int = 0,
) -> dict[str, DataFrame]:
    """All stages one after another, from silver to the checked comparison.

    With ``folds`` the threshold is chosen on out-of-fold scores of the training rows.
    """
    spark = silver.sparkSession
    write_splits(silver, path, split_keys, min_count, fmt, validation_percent)
    if folds:
        job_fold(spark, path, folds, settings, split_keys, fmt)
    job_train(spark, path, settings, fmt)
    job_balance(spark, path, settings, fmt)
    job_tune(spark, path, fmt)
    return job_compare(spark, path, fmt)

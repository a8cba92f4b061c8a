"""Comparison of two models, both scored on the held-out lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from orderlens import fields
from orderlens.functions.scoring import threshold_flag
from orderlens.operators import comparison, evaluation, splits
from orderlens.plans import training
from orderlens.queries.evaluation import auc_sql
from orderlens.queries.registry import over_lines, query, ratio6
from orderlens.queries.tables import BUCKET_SQL
from orderlens.sources import layers, registry, scratch, star

REPORTED = datetime(2024, 1, 2, 3, 4, 5)
TUNED_RUN, BALANCED_RUN = "run-tuned", "run-balanced"


def _rates(score: str, threshold: str) -> str:
    """One row of counts of a score at a threshold over the test lines."""
    hit, miss = f"{score} >= {threshold}", f"{score} < {threshold}"
    return (
        f"SELECT cast({threshold} AS double) AS decision_threshold, "
        f"count(*) FILTER (WHERE Returned = 1 AND {hit}) AS tp, "
        f"count(*) FILTER (WHERE Returned = 0 AND {hit}) AS fp, "
        f"count(*) FILTER (WHERE Returned = 0 AND {miss}) AS tn, "
        f"count(*) FILTER (WHERE Returned = 1 AND {miss}) AS fn, "
        f"({auc_sql('test_v', score)}) AS roc_auc FROM test_v"
    )


def _model_row(source: str, names: dict[str, str], run_id: str) -> str:
    return (
        f"SELECT '{names['model_name']}' AS model_name, '{names['framework']}' AS framework, "
        f"'{names['class_weighting']}' AS class_weighting, decision_threshold, "
        "round(roc_auc + 1e-9, 6) AS roc_auc, "
        "round((tp + tn) / (tp + fp + tn + fn) + 1e-9, 6) AS accuracy, "
        "round(tp / (tp + fp) + 1e-9, 6) AS precision, "
        "round(tp / (tp + fn) + 1e-9, 6) AS recall, "
        "round(2 * tp / (2 * tp + fp + fn) + 1e-9, 6) AS f1, "
        "tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive, "
        "(SELECT count(*) FROM split_v WHERE bucket < 80) AS train_rows, "
        "(SELECT count(*) FROM test_v) AS test_rows, "
        f"'{run_id}' AS source_run_id, '{names['recommendation']}' AS recommendation, "
        f"'2024-01-02 03:04:05 UTC' AS generated_at_utc FROM {source}"
    )


_SWEEP = " UNION ALL ".join(f"({_rates('Score', str(t))})" for t in fields.THRESHOLDS)
COMPARISON_V = f""", split_v AS (SELECT *, {BUCKET_SQL} AS bucket FROM orders_v),
  test_v AS (SELECT * FROM split_v WHERE bucket >= 80),
  sweep AS ({_SWEEP}),
  tuned AS (SELECT * FROM sweep ORDER BY 2 * tp / (2 * tp + fp + fn) DESC, decision_threshold
            LIMIT 1),
  balanced AS ({_rates('Score_B', '0.5')}),
  comparison_v AS ({_model_row('tuned', comparison.TUNED_MODEL, TUNED_RUN)}
    UNION ALL {_model_row('balanced', comparison.BALANCED_MODEL, BALANCED_RUN)})"""


def split_lines(spark, sf):
    lines = star.order_lines(spark, sf).select("Order_ID", "Returned", "Score", "Score_B")
    return scratch.durable(splits.tag_split(lines, ["Order_ID"]), "scored")


def tuned_run(tagged):
    """Run-log row of the first score."""
    test = splits.take_split(tagged, splits.TEST).withColumn(
        "default_prediction", threshold_flag(F.col("Score"), F.lit(0.5))
    )
    metrics = training.evaluate_model(test.withColumnRenamed("Returned", "returned"), "Score")
    sizes = tagged.groupBy(splits.SPLIT_COLUMN).count().collect()
    rows = {row[splits.SPLIT_COLUMN]: row["count"] for row in sizes}
    values = metrics.first().asDict() | {
        "train_rows": rows[splits.TRAIN], "test_rows": rows[splits.TEST],
        "num_trees": fields.FOREST_TREES, "max_depth": fields.FOREST_DEPTH,
    }
    return registry.run_log_row(
        tagged.sparkSession, TUNED_RUN, training.EXPERIMENT, values, REPORTED
    )


def compared(spark, sf):
    """Comparison of the first score at its best threshold with the second one at 0.5."""
    tagged = split_lines(spark, sf)
    test = splits.take_split(tagged, splits.TEST)
    run = tuned_run(tagged)
    sizes = run.first()
    sweep = evaluation.threshold_metrics(test, "Returned", "Score").withColumn(
        "run_id", F.lit(TUNED_RUN)
    )
    counts = evaluation.binary_metrics(
        test, "Returned", threshold_flag(F.col("Score_B"), F.lit(0.5))
    )
    balanced = counts.select(
        F.lit(BALANCED_RUN).alias("run_id"),
        F.lit(evaluation.roc_auc(test, "Returned", "Score_B")).alias("test_auc"),
        *[F.col(m).alias(f"test_{m}") for m in ("accuracy", "precision", "recall", "f1")],
        *evaluation.COUNTS,
        *[F.lit(sizes[c]).alias(c) for c in fields.REGISTRY_PARAMS],
    )
    return comparison.model_comparison(
        comparison.tuned_model_row(run, sweep), comparison.fixed_threshold_row(balanced), REPORTED
    )


def rounded(df):
    return df.withColumns({m: ratio6(m) for m in fields.COMPARED_METRICS if m in df.columns})


@query("model_comparison", over_lines(f"{COMPARISON_V} SELECT * FROM comparison_v"))
def model_comparison(spark, sf):
    return rounded(compared(spark, sf))


_NAMES = {"base": comparison.TUNED_MODEL["model_name"],
          "other": comparison.BALANCED_MODEL["model_name"]}


@query(
    "model_differences",
    over_lines(
        COMPARISON_V + " "
        + " UNION ALL ".join(
            f"SELECT '{m}' AS metric, round(max({m}) FILTER (WHERE model_name = '{_NAMES['other']}')"
            f" - max({m}) FILTER (WHERE model_name = '{_NAMES['base']}') + 1e-9, 6) AS difference "
            "FROM comparison_v"
            for m in fields.COMPARED_METRICS
        )
    ),
)
def model_differences(spark, sf):
    table = rounded(compared(spark, sf))
    differences = comparison.model_differences(table, _NAMES["base"], _NAMES["other"])
    return differences.withColumn("difference", ratio6("difference"))


_MELTED = " UNION ALL ".join(
    f"SELECT model_name, '{m}' AS metric, {m} AS score FROM comparison_v"
    for m in fields.COMPARED_METRICS
)


@query("melt_metrics", over_lines(f"{COMPARISON_V} {_MELTED}"))
def melt_metrics(spark, sf):
    return splits.melt_metrics(rounded(compared(spark, sf)))


@query(
    "metric_label",
    over_lines(
        f"{COMPARISON_V}, melted AS ({_MELTED}) SELECT model_name, "
        "replace(upper(metric), 'ROC_AUC', 'ROC-AUC') AS metric, score FROM melted"
    ),
)
def metric_label(spark, sf):
    return splits.label_metrics(splits.melt_metrics(rounded(compared(spark, sf))))


@query(
    "filter_contains_ci",
    over_lines(
        f"{COMPARISON_V} SELECT coalesce(max(recall) FILTER (WHERE lower(model_name) "
        "LIKE '%balanced%'), 0) AS value FROM comparison_v"
    ),
)
def filter_contains_ci(spark, sf):
    return evaluation.metric_value(rounded(compared(spark, sf)), "BALANCED", "recall")


@query(
    "experiment_run_log",
    over_lines(
        f"{COMPARISON_V}, t AS (SELECT * FROM ({_rates('Score', '0.5')})) "
        f"SELECT '{TUNED_RUN}' AS run_id, '{training.EXPERIMENT}' AS experiment_name, "
        "round(roc_auc + 1e-9, 6) AS test_auc, "
        "round((tp + tn) / (tp + fp + tn + fn) + 1e-9, 6) AS test_accuracy, "
        "round(((tp + fn) * 2 * tp / (2 * tp + fp + fn) + (tn + fp) * 2 * tn "
        "/ (2 * tn + fp + fn)) / (tp + fp + tn + fn) + 1e-9, 6) AS test_f1, "
        "(SELECT count(*) FROM split_v WHERE bucket < 80) AS train_rows, "
        "(SELECT count(*) FROM test_v) AS test_rows, "
        f"cast({fields.FOREST_TREES} AS bigint) AS num_trees, "
        f"cast({fields.FOREST_DEPTH} AS bigint) AS max_depth, "
        "cast('2024-01-02 03:04:05' AS timestamp) AS logged_at_utc FROM t"
    ),
)
def experiment_run_log(spark, sf):
    """One row, although the stage that logs it ran twice."""
    path = scratch.scratch_path(spark, "train_runs")
    run = tuned_run(split_lines(spark, sf))
    layers.append_rows(run, path, run_id=TUNED_RUN)
    log = layers.append_rows(run, path, run_id=TUNED_RUN)
    return log.withColumns({m: ratio6(m) for m in ("test_auc", "test_accuracy", "test_f1")})

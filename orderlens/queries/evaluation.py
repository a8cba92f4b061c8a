"""Metrics over the deterministic scores of the order lines."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderlens.functions import scoring
from orderlens.operators import evaluation as ops
from orderlens.operators import forest, quality
from orderlens.operators.customers import customer_features
from orderlens.queries.customers import FEATURES_V, written_lines
from orderlens.queries.registry import over_lines, query, ratio6
from orderlens.sources import scratch, star

_RATES = """
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r"""
THRESHOLD_SQL = f""", cells AS (SELECT cast(t AS double) AS threshold,
    count(*) FILTER (WHERE Returned = 1 AND Score >= t) AS tp,
    count(*) FILTER (WHERE Returned = 0 AND Score >= t) AS fp,
    count(*) FILTER (WHERE Returned = 0 AND Score < t) AS tn,
    count(*) FILTER (WHERE Returned = 1 AND Score < t) AS fn
  FROM orders_v, (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7])::double AS t) GROUP BY t),
  rates AS (SELECT *, {_RATES} FROM cells),
  metrics_v AS (SELECT threshold, tp AS true_positive, fp AS false_positive,
    tn AS true_negative, fn AS false_negative, cast(p AS double) AS precision,
    cast(r AS double) AS recall,
    cast(CASE WHEN p + r > 0 THEN p * r * 2 / (p + r) ELSE 0 END AS double) AS f1,
    (tp + tn) / (tp + fp + tn + fn) AS accuracy,
    cast(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS double) AS specificity
  FROM rates)
  SELECT * FROM metrics_v"""
METRICS_V = THRESHOLD_SQL.rsplit("SELECT * FROM metrics_v", 1)[0]


def scored(spark, sf):
    """Label, score and the 0/1 prediction at 0.5 of every order line."""
    lines = star.order_lines(spark, sf).select("Order_ID", "Product_ID", "Returned", "Score")
    return lines.withColumn(
        "prediction", scoring.threshold_flag(F.col("Score"), F.lit(0.5))
    )


_PREDICTED_V = """, predicted_v AS (SELECT Returned, Score,
    CASE WHEN Score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM orders_v)"""


@query("threshold_metrics", over_lines(THRESHOLD_SQL))
def threshold_metrics(spark, sf):
    return ops.threshold_metrics(scored(spark, sf), "Returned", "Score")


@query(
    "best_threshold",
    over_lines(f"{METRICS_V} SELECT * FROM metrics_v ORDER BY f1 DESC, threshold LIMIT 1"),
)
def best_threshold(spark, sf):
    return ops.best_threshold(ops.threshold_metrics(scored(spark, sf), "Returned", "Score"))


@query(
    "sort_table",
    over_lines(
        f"{METRICS_V} SELECT cast(row_number() OVER (ORDER BY f1 DESC, threshold) AS int) "
        "AS place, threshold, f1 FROM metrics_v"
    ),
)
def sort_table(spark, sf):
    """The five metric rows in report order; their place shows the order."""
    metrics = ops.threshold_metrics(scored(spark, sf), "Returned", "Score")
    return ops.sorted_metrics(metrics).select("place", "threshold", "f1")


@query(
    "tuned_predictions",
    over_lines(
        f"{METRICS_V}, best AS (SELECT threshold FROM metrics_v ORDER BY f1 DESC, threshold "
        "LIMIT 1) SELECT Returned AS returned, "
        "CASE WHEN Score >= 0.5 THEN 1 ELSE 0 END AS default_prediction, "
        "CASE WHEN Score >= threshold THEN 1 ELSE 0 END AS tuned_prediction, "
        "Score AS return_probability, threshold AS selected_threshold FROM orders_v, best"
    ),
)
def tuned_predictions(spark, sf):
    rows = scored(spark, sf)
    metrics = scratch.durable(ops.threshold_metrics(rows, "Returned", "Score"), "thresholds")
    return ops.tuned_predictions(rows, metrics, "Returned", "prediction", "Score")


@query(
    "threshold_flag",
    over_lines(
        "SELECT Order_ID, Score, CASE WHEN Score >= 0.6 THEN 1 ELSE 0 END AS flag FROM orders_v"
    ),
)
def threshold_flag(spark, sf):
    flag = scoring.threshold_flag(F.col("Score"), F.lit(0.6))
    return scored(spark, sf).select("Order_ID", "Score", flag.alias("flag"))


@query(
    "risk_label",
    over_lines(
        "SELECT Order_ID, Score, CASE WHEN Score >= 0.75 THEN 'High return risk' "
        "WHEN Score >= 0.5 THEN 'Likely return' WHEN Score >= 0.3 THEN 'Moderate return risk' "
        "ELSE 'Low return risk' END AS risk FROM orders_v"
    ),
)
def risk_label(spark, sf):
    label = scoring.risk_label(F.col("Score"))
    return scored(spark, sf).select("Order_ID", "Score", label.alias("risk"))


@query(
    "round_score",
    over_lines(
        "SELECT Order_ID, round(Score / 7 + 1e-9, 6) AS return_probability FROM orders_v"
    ),
)
def round_score(spark, sf):
    p = F.col("Score") / 7 + F.lit(1e-9)
    return scored(spark, sf).select("Order_ID", scoring.round_score(p).alias("return_probability"))


@query(
    "extract_probability",
    over_lines("SELECT Order_ID, Product_ID, Score AS return_probability FROM orders_v"),
)
def extract_probability(spark, sf):
    vector = array_to_vector(F.array(1 - F.col("Score"), F.col("Score")))
    return (
        scored(spark, sf)
        .withColumn("probability", vector)
        .select(
            "Order_ID",
            "Product_ID",
            scoring.return_probability(F.col("probability")).alias("return_probability"),
        )
    )


@query(
    "top_k_scores",
    over_lines(
        "SELECT Score, Order_ID, Product_ID, Returned FROM orders_v "
        "ORDER BY Score DESC, Order_ID, Product_ID, Returned LIMIT 15"
    ),
)
def top_k_scores(spark, sf):
    rows = scored(spark, sf).select("Score", "Order_ID", "Product_ID", "Returned")
    return quality.top_rows(rows, [F.desc("Score"), "Order_ID", "Product_ID", "Returned"], 15)


@query(
    "confusion_counts",
    over_lines(
        f"{_PREDICTED_V} SELECT count(*) FILTER (WHERE Returned = 1 AND prediction = 1) "
        "AS true_positive, count(*) FILTER (WHERE Returned = 0 AND prediction = 1) "
        "AS false_positive, count(*) FILTER (WHERE Returned = 0 AND prediction = 0) "
        "AS true_negative, count(*) FILTER (WHERE Returned = 1 AND prediction = 0) "
        "AS false_negative FROM predicted_v"
    ),
)
def confusion_counts(spark, sf):
    return ops.confusion_counts(scored(spark, sf), "Returned", F.col("prediction"))


@query(
    "confusion_matrix",
    over_lines(
        f"{_PREDICTED_V} SELECT Returned AS actual, prediction AS predicted, count(*) AS n "
        "FROM predicted_v GROUP BY ALL"
    ),
)
def confusion_matrix(spark, sf):
    return ops.confusion_matrix(scored(spark, sf), "Returned", "prediction")


@query(
    "confusion_matrix_dense",
    over_lines(
        ", grid AS (SELECT a.v AS actual, b.v AS predicted FROM "
        "(VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v)) "
        "SELECT actual, predicted, (SELECT count(*) FROM orders_v "
        "WHERE Returned = actual AND predicted = 1) AS n FROM grid"
    ),
)
def confusion_matrix_dense(spark, sf):
    """Everything is predicted as returned, so two cells are empty and still listed."""
    rows = scored(spark, sf).withColumn("prediction", F.lit(1))
    return ops.dense_confusion_matrix(rows, "Returned", "prediction")


@query(
    "eval_accuracy",
    over_lines(
        f"{_PREDICTED_V} SELECT count(*) FILTER (WHERE Returned = prediction) / count(*) "
        "AS accuracy FROM predicted_v"
    ),
)
def eval_accuracy(spark, sf):
    return ops.accuracy(scored(spark, sf), "Returned", "prediction")


CLASSES_V = f"""{_PREDICTED_V}, counts AS (SELECT k AS class,
    count(*) FILTER (WHERE Returned = k AND prediction = k) AS hits,
    count(*) FILTER (WHERE Returned = k) AS support,
    count(*) FILTER (WHERE prediction = k) AS predicted
  FROM predicted_v, (VALUES (0), (1)) c(k) GROUP BY k),
  pr AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM counts),
  classes_v AS (SELECT *, CASE WHEN precision + recall > 0
    THEN precision * recall * 2 / (precision + recall) ELSE 0 END AS f1 FROM pr)"""


@query(
    "eval_weighted_f1",
    over_lines(
        f"{CLASSES_V} SELECT round(sum(f1 * support) / sum(support) + 1e-9, 6) AS f1_weighted "
        "FROM classes_v"
    ),
)
def eval_weighted_f1(spark, sf):
    result = ops.weighted_f1(scored(spark, sf), "Returned", "prediction")
    return result.select(ratio6("f1_weighted").alias("f1_weighted"))


@query(
    "eval_binary_prf",
    over_lines(
        f"{CLASSES_V} SELECT cast(precision AS double) AS precision, "
        "cast(recall AS double) AS recall, cast(f1 AS double) AS f1_positive "
        "FROM classes_v WHERE class = 1"
    ),
)
def eval_binary_prf(spark, sf):
    metrics = ops.binary_metrics(scored(spark, sf), "Returned", F.col("prediction"))
    return metrics.select("precision", "recall", F.col("f1").alias("f1_positive"))


@query(
    "classification_report",
    over_lines(
        f"""{CLASSES_V} SELECT class_label, round(precision + 1e-9, 6) AS precision,
        round(recall + 1e-9, 6) AS recall, round(f1 + 1e-9, 6) AS f1,
        cast(support AS bigint) AS support FROM (
          SELECT cast(class AS varchar) AS class_label, precision, recall, f1, support
          FROM classes_v
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)
          FROM classes_v
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
          FROM classes_v)"""
    ),
)
def classification_report(spark, sf):
    report = ops.classification_report(scored(spark, sf), "Returned", "prediction")
    return report.withColumns({m: ratio6(m) for m in ("precision", "recall", "f1")})


def auc_sql(source: str, score: str) -> str:
    """AUC from mid-ranks, as a scalar query."""
    return f"""SELECT (sum(mid) FILTER (WHERE Returned = 1)
        - count(*) FILTER (WHERE Returned = 1) * (count(*) FILTER (WHERE Returned = 1) + 1) / 2.0)
      / (count(*) FILTER (WHERE Returned = 1) * 1.0 * count(*) FILTER (WHERE Returned = 0))
      FROM (SELECT Returned, rank() OVER (ORDER BY {score})
        + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS mid FROM {source})"""


@query(
    "eval_roc_auc",
    over_lines(f"SELECT round(({auc_sql('orders_v', 'Score')}) + 1e-9, 6) AS roc_auc"),
)
def eval_roc_auc(spark, sf):
    rows = scored(spark, sf)
    metrics = ops.metrics_row(rows, {"roc_auc": ops.roc_auc(rows, "Returned", "Score")})
    return metrics.select(ratio6("roc_auc").alias("roc_auc"))


@query(
    "class_weights",
    over_lines(
        "SELECT Returned AS returned, count(*) AS n, round((SELECT count(*) FROM orders_v) "
        "/ (2.0 * count(*)) + 1e-9, 6) AS weight FROM orders_v GROUP BY Returned"
    ),
)
def class_weights(spark, sf):
    rows = scored(spark, sf).withColumnRenamed("Returned", "returned")
    return forest.class_weights(rows).withColumn("weight", ratio6("weight"))


@query(
    "segment_distribution",
    over_lines(
        f"{FEATURES_V} SELECT rfm_segment, count(*) AS n FROM features_v GROUP BY rfm_segment"
    ),
)
def segment_distribution(spark, sf):
    return quality.segment_distribution(customer_features(written_lines(spark, sf)))

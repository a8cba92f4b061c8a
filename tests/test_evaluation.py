from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from orderlens.functions import scoring
from orderlens.operators import comparison, evaluation, forest, quality


def scored(spark, rows):
    df = spark.createDataFrame(rows, "returned int, p double")
    return df.withColumn("prediction", scoring.threshold_flag(F.col("p"), F.lit(0.5)))


def test_labels_at_their_borders(spark):
    values = [0.2999999, 0.30, 0.50, 0.75, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double").orderBy("i")
    p = F.col("p")
    rows = df.select(scoring.risk_label(p), scoring.threshold_flag(p, F.lit(0.5))).collect()
    assert [r[0] for r in rows] == [
        "Low return risk", "Moderate return risk", "Likely return", "High return risk",
        "Low return risk",
    ]
    assert [r[1] for r in rows] == [0, 0, 1, 1, 0]


def test_probability_of_sparse_vectors(spark):
    df = spark.createDataFrame(
        [(0, Vectors.sparse(2, [1], [1.0])), (1, Vectors.sparse(2, [0], [1.0])),
         (2, Vectors.dense(0.25, 0.75))],
        ["i", "v"],
    ).orderBy("i")
    values = [r[0] for r in df.select(scoring.return_probability(F.col("v"))).collect()]
    assert values == [1.0, 0.0, 0.75]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from([0, 1, None]),
            st.one_of(st.none(), st.sampled_from([0.1, 0.3, 0.4, 0.45, 0.5, 0.7, 0.9])),
        ),
        max_size=30,
    )
)
def test_one_pass_sweep_equals_one_pass_per_threshold(spark, rows):
    df = scored(spark, rows)
    sweep = {r["threshold"]: r.asDict() for r in evaluation.threshold_metrics(df, "returned", "p").collect()}
    labelled = sum(1 for label, _ in rows if label is not None)
    recalls = []
    for t in (0.3, 0.4, 0.5, 0.6, 0.7):
        row = sweep[t]
        flag = scoring.threshold_flag(F.col("p"), F.lit(t))
        single = evaluation.binary_metrics(df, "returned", flag).first().asDict()
        assert {k: row[k] for k in single} == single
        assert sum(row[c] for c in evaluation.COUNTS) == labelled
        recalls.append(row["recall"])
    assert recalls == sorted(recalls, reverse=True)


def test_ratios_without_denominator_are_zero(spark):
    row = evaluation.threshold_metrics(scored(spark, [(0, 0.1), (0, 0.2)]), "returned", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    unlabelled = scored(spark, [(None, 0.9)])
    assert evaluation.threshold_metrics(unlabelled, "returned", "p").count() == 5
    assert evaluation.accuracy(unlabelled, "returned", "prediction").first()[0] == 0.0


def test_best_threshold_prefers_the_lower_of_equals(spark):
    metrics = evaluation.threshold_metrics(scored(spark, [(1, 0.9), (0, 0.1)]), "returned", "p")
    assert evaluation.best_threshold(metrics).first()["threshold"] == 0.3


def test_tuned_predictions(spark):
    df = scored(spark, [(1, 0.45), (0, 0.1), (1, 0.9), (0, None)])
    metrics = evaluation.threshold_metrics(df, "returned", "p")
    rows = evaluation.tuned_predictions(df, metrics, "returned", "prediction", "p").collect()
    assert {r["selected_threshold"] for r in rows} == {0.3}
    assert [(r["return_probability"], r["tuned_prediction"]) for r in rows] == [
        (0.45, 1), (0.1, 0), (0.9, 1), (None, 0)
    ]


def test_metrics_agree_with_the_evaluators(spark):
    rows = [(i % 3 == 0, (i * 37 % 100) / 100) for i in range(200)]
    df = scored(spark, [(int(label), p) for label, p in rows]).withColumns(
        {"label": F.col("returned").cast("double"), "prediction": F.col("prediction").cast("double")}
    )
    for name, ours in (
        ("accuracy", evaluation.accuracy(df, "returned", "prediction")),
        ("f1", evaluation.weighted_f1(df, "returned", "prediction")),
    ):
        judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert ours.first()[0] == pytest.approx(judge.evaluate(df))
    positives = [p for label, p in rows if label]
    negatives = [p for label, p in rows if not label]
    wins = sum((a > b) + 0.5 * (a == b) for a in positives for b in negatives)
    assert evaluation.roc_auc(df, "returned", "p") == pytest.approx(wins / len(positives) / len(negatives))


def test_dense_matrix_lists_empty_cells(spark):
    df = scored(spark, [(1, 0.9), (1, 0.8), (None, 0.1)])
    cells = evaluation.dense_confusion_matrix(df, "returned", "prediction").collect()
    assert [tuple(r) for r in cells] == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)]


def test_metric_value(spark):
    table = spark.createDataFrame(
        [("Random Forest (tuned)", 0.25), (None, 0.5), ("Balanced forest", 0.75)],
        "model_name string, recall double",
    )
    assert evaluation.metric_value(table, "BALANCED", "recall").first()[0] == 0.75
    assert evaluation.metric_value(table, "boost", "recall").first()[0] == 0.0


def test_class_weights_are_balanced(spark):
    df = scored(spark, [(0, 0.1)] * 6 + [(1, 0.9)] * 2 + [(None, 0.5)])
    weights = {r["returned"]: r["weight"] for r in forest.class_weights(df).collect()}
    assert weights == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}
    total = forest.with_class_weight(df).groupBy("returned").agg(F.sum(forest.WEIGHT).alias("w"))
    assert {r["returned"]: r["w"] for r in total.collect()} == {0: pytest.approx(4.0), 1: 4.0, None: None}


def test_quartiles_of_a_small_score(spark):
    df = spark.createDataFrame([(i / 100,) for i in range(1, 101)], "p double")
    assert tuple(quality.probability_summary(df, "p").first()) == (0.01, 0.25, 0.5, 0.75, 1.0)


def test_differences_between_models(spark):
    table = spark.createDataFrame([("a", 0.5, 0.1), ("b", 0.75, 0.3)], "model_name string, roc_auc double, f1 double")
    rows = comparison.model_differences(table, "a", "b").collect()
    assert {r["metric"]: r["difference"] for r in rows} == {
        "roc_auc": pytest.approx(0.25), "f1": pytest.approx(0.2)
    }


def test_auc_without_both_classes_is_undefined(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.9), (None, 0.1)], "returned int, p double")
    assert evaluation.roc_auc(df, "returned", "p") is None
    assert evaluation.roc_auc(df.limit(0), "returned", "p") is None


def test_quartiles_are_exact(spark):
    df = spark.range(0, 30_011, 1, 7).withColumn("p", F.col("id") / 30_011)
    values = [round(v * 30_011) for v in quality.probability_summary(df, "p").first()]
    assert values == [0, 7502, 15005, 22508, 30010]


def test_balanced_weights_need_a_binary_label(spark):
    df = spark.createDataFrame([(2,), (1,)], "returned int")
    with pytest.raises(Exception, match="must be 0 or 1"):
        forest.with_class_weight(df).collect()

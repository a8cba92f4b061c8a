"""Thresholds from out-of-fold scores, and reports of batches that differ from training."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.operators import evaluation, skew
from orderlens.plans import training
from orderlens.sources import layers


@pytest.fixture(scope="module")
def train(spark):
    i = F.col("id")
    return spark.range(600).select(
        (i / 3).cast("long").alias(fields.SPLIT_KEY),
        (i % 4).cast("double").alias("quarter"),
        (i * 7919 % 31).cast("double").alias("quantity"),
        (i * 7919 % 31 > 20).cast("int").alias("returned"),
    )


def test_no_model_scores_what_it_saw(spark, train, tmp_path):
    small = training.ForestSettings(2, 2)
    scored, seen = training.out_of_fold(train, 3, small, path=str(tmp_path))
    assert scored.count() == train.count()
    assert scored.join(seen, [fields.SPLIT_KEY, "fold"], "left_semi").isEmpty()
    # each order was seen by the two models of the other folds
    assert {r["count"] for r in seen.groupBy(fields.SPLIT_KEY).count().collect()} == {2}
    assert scored.groupBy(fields.SPLIT_KEY).agg(F.count_distinct("fold").alias("n")).where("n > 1").isEmpty()
    best = evaluation.best_threshold(
        evaluation.threshold_metrics(scored, fields.LABEL, "return_probability")
    ).first()
    assert best["f1"] > 0.9  # the label follows from the quantity
    assert layers.read_layer(spark, str(tmp_path / "rf_out_of_fold")).count() == 600


def test_one_fold_is_refused(train):
    with pytest.raises(ValueError, match="two folds"):
        training.out_of_fold(train, 1, training.ForestSettings(1, 1))


SCHEMA = "c string, d string, x double, y double, z double"


def report(spark, before, batch):
    stored = skew.histograms(spark.createDataFrame(before, SCHEMA), ["c", "d"], ["x", "y"])
    return {r["feature"]: r for r in skew.skew_report(stored, batch).collect()}


def test_skew_against_plain_counts(spark):
    before = [("a" if i % 3 else "b", None if i % 5 == 0 else "d", float(i), 1.0, 0.0) for i in range(30)]
    batch = [("a", "d", float(i), 1.0, 0.0) for i in range(20, 40)] + [
        ("A", None, float("nan"), 2.0, 0.0), (None, "new", None, 0.0, 0.0)]
    found = report(spark, before, spark.createDataFrame(batch, SCHEMA))
    n = len(batch)
    assert {f: (r["records"], round(r["missing_share"] * n), round(r["unseen_share"] * n)) for f, r in found.items()} == {
        "c": (n, 1, 1), "d": (n, 1, 1), "x": (n, 2, 10), "y": (n, 0, 2)}
    shares = {"a": (20 / 30, 20 / n), "b": (10 / 30, 1e-6), "A": (1e-6, 1 / n), None: (1e-6, 1 / n)}
    want = sum((q - p) * math.log(q / p) for p, q in shares.values())
    assert found["c"]["stability"] == pytest.approx(want)


def test_equal_batches_have_no_skew(spark):
    before = [("a", "b", float(i % 7), float(i), 0.0) for i in range(50)]
    found = report(spark, before, spark.createDataFrame(before, SCHEMA))
    assert all(r["stability"] == 0 and r["unseen_share"] == 0 for r in found.values())


def test_absent_columns_and_empty_batches(spark):
    before = [("a", None, None, 1.0, 0.0)] * 4
    batch = spark.createDataFrame([("a",), ("q",)], "c string")
    found = report(spark, before, batch)
    assert (found["c"]["unseen_share"], found["d"]["missing_share"]) == (0.5, 1.0)
    assert found["y"]["missing_share"] == 1.0 and found["x"]["missing_share"] == 1.0
    empty = report(spark, before, batch.limit(0))
    assert all(r["records"] == 0 and r["stability"] is None for r in empty.values())


def test_case_is_reported_not_only_scored(spark):
    before = [("germany", "x", 1.0, 1.0, 0.0)] * 5
    shouted = spark.createDataFrame([("GERMANY", "x", 1.0, 1.0, 0.0)] * 3, SCHEMA)
    assert report(spark, before, shouted)["c"]["unseen_share"] == 1.0

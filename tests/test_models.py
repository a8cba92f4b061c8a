from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.operators import forest, transactions
from orderlens.plans import scoring, training
from orderlens.queries import QUERIES
from orderlens.sources import layers, scratch, star
from orderlens.streaming import scoring as streaming

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return scratch.durable(star.order_lines(spark, SF_DIR).drop("Score", "Score_B"), "silver")


@pytest.fixture(scope="module")
def split(spark, silver):
    return training.write_splits(silver, scratch.scratch_path(spark, "splits"))


@pytest.fixture(scope="module")
def model(split):
    return forest.train_balanced_forest(split[0], trees=5, depth=4)


def records(silver):
    return transactions.add_date_parts(silver.toDF(*[c.lower() for c in silver.columns]))


def test_training_is_repeatable(split, model):
    again = forest.train_balanced_forest(split[0], trees=5, depth=4)
    assert again.stages[-1].featureImportances == model.stages[-1].featureImportances


def test_saved_model_predicts_the_same(spark, split, model):
    path = scratch.scratch_path(spark, "model")
    forest.save_model(model, path)
    test = split[1]
    before, after = (
        forest.with_probability(forest.batch_predict(m, test, keep=["order_id"])).orderBy(
            "order_id", "return_probability").collect()
        for m in (model, forest.load_model(path))
    )
    assert before == after


def test_importances_are_named_and_sum_to_one(split, model):
    rows = forest.feature_importances(model, split[0]).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    names = {r["feature"] for r in rows}
    assert "unit_price" in names and any(n.startswith("country_ohe") for n in names)
    assert not any("order_id" in n for n in names)


def test_training_without_features_is_refused(spark):
    with pytest.raises(ValueError, match="no usable feature"):
        forest.train_random_forest(spark.createDataFrame([(1,)], "returned int"))


def test_batch_scores_equal_scores_of_its_halves(silver, model):
    rows = records(silver)
    def scores(df):
        out = scoring.score_batch(model, df, keep=["order_id", "product_id"])
        return sorted(map(tuple, out.collect()))
    even = F.col("order_id") % 2 == 0
    assert scores(rows) == sorted(scores(rows.filter(even)) + scores(rows.filter(~even)))


def test_silver_rows_score_as_their_records(silver, model):
    scored = scoring.score_batch(model, silver, keep=["Order_ID", "Product_ID"])
    expected = scoring.score_batch(model, records(silver), keep=["order_id", "product_id"])
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, expected.collect()))
    assert scored.select("return_probability").distinct().count() > 10


def test_partial_records(spark, model):
    columns = "id int, country string, quantity double, unknown_field string"
    df = spark.createDataFrame(
        [(1, " NATION_3 ", 2.0, "x"), (2, "nation_3", 2.0, None), (3, "atlantis", 2.0, None),
         (4, None, 2.0, None), (5, None, None, None)],
        columns,
    )
    scored = {r["id"]: r for r in scoring.score_batch(model, df, keep=["id"]).collect()}
    assert len(scored) == 5
    # cleaning makes the first two equal; unknown and missing categories are the same
    assert scored[1]["return_probability"] == scored[2]["return_probability"]
    assert scored[3]["return_probability"] == scored[4]["return_probability"]
    assert all(r["threshold"] == 0.5 and 0 <= r["return_probability"] <= 1 for r in scored.values())
    assert set(scoring.score_batch(model, df).columns) == {
        "prediction", "return_probability", "threshold", "risk_label"
    }


def test_defaults_fill_missing_numbers(spark, split):
    means = scoring.training_means(split[0])
    row = scoring.prepare_records(spark.createDataFrame([(1.0,)], "quantity double"), means).first()
    assert row["quantity"] == 1.0 and row["unit_price"] == means["unit_price"]
    assert scoring.prepare_records(spark.createDataFrame([(1.0,)], "quantity double")).first()["unit_price"] == 0.0


def test_day_and_other_keep_their_case(spark):
    df = spark.createDataFrame([("Monday", "Other", "ACME  Inc")], "day_of_week string, brand string, country string")
    row = scoring.prepare_records(df).first()
    assert (row["day_of_week"], row["brand"], row["country"]) == ("Monday", "Other", "acme inc")


def test_stream_equals_batch_and_continues(spark, silver, model, tmp_path):
    rows = records(silver)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    even = F.col("order_id") % 2 == 0

    def run():
        stream = streaming.read_records(spark, source, rows.schema, max_files=2)
        streaming.stream_score(
            model, stream, out, checkpoint, keep=["order_id", "product_id"]
        ).awaitTermination()
        return sorted(map(tuple, layers.read_layer(spark, out).collect()))

    def batch(df):
        return sorted(map(tuple, scoring.score_batch(model, df, keep=["order_id", "product_id"]).collect()))

    rows.filter(even).write.parquet(source)
    assert run() == batch(rows.filter(even))
    rows.filter(~even).write.mode("append").parquet(source)
    assert run() == batch(rows)


def test_whole_job(spark, silver, tmp_path):
    small = training.ForestSettings(trees=4, depth=3, balanced_trees=4, balanced_depth=3)
    path = str(tmp_path / "job")
    written = training.job_train_tune_compare(silver, path, small)
    compared = written["rf_model_comparison"]
    assert compared.columns == [*fields.COMPARISON_COLUMNS, "generated_at_utc"]
    rows = {r["class_weighting"]: r for r in compared.collect()}
    assert set(rows) == {"None", "balanced"}
    test_rows = written["rf_test_split"].count()
    for row in rows.values():
        cells = row["true_positive"] + row["false_positive"] + row["true_negative"] + row["false_negative"]
        assert cells == row["test_rows"] == test_rows
    # the balanced forest finds more of the returns
    assert rows["balanced"]["recall"] > 0
    run_ids = {r["run_id"] for r in written["rf_threshold_metrics"].collect()}
    assert run_ids == {rows["None"]["source_run_id"]}
    # a second run appends both models to the log and compares its own runs only
    again = training.job_train_tune_compare(silver, path, small)
    assert again["rf_train_runs"].count() == 4 and again["rf_model_comparison"].count() == 2
    newest = {r["source_run_id"] for r in again["rf_model_comparison"].collect()}
    assert not newest & {r["source_run_id"] for r in rows.values()}


def test_trees_grow_in_tasks_of_bounded_rows(spark, split, monkeypatch):
    """A densely packed layer is one part, of which a task would hold every row unpacked."""
    packed = scratch.durable(split[0].coalesce(1), "packed")
    grown_on = []
    fit = forest.RandomForestClassifier.fit

    def watched(self, rows):
        sizes = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        grown_on.extend(sizes)
        return fit(self, rows)

    monkeypatch.setattr(forest.RandomForestClassifier, "fit", watched)
    monkeypatch.setattr(forest, "TASK_BYTES", 500_000, raising=False)
    setting = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(setting)
    forest.train_balanced_forest(packed, trees=2, depth=2)
    assert sum(grown_on) == packed.count()
    assert max(grown_on) <= 500_000 // 400 < packed.count()
    assert spark.conf.get(setting) == before


class _Grown(Exception):
    pass


@pytest.mark.parametrize(
    ("name", "size"),
    [
        ("train_random_forest", (fields.FOREST_TREES, fields.FOREST_DEPTH)),
        ("train_balanced_forest", (fields.BALANCED_TREES, fields.BALANCED_DEPTH)),
    ],
)
def test_training_queries_grow_the_whole_forest(spark, monkeypatch, name, size):
    """Sizes of the data contract, not those of a trial."""

    def watched(self, rows):
        raise _Grown(self.getNumTrees(), self.getMaxDepth())

    monkeypatch.setattr(forest.RandomForestClassifier, "fit", watched)
    with pytest.raises(_Grown) as grown:
        QUERIES[name](spark, SF_DIR)
    assert grown.value.args == size


def _kept(spark, name):
    """Scratch tables of this name that are still there."""
    root = Path(scratch.scratch_root(spark))
    return {str(p) for p in root.rglob(f"{name}-*") if p.is_dir()}


def test_vectors_go_once_the_trees_are_grown(spark, split):
    """A model a fold would else leave its vectors on disk until the last fold is scored."""
    before = _kept(spark, "vectors")
    model = forest.train_random_forest(split[0], trees=2, depth=2)
    assert _kept(spark, "vectors") == before
    assert forest.batch_predict(model, split[1]).count() == split[1].count()


def test_streamed_scores_need_no_training_layers(spark):
    before = _kept(spark, "splits")
    row = QUERIES["stream_score"](spark, SF_DIR).first()
    assert (row["n"], row["changed"]) == (6000, 0)
    assert _kept(spark, "splits") == before

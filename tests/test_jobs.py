"""The command line, end to end on a small CSV made from the star schema."""

from __future__ import annotations

import os

from orderlens import __main__ as jobs
from orderlens.operators import forest
from orderlens.plans import scoring, training
from orderlens.sources import layers, scratch, star

SF_DIR = "/root/testdata/sf0.001"


def test_raw_to_scores(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in ("raw", "silver", "features", "models", "scores", "live")}
    layers.write_csv(star.raw_lines(spark, SF_DIR), path["raw"])

    def run(job, source, target, *options):
        args = jobs.parser().parse_args(
            [job, "--input", path[source], "--output", path[target], *options]
        )
        args.run(spark, args)

    run("silver", "raw", "silver")
    silver = layers.read_layer(spark, path["silver"])
    assert silver.count() == 6000 and dict(silver.dtypes)["Order_Amount"] == "double"
    run("features", "silver", "features")
    assert layers.read_layer(spark, f"{path['features']}/customer_ml_features").count() == 150
    small = ("--trees", "3", "--depth", "3", "--balanced-trees", "3", "--balanced-depth", "3")
    run("train", "silver", "models", *small)
    model = ("--model", f"{path['models']}/rf_balanced_model")
    # silver rows are records too
    run("score", "silver", "scores", *model, "--keep", "Order_ID")
    scores = layers.read_layer(spark, path["scores"])
    assert scores.count() == 6000 and "Order_ID" in scores.columns
    run(
        "stream", "silver", "live", *model, "--checkpoint", str(tmp_path / "checkpoint"),
        "--schema-from", path["silver"],
    )
    live = layers.read_layer(spark, path["live"])
    assert live.exceptAll(scores.select(live.columns)).count() == 0 and live.count() == 6000


def test_stages_restart_from_stored_layers(spark, tmp_path):
    silver = str(tmp_path / "silver")
    lines = layers.write_layer(star.order_lines(spark, SF_DIR), silver, "orc")
    path = str(tmp_path / "models")

    def run(job, *options):
        args = jobs.parser().parse_args([job, "--output", path, "--format", "orc", *options])
        args.run(spark, args)

    small = ("--trees", "2", "--depth", "2", "--balanced-trees", "2", "--balanced-depth", "2")
    run("prepare", "--input", silver, "--validation-percent", "20")
    for job in ("fit", "balance"):
        run(job, *small)
    run("tune")
    run("compare")
    run("tune")  # again from the middle
    run("compare")
    assert set(os.listdir(path)) >= {"rf_validation_split", "rf_model", "rf_model_comparison_csv"}
    names = ("model_name", "train_rows", "test_rows")
    compared = layers.read_layer(spark, f"{path}/rf_model_comparison", "orc").select(*names)
    settings = training.ForestSettings(2, 2, 2, 2)
    once = training.job_train_tune_compare(
        lines, str(tmp_path / "once"), settings, fmt="orc", validation_percent=20
    )["rf_model_comparison"].select(*names)
    assert sorted(map(tuple, compared.collect())) == sorted(map(tuple, once.collect()))
    log = layers.read_log(spark, f"{path}/rf_train_runs", "orc")
    assert {r["class_weighting"]: r["num_trees"] for r in log.collect()} == {"None": 2, "balanced": 2}
    defaults = scoring.read_defaults(layers.read_layer(spark, f"{path}/rf_defaults", "orc"))
    assert defaults["quantity"] > 1


def test_hashed_categories_train(spark):
    rows = [(i % 2, f"v{i % 50}", float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "returned int, brand string, quantity double")
    model = forest.train_random_forest(df, 2, 2, hash_features=16)
    assert model.transform(df).select("features").first()[0].size == 17


def test_a_scope_leaves_nothing(spark):
    before = os.listdir(scratch.scratch_root(spark)) if os.path.exists(scratch.scratch_root(spark)) else []
    with scratch.scope(spark):
        assert scratch.durable(spark.range(3), "inside").count() == 3
    assert sorted(os.listdir(scratch.scratch_root(spark))) == sorted(before)


def test_scratch_can_be_dropped(spark):
    scratch.durable(spark.range(3), "gone")
    scratch.drop_scratch(spark)
    from pathlib import Path

    assert not Path(scratch.scratch_root(spark)).exists()

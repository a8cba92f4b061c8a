from __future__ import annotations

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens.operators import customers
from orderlens.plans.features import job_features
from orderlens.sources import layers, registry, scratch, star
from tests.test_customers import lines  # noqa: F401  (fixture)


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(spark.range(5).withColumn("a", F.lit(1)), path)
    again = layers.write_layer(spark.range(2).withColumn("b", F.lit("x")), path)
    assert again.columns == ["id", "b"] and again.count() == 2


def test_appended_columns_are_null_in_older_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    layers.append_rows(spark.createDataFrame([("r1",)], "run_id string"), path)
    log = layers.append_rows(spark.createDataFrame([("r2", 0.5)], "run_id string, auc double"), path)
    assert sorted(map(tuple, log.collect())) == [("r1", None), ("r2", 0.5)]


def test_one_csv_file_only_on_request(spark, tmp_path):
    df = spark.range(100).repartition(4)
    for write, single in ((layers.write_csv_single, True), (layers.write_csv, False)):
        path = tmp_path / write.__name__
        write(df, str(path))
        assert (len(list(Path(path).glob("part-*"))) == 1) is single
        assert spark.read.schema("id long").option("header", True).csv(str(path)).count() == 100


def test_scratch_needs_a_shared_folder_off_local(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.app.id": "app", "spark.master": "yarn", "spark.sql.warehouse.dir": "file:/tmp/w"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())


def test_durable_table_survives_its_source(spark, tmp_path):
    source = layers.write_layer(spark.range(10), str(tmp_path / "source"))
    kept = scratch.durable(source.filter("id > 3"), "kept")
    layers.write_layer(spark.range(1), str(tmp_path / "source"))
    assert kept.count() == 6
    assert scratch.scratch_root(spark) in kept.inputFiles()[0]


def test_spread_only_when_there_are_too_few_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    few = spark.range(0, 100, 1, 1)
    assert star._spread(few, "id").rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, cores + 3)
    assert star._spread(many, "id") is many


def test_quality_of_layers(spark):
    full, empty = spark.range(3), spark.range(0)
    counts = layers.layer_counts({"full": full, "empty": empty}).collect()
    assert {r["layer"]: r["rows"] for r in counts} == {"full": 3, "empty": 0}
    check = layers.artifact_check({"full": full, "empty": empty, "poor": full}, {"poor": ["id", "x"]})
    assert {r["layer"]: (r["ok"], r["missing_columns"]) for r in check.collect()} == {
        "full": (True, ""), "empty": (False, ""), "poor": (False, "x")
    }


def test_registry_lookups(spark):
    day = datetime.datetime
    runs = spark.createDataFrame(
        [("r1", "e", "FINISHED", day(2024, 1, 1)), ("r2", "e", "FINISHED", day(2024, 1, 2)),
         ("r3", "e", "FAILED", day(2024, 1, 3)), ("r4", "f", "FINISHED", day(2024, 1, 4)),
         ("r5", "e", "FINISHED", day(2024, 1, 5))],
        "run_uuid string, experiment_id string, status string, start_time timestamp",
    )
    tags = spark.createDataFrame(
        [(f"r{i}", "runName", "forest" if i != 5 else "other") for i in range(1, 6)],
        "run_uuid string, key string, value string",
    )
    experiments = spark.createDataFrame([("e", "returns"), ("f", "else")], "experiment_id string, name string")
    found = registry.latest_finished_runs(runs, tags, "runName", "forest", experiment_id="e")
    assert [r["run_id"] for r in found.collect()] == ["r2"]
    by_sql = registry.latest_runs_sql(spark, experiments, runs, tags, "runName", "forest")
    assert {r["experiment_name"]: r["run_id"] for r in by_sql.collect()} == {
        "returns": "r2", "else": "r4"
    }
    pairs = spark.createDataFrame([("r2", "auc", 0.9), ("r1", "f1", 0.5)], "run string, key string, value double")
    wide = registry.key_values_wide(pairs, "run", "key", "value", ["auc", "f1"])
    lacking = registry.missing_keys(wide, "run", ["auc", "f1"]).collect()
    assert {r["run"]: r["missing"] for r in lacking} == {"r1": ["auc"], "r2": ["f1"]}


def test_feature_job_writes_all_outputs(spark, lines, tmp_path):  # noqa: F811
    written = job_features(
        lines, str(tmp_path / "features"), csv_path=str(tmp_path / "csv"), database="orderlens_test"
    )
    assert written["customer_features"].columns == [customers.KEY, *customers.FEATURE_COLUMNS]
    assert written["customer_ml_features"].count() == written["customer_features"].count() == 4
    for name, layer in written.items():
        assert spark.table(f"orderlens_test.{name}").count() == layer.count()
        assert len(list((tmp_path / "csv" / name).glob("part-*"))) == 1
    assert spark.catalog.currentDatabase() == "default"

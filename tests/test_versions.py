"""Versions of a layer: pinned readers, failed writes, fingerprints."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens.sources import fingerprint, layers


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_a_reader_keeps_the_version_it_opened(spark, tmp_path, fmt):
    path = str(tmp_path / "layer")
    layers.write_layer(spark.range(5), path, fmt)
    opened = layers.read_layer(spark, path, fmt)
    again = layers.write_layer(spark.range(7).withColumn("b", F.lit("x")), path, fmt)
    assert ids(opened) == list(range(5)) and opened.columns == ["id"]
    assert ids(again) == ids(layers.read_layer(spark, path, fmt)) == list(range(7))
    assert again.columns == ["id", "b"]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(spark.range(5), path)
    before = layers.versions(spark, path)
    broken = spark.range(100, numPartitions=4).withColumn(
        "x", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.lit("y"))
    )
    with pytest.raises(Exception, match="lost"):
        layers.write_layer(broken, path)
    assert layers.versions(spark, path) == before
    assert ids(layers.read_layer(spark, path)) == list(range(5))
    assert [p.name for p in Path(path).iterdir() if p.name.startswith("v-")] == before


def test_a_layer_can_be_replaced_by_what_is_made_of_it(spark, tmp_path):
    """With a plain overwrite this deletes its own input."""
    path = str(tmp_path / "layer")
    layer = layers.write_layer(spark.range(5), path)
    layer = layers.write_layer(layer.where("id > 1"), path)
    assert ids(layers.write_layer(layer.union(layer), path)) == [2, 2, 3, 3, 4, 4]


def test_versions_are_kept_and_named(spark, tmp_path):
    path = str(tmp_path / "layer")
    for n in (1, 2, 3, 4):
        layers.write_layer(spark.range(n), path, keep=3)
    names = layers.versions(spark, path)
    assert [layers.read_layer(spark, path, version=v).count() for v in names] == [4, 3, 2]
    assert sorted(p.name for p in Path(path).iterdir() if p.name.startswith("v-")) == sorted(names)
    with pytest.raises(ValueError, match="no version"):
        layers.read_layer(spark, path, version="v-none")
    with pytest.raises(ValueError, match="no versions"):
        layers.read_layer(spark, str(tmp_path / "other"), version="v-1")


def test_partition_columns_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("02", 2), (None, 3)], "day string, n int")
    back = layers.write_layer(df, str(tmp_path / "layer"), partition_by=["day"])
    assert sorted(back.select("day", "n").collect(), key=lambda r: r["n"]) == df.collect()
    assert layers.layer_counts(
        {"l": back}, {"l": layers.stored_fingerprint(spark, str(tmp_path / "layer"))}
    ).first()["ok"]


def test_plain_folders_still_read(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert layers.read_layer(spark, str(tmp_path / "plain")).count() == 4
    assert layers.stored_fingerprint(spark, str(tmp_path / "plain")) is None


def test_catalog_tables_are_replaced_in_one_step(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS swaps")
    spark.range(2).write.mode("overwrite").saveAsTable("swaps.t")  # not saved by us
    layers.save_tables(spark, "swaps", {"t": spark.range(3)})
    opened = spark.table("swaps.t")
    layers.save_tables(spark, "swaps", {"t": spark.range(6).withColumn("b", F.lit(1))})
    assert ids(opened) == [0, 1, 2]
    assert spark.table("swaps.t").columns == ["id", "b"] and spark.table("swaps.t").count() == 6
    with pytest.raises(Exception, match="lost"):
        layers.save_tables(
            spark, "swaps", {"t": spark.range(2).select(F.raise_error(F.lit("lost")).alias("x"))}
        )
    assert spark.table("swaps.t").count() == 6


ROWS = [(1, "a", 0.5, [1, None], {"k": "v"}), (2, None, None, None, None), (2, None, None, None, None),
        (None, "", float("nan"), [], {})]
SCHEMA = "id int, s string, x double, xs array<int>, m map<string,string>"


def changes(df):
    yield df.where("id is null or id <> 1")  # lost
    yield df.union(df.where("id = 1"))  # doubled
    yield df.where("id = 1").union(df.where("id = 1")).union(df.where("id is null or id <> 1"))
    yield df.withColumn("s", F.when(F.col("id") == 1, "b").otherwise(F.col("s")))
    yield df.withColumn("s", F.coalesce("s", F.lit("")))
    yield df.withColumn("m", F.when(F.col("id") == 1, F.create_map(F.lit("k"), F.lit("w"))).otherwise(F.col("m")))
    # two values change places
    yield df.withColumnsRenamed({"id": "a", "s": "b"}).selectExpr("cast(b as string) s", "a id", "x", "xs", "m").withColumn(
        "id", F.when(F.col("id") == 1, 3).otherwise(F.col("id")))


def test_fingerprints_tell_every_change_but_not_the_order(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = str(tmp_path / "layer")
    layers.write_layer(df, path)
    stored = layers.stored_fingerprint(spark, path)
    assert stored["rows"] == "4" and fingerprint.of(df) == stored
    shuffled = df.orderBy(F.desc("id")).repartition(3).select(*reversed(df.columns))
    assert fingerprint.of(shuffled) == stored
    for changed in changes(df):
        check = layers.layer_counts({"l": changed}, {"l": stored}).first()
        assert check["ok"] is False, changed.collect()
        assert layers.artifact_check({"l": changed}, stored={"l": stored}).first()["ok"] is False
    assert layers.layer_counts({"l": layers.read_layer(spark, path)}, {"l": stored}).first()["ok"]
    assert layers.layer_counts({"l": df}).first()["ok"] is None


def test_a_damaged_file_is_found(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(spark.range(40, numPartitions=4), path)
    part = next((Path(path) / layers.versions(spark, path)[0]).glob("part-0000[123]*"))
    part.unlink()
    check = layers.artifact_check(
        {"l": layers.read_layer(spark, path)}, stored={"l": layers.stored_fingerprint(spark, path)}
    ).first()
    assert (check["rows"], check["ok"]) == (30, False)


def test_fingerprint_of_an_empty_layer(spark, tmp_path):
    path = str(tmp_path / "layer")
    back = layers.write_layer(spark.range(0), path)
    stored = layers.stored_fingerprint(spark, path)
    assert stored == {"rows": "0", "sum_a": "0", "sum_b": "0"}
    assert layers.layer_counts({"l": back}, {"l": stored}).first()["ok"]
    nothing = spark.range(5).where("false")
    assert layers.write_layer(nothing, path).count() == 0

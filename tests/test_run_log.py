"""Appends that are retried, die or meet."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens.sources import layers


def row(spark, run, n=1):
    return spark.createDataFrame([(run, i) for i in range(n)], "run_id string, i int")


def logged(df):
    return sorted(map(tuple, df.select("run_id", "i").collect()), key=str)


def test_a_retry_leaves_one_row_a_run(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(3):
        layers.append_rows(row(spark, "r1"), path, run_id="r1")
    log = layers.append_rows(row(spark, "r2", 2), path, run_id="r2")
    assert logged(log) == [("r1", 0), ("r2", 0), ("r2", 1)]
    assert len(layers.forget_uncounted(spark, path)) == 2
    assert logged(layers.read_log(spark, path)) == [("r1", 0), ("r2", 0), ("r2", 1)]
    assert len(list(Path(path).glob("attempt__=*"))) == 2


def test_the_first_attempt_that_ended_stays(spark, tmp_path):
    path = str(tmp_path / "log")
    layers.append_rows(row(spark, "r1", 2), path, run_id="r1")
    assert logged(layers.append_rows(row(spark, "r1", 5), path, run_id="r1")) == [("r1", 0), ("r1", 1)]


def test_two_appenders_at_once_lose_none(spark, tmp_path):
    path = str(tmp_path / "log")

    def append(i):
        layers.append_rows(row(spark, f"r{i}", 2), path, run_id=f"r{i // 2}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(append, range(8)))
    found = layers.read_log(spark, path)
    assert found.count() == 8
    assert sorted({int(r["run_id"][1:]) // 2 for r in found.collect()}) == [0, 1, 2, 3]


def test_appends_without_a_run_all_count(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        layers.append_rows(row(spark, None), path)
    assert logged(layers.read_log(spark, path)) == [(None, 0), (None, 0)]


def test_an_append_that_died_is_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    layers.append_rows(row(spark, "r1"), path, run_id="r1")
    # written, but its marker never came
    row(spark, "r2").write.parquet(f"{path}/attempt__=a-dead")
    broken = row(spark, "r3").withColumn("i", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        layers.append_rows(broken, path, run_id="r3")
    assert logged(layers.read_log(spark, path)) == [("r1", 0)]
    assert layers.forget_uncounted(spark, path) == []
    assert (Path(path) / "attempt__=a-dead").exists()
    assert logged(layers.append_rows(row(spark, "r3"), path, run_id="r3")) == [("r1", 0), ("r3", 0)]


def test_a_log_without_markers_reads_as_it_is(spark, tmp_path):
    row(spark, "r1", 3).write.parquet(str(tmp_path / "log"))
    assert layers.read_log(spark, str(tmp_path / "log")).count() == 3

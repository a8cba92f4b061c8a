"""Merged days against the whole, and what a day reads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.operators import customer_state, customers
from orderlens.sources import layers, star

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark):
    columns = star.order_lines(spark, SF).select(fields.FEATURE_INPUTS)
    nameless = F.col("Order_ID") % 13 == 0
    kept = columns.where("Order_ID < 400").withColumn(
        customers.KEY, F.when(nameless, None).otherwise(F.col(customers.KEY))
    )
    return spark.createDataFrame(kept.collect(), kept.schema)


def rounded(df):
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return sorted(map(str, df.withColumns({n: F.round(n, 6) for n in names}).collect()))


def test_days_in_any_order_with_retries_equal_the_whole(spark, lines, tmp_path):
    path = str(tmp_path / "state")
    day = F.col("Order_ID") % 4
    for n in (2, 0, 2, 3):
        customer_state.merge_day(lines.where(day == n), path, str(n), buckets=8)
    assert customer_state.merged_days(spark, path) == ["0", "2", "3"]
    assert not customer_state.merge_day(lines, path, "2")
    want = customers.customer_profile(lines.where(day != 1))
    assert rounded(customer_state.profile(spark, path)) == rounded(want)
    customer_state.compact(spark, path, buckets=5)
    assert rounded(customer_state.profile(spark, path)) == rounded(want)
    assert not customer_state.merge_day(lines, path, "0")
    assert customer_state.merge_day(lines.where(day == 1), path, "1")
    assert rounded(customer_state.profile(spark, path)) == rounded(customers.customer_profile(lines))
    assert customer_state.merged_days(spark, path) == ["0", "1", "2", "3"]


def test_touched_customers_only(spark, lines, tmp_path):
    path = str(tmp_path / "state")
    half = F.col("Order_ID") % 2 == 0
    customer_state.merge_day(lines.where(half), path, "a", buckets=8)
    today = lines.where(~half).where("Customer_ID < 30 OR Customer_ID IS NULL").limit(12)
    customer_state.merge_day(today, path, "b")
    found = customer_state.profile(spark, path, touched=today)
    keys = {r[0] for r in today.select(customers.KEY).distinct().collect()}
    want = customers.customer_profile(lines.where(half).union(today))
    want = want.join(today.select(F.col(customers.KEY).alias("k")).distinct(),
                     F.col(customers.KEY).eqNullSafe(F.col("k")), "left_semi")
    assert rounded(found) == rounded(want) and found.count() == len(keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket__" in plan or "bucket__" in plan.split("PartitionFilters", 1)[1][:200]


def test_a_day_that_died_between_its_parts(spark, lines, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    append = layers.commit_rows

    def dies(df, target, **options):
        if target.endswith("variety"):
            raise OSError("lost")
        return append(df, target, **options)

    monkeypatch.setattr(layers, "commit_rows", dies)
    with pytest.raises(OSError):
        customer_state.merge_day(lines, path, "a", buckets=8)
    monkeypatch.setattr(layers, "commit_rows", append)
    assert customer_state.merged_days(spark, path) == []
    assert customer_state.merge_day(lines, path, "a", buckets=8)
    assert rounded(customer_state.profile(spark, path)) == rounded(customers.customer_profile(lines))


def test_variety_counts_values_once_without_expanding_them(spark):
    rows = [("a", "product", "1"), ("a", "product", "1"), ("a", "product", "2"), ("a", "brand", "1"),
            ("b", "brand", None), (None, "product", "1"), (None, "product", "1")]
    values = spark.createDataFrame(rows, f"{customers.KEY} string, kind string, value string")
    variety = customer_state._variety(values)
    assert sorted(map(str, map(tuple, variety.collect()))) == ["('a', 2, 1)", "('b', 0, 0)", "(None, 1, 0)"]
    assert "Expand" not in variety._jdf.queryExecution().optimizedPlan().toString()


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    key = F.col("id").cast("string").alias(customers.KEY)
    state = spark.range(20_000).select(key, F.md5(key).alias("value"))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "100KB")
    try:
        customer_state._append({"variety": state}, str(tmp_path / "state"), "one", 1)
    finally:
        spark.conf.unset(setting)
    assert len(list((tmp_path / "state").rglob("*.parquet"))) > 1
    read = layers.read_log(spark, str(tmp_path / "state" / "variety"))
    assert read.count() == read.select(customers.KEY).distinct().count() == 20_000

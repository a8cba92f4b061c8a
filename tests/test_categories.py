from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlens.operators import categories, splits, transactions
from orderlens.sources import scratch


@pytest.fixture(scope="module")
def rows(spark):
    values = ["rare"] * 29 + ["edge"] * 30 + ["more"] * 31 + ["Other"] * 2 + [None] * 5
    return spark.createDataFrame(list(enumerate(values)), "id int, brand string")


@pytest.mark.parametrize("limit", [categories.BROADCAST_BYTES, 0])
def test_rare_values_are_recoded(rows, limit):
    capped = categories.cap_rare_categories(rows, ["brand"], 30, broadcast_bytes=limit)
    counts = {r["brand"]: r["n"] for r in capped.groupBy("brand").agg(F.count("*").alias("n")).collect()}
    assert counts == {"edge": 30, "more": 31, "Other": 31, None: 5}
    assert capped.columns == rows.columns


def test_capping_with_a_hot_value_agrees_on_both_ways(spark):
    hot = ["hot"] * 500 + [f"v{i % 120}" for i in range(700)] + [None] * 300
    df = spark.createDataFrame(
        [(i, v, f"w{i % 7}") for i, v in enumerate(hot)], "id int, brand string, product_subcategory string"
    )
    ways = [
        sorted(map(tuple, categories.cap_rare_categories(df, min_count=6, broadcast_bytes=b).collect()))
        for b in (categories.BROADCAST_BYTES, 0)
    ]
    assert ways[0] == ways[1]


def test_capping_without_rows_or_columns(spark, rows):
    empty = categories.cap_rare_categories(rows.limit(0), ["brand"], 30)
    assert empty.count() == 0
    assert categories.cap_rare_categories(rows.select("id"), ["brand"]).columns == ["id"]


def test_vocabularies(rows):
    assert categories.vocabularies(rows, ["brand"]) == {"brand": ["Other", "edge", "more", "rare"]}


def test_one_hot_names_must_differ(spark):
    df = spark.createDataFrame([("b_c", "c")], "a string, a_b string")
    with pytest.raises(ValueError, match="a_b_c"):
        categories.one_hot_columns(df, ["a", "a_b"])


def test_shuffled_capping_reads_once_and_splits_hot_values(spark):
    rows = [(i, "hot" if i % 3 else f"v{i % 40}", None if i % 2 else "x") for i in range(3000)]
    path = scratch.scratch_path(spark, "capping")
    spark.createDataFrame(rows, "id int, brand string, product_subcategory string").write.parquet(path)
    df = spark.read.parquet(path)
    capped = categories.cap_rare_categories(df, min_count=20, broadcast_bytes=0)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<id:int") == 1 and plan.count("SortMergeJoin") == 2
    want = categories.cap_rare_categories(df, min_count=20)
    assert sorted(map(str, capped.collect())) == sorted(map(str, want.collect()))
    salted = df.where("brand = 'hot'").select(F.pmod(F.xxhash64(*df.columns), F.lit(6)))
    assert salted.distinct().count() == 6


def test_one_hot_null_is_all_zero(rows):
    encoded = categories.one_hot_columns(rows, ["brand"])
    assert encoded.columns == ["id", "brand_Other", "brand_edge", "brand_more", "brand_rare"]
    totals = encoded.agg(*[F.sum(c).alias(c) for c in encoded.columns[1:]]).first()
    assert tuple(totals) == (2, 30, 31, 29)


def test_alignment(spark):
    df = spark.createDataFrame([(1, None, 9)], "a int, b double, extra int")
    aligned = categories.align_columns(df, ["b", "a", "c"])
    assert aligned.columns == ["b", "a", "c"] and tuple(aligned.first()) == (0.0, 1.0, 0.0)


def test_split_is_exhaustive_and_independent_of_partitioning(spark):
    df = spark.range(2000).withColumn("order_id", (F.col("id") / 3).cast("int"))
    one = {r["id"]: r["split"] for r in splits.tag_split(df.repartition(1), ["order_id"]).collect()}
    many = {r["id"]: r["split"] for r in splits.tag_split(df.repartition(7), ["order_id"]).collect()}
    assert one == many and set(one.values()) == {"train", "test"}
    train, test = splits.train_test_split(df, ["order_id"])
    assert train.count() + test.count() == 2000
    assert train.join(test, on="order_id").count() == 0
    assert 0.75 < train.count() / 2000 < 0.85


def test_melt_and_pivot_are_inverse(spark):
    wide = spark.createDataFrame([("m1", 0.5, 0.25), ("m2", 0.75, 1.0)], "model_name string, recall double, f1 double")
    back = splits.melt_metrics(wide).groupBy("model_name").pivot("metric", ["recall", "f1"]).agg(F.max("score"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_feature_layer_drops_incomplete_rows_and_keeps_the_key(spark):
    df = spark.createDataFrame(
        [("o1", "c1", 1, "x", 5, "done"), ("o2", "c1", 0, None, 6, "done"), (None, "c2", 0, "x", 7, "open")],
        "Order_ID string, Customer_ID string, Returned int, Brand string, Quantity int, Order_Status string",
    )
    layer = transactions.feature_layer(df, min_count=2, keep=["order_id"])
    assert layer.columns == ["order_id", "returned", "brand", "quantity"]
    assert sorted(map(tuple, layer.collect()), key=str) == sorted(
        [("o1", 1, "x", 5.0), (None, 0, "x", 7.0)], key=str
    )
    with pytest.raises(ValueError, match="returned"):
        transactions.feature_layer(df.drop("Returned"))

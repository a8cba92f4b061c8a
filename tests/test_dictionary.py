"""Dictionaries against Spark's own indexer and encoder."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import categories, dictionary, forest, ranking

SCHEMA = "id int, a string, b string, x double"


@pytest.fixture(scope="module")
def rows(spark):
    a = ["hot"] * 300 + [f"v{i % 40}" for i in range(200)] + [None] * 50 + ["e"] * 3
    return spark.createDataFrame(
        [(i, v, f"w{i % 7}" if i % 5 else None, float(i % 9)) for i, v in enumerate(a)], SCHEMA
    )


@pytest.mark.parametrize("limit", [categories.BROADCAST_BYTES, 0])
def test_indices_and_vectors_equal_the_indexer(rows, limit):
    """On both ways of the join, for seen, null and unseen values."""
    stages = forest.preparation_stages(["a", "b"], ["x"])
    fresh = rows.unionByName(rows.limit(1).withColumns({"id": F.lit(-1), "a": F.lit("new")}))
    want = Pipeline(stages=stages).fit(rows).transform(fresh)
    known = dictionary.build(rows, ["a", "b"])
    got = dictionary.assemble(fresh, known, ["x"], broadcast_bytes=limit)
    assert got.columns == [*rows.columns, "features"]

    def by_id(df):
        return {r["id"]: r["features"] for r in df.select("id", "features").collect()}

    assert by_id(got) == by_id(want)
    indexed = {
        (r["id"], r["a_idx"], r["b_idx"])
        for r in dictionary.encode(fresh, known, limit).select("id", "a_idx", "b_idx").collect()
    }
    assert indexed == {
        (r["id"], r["a_idx"], r["b_idx"]) for r in want.select("id", "a_idx", "b_idx").collect()
    }


def test_names_follow_the_slots(rows):
    model = Pipeline(stages=forest.preparation_stages(["a", "b"], ["x"])).fit(rows)
    attributes = model.transform(rows.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    want = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
    names = dictionary.feature_names(dictionary.build(rows, ["a", "b"]), ["x"]).collect()
    assert {r["slot"]: r["feature"] for r in names} == want


def test_salted_join_reads_each_row_once_and_deals_hot_values(spark, rows):
    known = dictionary.build(rows, ["a"])
    encoded = dictionary.encode(rows, known, broadcast_bytes=0)
    assert "SortMergeJoin" in encoded._jdf.queryExecution().executedPlan().toString()
    assert encoded.count() == rows.count()


def test_more_values_than_may_reach_the_driver(spark, monkeypatch):
    """100,000 values, while a collect may return at most 1,000 rows."""
    collect = DataFrame.collect

    def bounded(df):
        found = collect(df)
        assert len(found) <= 1000
        return found

    for name in ("toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, None)
    monkeypatch.setattr(DataFrame, "collect", bounded)
    many = spark.range(150_000).select(F.concat(F.lit("v"), F.col("id") % 100_000).alias("a"))
    known = dictionary.build(many, ["a"])
    assert known.sizes == {"a": 100_000} and known.rows == {"a": 150_000}
    encoded = dictionary.one_hot(dictionary.encode(many, known, broadcast_bytes=0), known)
    totals = encoded.agg(
        F.count_distinct("a_idx").alias("n"), F.max("a_idx").alias("top"), F.min("a_idx").alias("low")
    ).first()
    assert tuple(totals) == (100_000, 99_999.0, 0.0)
    with pytest.raises(ValueError, match="100000 values"):
        categories.one_hot_columns(many, ["a"])


def test_columns_without_values_and_empty_tables(spark, rows):
    blank = rows.withColumn("a", F.lit(None).cast("string"))
    known = dictionary.build(blank, ["a", "b"])
    assert known.sizes == {"a": 0, "b": 7}
    assert dictionary.encode(blank, known).agg(F.max("a_idx")).first()[0] == 0.0
    # an empty text is a value, which Spark's own encoder refuses
    texts = rows.withColumn("a", F.when(F.col("id") < 100, "").otherwise(F.col("a")))
    assert dictionary.build(texts, ["a"]).values.where("value = ''").first()["n"] == 100
    empty = dictionary.build(rows.limit(0), ["a"])
    assert dictionary.encode(rows, empty).agg(F.max("a_idx")).first()[0] == 0.0


def test_a_stored_dictionary_loads(rows):
    known = dictionary.build(rows, ["a", "b"])
    again = dictionary.load(known.values, ["b"])
    assert again.sizes == {"b": 7} and again.columns == ["b"]


def test_forest_on_a_dictionary_is_the_same_forest(rows):
    labelled = rows.withColumn("returned", (F.col("x") > 4).cast("int"))
    stages = forest.preparation_stages(["a", "b"], ["x"])
    plain = Pipeline(stages=stages).fit(labelled).transform(labelled)
    known = dictionary.build(labelled, ["a", "b"])
    ours = dictionary.assemble(labelled, known, ["x"])
    models = [forest.classifier(3, 3).fit(df.orderBy("id").coalesce(1)) for df in (plain, ours)]
    assert models[0].toDebugString.split("\n", 1)[1] == models[1].toDebugString.split("\n", 1)[1]


def test_rows_are_numbered_across_parts(spark):
    df = spark.createDataFrame(
        [(None if i % 5 == 0 else "hot" if i % 3 else f"g{i % 4}", i) for i in range(500)],
        "g string, v int",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = ranking.number_rows(df, ["g"], [F.desc("v")], "numbered").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for row in numbered:
        groups.setdefault(row["g"], []).append((row["position"], row["v"]))
    assert sum(map(len, groups.values())) == 500
    for found in groups.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        values = [v for _, v in found]
        assert values == sorted(values, reverse=True)

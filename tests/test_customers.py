from __future__ import annotations

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens import fields
from orderlens.functions import customer as expr
from orderlens.operators import customers, ranking
from orderlens.sources import scratch

DAY = datetime.date

LINES = "Order_ID string, Customer_ID string, Order_Date date, Order_Amount double, " \
    "Product_ID string, Product_Category string, Product_Subcategory string, Brand string, " \
    "Quantity int, Returned int, Review_Rating double, Profit_Margin_Percent double, " \
    "Customer_Segment string, Customer_Lifetime_Value double, Membership_Status string, " \
    "Customer_Age int"


def line(order, customer, day=None, amount=None, product="p", category="c", brand="b", quantity=1,
         returned=0, rating=None, margin=None, segment=None, value=None, status=None, age=None):
    return (order, customer, day, amount, product, category, "s", brand, quantity, returned,
            rating, margin, segment, value, status, age)


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [
            line("1", "a", DAY(2024, 1, 5), 10.0, "p1", "toys", "x", 2, 1, 4.0, 5.0, "new", 1.0,
                 "gold", 30),
            line("2", "a", DAY(2024, 1, 1), 20.0, "p2", "home", "x", 1, 0, None, None, None, None,
                 "silver", None),
            line("3", "a", DAY(2024, 1, 9), None, "p2", "home", "y", None, 0, 2.0, 7.0, "old",
                 2.0, None, 31),
            line("4", "b", None, 5.0, "p1", "toys", "x", 3, 1),
            line(None, "c", DAY(2024, 1, 9), 7.0, "p1", None, None, 1, None),
            line("6", None, DAY(2024, 1, 2), 9.0, "p9", "toys", "z", 4, 1, 5.0, 1.0, "anon"),
            line("7", None, DAY(2024, 1, 3), 1.0, "p8", "toys", "z", 1, 0, 3.0, 1.0, "anon"),
        ],
        LINES,
    )


def by_customer(df):
    return {r["Customer_ID"]: r.asDict() for r in df.collect()}


def test_base_measures(lines):
    rows = by_customer(customers.customer_profile(lines))
    a = rows["a"]
    assert a["total_orders"] == 3 and a["total_spend"] == 30.0 and a["avg_order_value"] == 15.0
    assert (a["first_order_date"], a["last_order_date"]) == (DAY(2024, 1, 1), DAY(2024, 1, 9))
    assert (a["distinct_categories"], a["distinct_products"]) == (2, 2)
    assert a["avg_review_rating"] == 3.0 and a["total_quantity_purchased"] == 3
    assert a["ml_avg_quantity_per_line"] == 1.5 and a["ml_distinct_brands_bought"] == 2
    assert (a["favorite_product_category"], a["favorite_category_order_count"]) == ("home", 2)
    # earliest non-null value of each attribute
    assert (a["customer_segment"], a["membership_status"]) == ("new", "silver")
    assert (a["customer_lifetime_value"], a["customer_age"]) == (1.0, 30)


def test_missing_values(lines):
    rows = by_customer(customers.customer_profile(lines))
    b, c = rows["b"], rows["c"]
    assert b["last_order_date"] is None and b["avg_review_rating"] is None
    assert b["customer_segment"] is None
    # a line without an order id counts in no order count, a null category in no distinct count
    assert c["total_orders"] == 0 and c["distinct_categories"] == 0
    assert c["total_returns"] is None and c["ml_returned_line_count"] == 0
    assert c["ml_distinct_brands_bought"] == 0


def test_lines_without_customer_have_base_but_no_purchase_columns(lines):
    row = by_customer(customers.customer_profile(lines))[None]
    assert row["total_orders"] == 2 and row["distinct_products"] == 2
    assert all(row[c] is None for c in customers.PURCHASE_COLUMNS + customers.FAVORITE_COLUMNS)


def test_distinct_purchases_deal_lines_in_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(customers, "TASK_LINES", 1_000)
    # two of three lines are one customer's, half of those the same purchase, all in one partition
    lines = spark.range(0, 9_000, 1, 1).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'big' WHEN id % 2 = 0 THEN NULL ELSE concat('c', id % 5) END "
        "AS Customer_ID",
        "CASE WHEN id % 3 = 1 THEN 0 WHEN id % 7 > 0 THEN id END AS Product_ID",
        "CASE WHEN id % 3 = 1 THEN 'x' WHEN id % 11 > 0 THEN concat('b', id % 13) END AS Brand",
        "id AS Order_ID",
    )
    found = customers.distinct_purchases(lines)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ", 9), REPARTITION_BY_NUM" in plan
    dealt = lines.repartition(9, "Customer_ID", "Product_ID", "Brand", "Order_ID")
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1_500
    want = {}
    for r in lines.collect():
        products, brands = want.setdefault(r["Customer_ID"], (set(), set()))
        products.add(r["Product_ID"])
        brands.add(r["Brand"])
    assert by_customer(found) == {
        key: {
            "Customer_ID": key,
            "distinct_products": len(products - {None}),
            "distinct_brands": len(brands - {None}),
        }
        for key, (products, brands) in want.items()
    }
    # lines without an order id are counted as well
    assert by_customer(customers.distinct_purchases(lines.drop("Order_ID"))) == by_customer(found)


def test_fused_table_equals_joined_tables(lines):
    fused = by_customer(customers.customer_ml_features(lines))
    joined = by_customer(
        customers.join_customer_tables(
            customers.customer_features(lines),
            customers.customer_product_agg(lines),
            customers.top_category(lines),
        )
    )
    assert fused == joined


def test_attributes_agree_with_profile(lines):
    names = list(customers.ATTRIBUTES.values())
    alone = by_customer(customers.customer_attributes(lines))
    full = by_customer(customers.customer_profile(lines))
    for key, row in alone.items():
        assert [row[n] for n in names] == [full[key][n] for n in names]


def test_customer_without_date_has_worst_recency_by_default(spark, lines):
    last = by_customer(customers.customer_features(lines))["b"]
    first = by_customer(customers.customer_features(lines, recency_nulls="first"))["b"]
    assert last["recency_days"] is None
    assert last["r_score"] < first["r_score"] == fields.RFM_TILES


def test_age_bands(spark):
    ages = [17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, a int").orderBy("i")
    assert [r[0] for r in df.select(expr.age_bucket(F.col("a"))).collect()] == [
        "Under 18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54",
        "55-64", "55-64", "65+", "Unknown",
    ]


def test_segments(spark):
    scores = [3, 4, 6, 7, 9, 10, 12, 13, 15]
    df = spark.createDataFrame([(s,) for s in scores], "s int").orderBy("s")
    assert [r[0] for r in df.select(expr.rfm_segment(F.col("s"))).collect()] == [
        "Lost / Churned", "At Risk", "At Risk", "Potential Loyalists", "Potential Loyalists",
        "Loyal Customers", "Loyal Customers", "Champions", "Champions",
    ]


def ntile_pair(spark, values, tiles, nulls):
    """Distributed ntile beside the window function, by key."""
    rows = scratch.durable(
        spark.createDataFrame(list(enumerate(values)), "id int, x double").repartition(3), "ntile"
    )
    measures = {"tile": ("x", nulls)}
    spread = ranking.ntile_columns(rows, "id", measures, tiles)
    order = F.col("x").asc_nulls_last() if nulls == "last" else F.col("x").asc_nulls_first()
    window = rows.withColumn("tile", F.ntile(tiles).over(Window.orderBy(order, "id")))
    return [{r["id"]: r["tile"] for r in df.collect()} for df in (spread, window)]


@pytest.mark.parametrize("nulls", ["first", "last"])
@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 11, 23])
def test_distributed_ntile_sizes(spark, n, nulls):
    values = [None if i % 4 == 0 else float(i % 3) for i in range(n)]
    spread, window = ntile_pair(spark, values, 5, nulls)
    assert spread == window


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5])), max_size=40),
    st.integers(1, 7),
)
def test_distributed_ntile_equals_window(spark, values, tiles):
    spread, window = ntile_pair(spark, values, tiles, "last")
    assert spread == window


def test_ntile_when_a_third_of_the_rows_tie(spark):
    values = [1.0] * 400 + [float(i) for i in range(800)]
    spread, window = ntile_pair(spark, values, 5, "first")
    assert spread == window


def test_border_ranks():
    assert ranking.border_ranks(11, 5) == [3, 5, 7, 9]
    assert ranking.border_ranks(3, 5) == [1, 2, 3, 3]
    assert ranking.border_ranks(0, 5) == []


def test_first_per_group(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 3)], "k int, v int")
    rows = ranking.first_per_group(df, ["k"], [F.desc("v")]).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 7), (2, 3)]


def test_hot_customer_is_not_gathered_before_reduction(lines):
    """Raw lines are never shuffled by customer alone."""
    plan = customers.customer_profile(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_" not in plan

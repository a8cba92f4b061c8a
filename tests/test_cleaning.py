from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from orderlens.functions import cleaning as expr
from orderlens.operators import cleaning, quality, schema
from orderlens.plans.silver import job_silver, to_silver
from orderlens.sources import layers


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("x")).collect()]


def test_whitespace_keeps_a_leading_tab_as_space(spark):
    values = ["  a  b ", "\ta", "a\n\n b", "", None]
    assert column(spark, values, expr.clean_whitespace) == ["a b", " a", "a b", "", None]


def test_bad_numbers_become_null(spark):
    values = ["12", "3.7", "-3.7", ".5", " 8 ", "\t9", "abc", "", "1e3", "12d", "3000000000", None]
    assert column(spark, values, expr.to_int) == [
        12, 3, -3, 0, 8, 9, None, None, None, None, None, None
    ]
    assert column(spark, ["1.5", " 2 ", "x", "", None], expr.to_double) == [
        1.5, 2.0, None, None, None
    ]


def test_flags_count_null_as_no(spark):
    values = ["YES", "y", "True", "1", "no", "yess", "", None]
    assert column(spark, values, expr.yes_no_flag) == [1, 1, 1, 1, 0, 0, 0, 0]


def test_unknown_level_is_null(spark):
    values = ["gold", "bronze", None]
    assert column(spark, values, lambda c: expr.ordinal(c, {"silver": 1, "gold": 2})) == [
        2, None, None
    ]


def test_impossible_dates_become_null(spark):
    df = spark.createDataFrame(
        [("2", "29", "2024"), ("2", "30", "2024"), ("13", "1", "2024"), (None, "1", "2024"),
         (" 1", "2 ", "2024")],
        "Month string, Day string, Year string",
    )
    rebuilt = cleaning.rebuild_order_date(df)
    assert rebuilt.columns == ["Order_Date"]
    assert [r[0] for r in rebuilt.collect()] == [
        datetime.date(2024, 2, 29), None, None, None, datetime.date(2024, 1, 2)
    ]
    assert quality.bad_date_count(rebuilt).first()["null_dates"] == 3


def test_date_parts_stay_when_one_is_missing(spark):
    df = spark.createDataFrame([("2", "29")], "Month string, Day string")
    assert cleaning.rebuild_order_date(df).columns == ["Month", "Day"]


def test_header_normalisation(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], [" Order ID ", "Unit.Price", "Ship/Cost", "A-B"])
    assert schema.normalize_columns(df).columns == ["Order_ID", "UnitPrice", "Ship_Cost", "A_B"]


def test_colliding_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["A B", "A-B"])
    with pytest.raises(ValueError, match="A_B"):
        schema.normalize_columns(df)
    with pytest.raises(ValueError, match="share a name: a"):
        schema.lowercase_columns(spark.createDataFrame([(1, 2)], ["A", "b"]).toDF("A", "b").select(
            "A", F.col("b").alias("a2")).toDF("A", "a"))


def test_missing_columns_are_named_in_order(spark):
    df = spark.createDataFrame([(1,)], ["b"])
    with pytest.raises(ValueError, match="a, c"):
        schema.require_columns(df, ["c", "b", "a"])


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError, match="orders has no rows"):
        schema.require_nonempty(spark.range(0), "orders")


def test_wide_and_narrow_text_cleaning_agree(spark):
    wide = spark.createDataFrame([tuple(f" {i}\t x  y " for i in range(9))], [f"c{i}" for i in range(9)])
    together = cleaning.clean_text(wide).first()
    for name in wide.columns:
        assert cleaning.clean_text(wide.select(name)).first()[0] == together[name]


def test_silver_from_csv(spark, tmp_path):
    source = tmp_path / "orders.csv"
    source.write_text(
        "Order ID,Month,Day,Year,Quantity,Returned,Membership Status,Product Category,Notes\n"
        '1,1,31,2024,3.7,Yes,GOLD,"Home, Garden","say ""hi"""\n'
        "2,2,30,2024,abc,,bronze,  Toys   and  Games ,\n"
    )
    raw = layers.read_orders_csv(spark, str(source))
    assert {t for _, t in raw.dtypes} == {"string"}
    written = job_silver(raw, str(tmp_path / "silver"))
    rows = written["silver"].orderBy("Order_ID").collect()
    assert rows[0].asDict() == {
        "Order_ID": "1", "Quantity": 3, "Returned": 1, "Membership_Status": "gold",
        "Product_Category": "home, garden", "Notes": 'say "hi"',
        "Order_Date": datetime.date(2024, 1, 31), "Membership_Status_ord": 2,
    }
    assert rows[1]["Order_Date"] is None and rows[1]["Quantity"] is None
    assert rows[1]["Returned"] == 0 and rows[1]["Membership_Status_ord"] is None
    assert rows[1]["Product_Category"] == "toys and games"
    nulls = {r["column_name"]: r["null_count"] for r in written["null_profile"].collect()}
    assert nulls["Order_Date"] == 1 and nulls["Returned"] == 0


def test_reader_checks_given_header(spark, tmp_path):
    source = tmp_path / "orders.csv"
    source.write_text("a,b\n1,2\n")
    assert layers.read_orders_csv(spark, str(source), ["a", "b"]).first() == ("1", "2")
    with pytest.raises(Exception, match="(?i)header"):
        layers.read_orders_csv(spark, str(source), ["b", "a"]).collect()


def test_silver_of_unrelated_columns_changes_only_text(spark):
    df = spark.createDataFrame([(" x ", 5)], ["other", "n"])
    assert to_silver(df).first() == ("x", 5)


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_plain_dates_are_those_of_the_pattern(spark, zone):
    months = [None, "", "0", "1", "01", "001", "12", "13", " 2 ", "2\t", "1-2", "1/2", "x", "\u0663"]
    days = [None, "", "0", "7", "007", "29", "31", "32", "5\n"]
    years = [None, "", "0000", "1582", "2023", "2024", "24", "02024", "+2024", " 2024 ", "2024-1"]
    rows = spark.createDataFrame(
        [(m, d, y) for m in months for d in days for y in years], "m string, d string, y string"
    )
    parts = [F.regexp_replace(F.trim(F.col(c)), r"\s+", " ") for c in "mdy"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        both = rows.select(
            "*",
            F.try_to_date(F.concat_ws("/", *parts), "M/d/yyyy").alias("wanted"),
            expr.date_from_parts(F.col("m"), F.col("d"), F.col("y")).alias("got"),
        )
        assert both.where("NOT (wanted <=> got)").collect() == []
        assert both.where("got IS NOT NULL").count() > 20
        # the usual digits do not meet the formatter
        assert "rlike" in plan_of(both.select("got")).lower()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_only_uneven_text_is_rewritten(spark):
    texts = [None, "", " ", "  ", "a", "a b", "a  b", " a", "a ", "\ta", "a\t", "a\nb", "\x0b", "a\x0cb",
             "a\r\nb", "a\xa0b", " a\t b ", "a\x1cb", "\x85"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    wanted = F.regexp_replace(F.trim("t"), r"\s+", " ")
    got = expr.clean_whitespace(F.col("t"))
    assert rows.where(~wanted.eqNullSafe(got)).collect() == []
    assert "rlike" in plan_of(rows.select(got)).lower()

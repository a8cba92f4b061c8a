"""Names, text, dates, casts and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.functions.customer import order_values as order_value_columns
from orderlens.functions.scoring import utc_stamp as stamp
from orderlens.operators import cleaning, quality, schema
from orderlens.operators.transactions import add_date_parts
from orderlens.plans.silver import job_silver, to_silver
from orderlens.queries.registry import (
    DATE_SQL, RAW_NAMES, SILVER_NAMES, over_lines, over_raw, over_silver, query, text_sql,
)
from orderlens.sources import layers, scratch, star


def _normalized(spark, sf):
    return schema.normalize_columns(star.raw_lines(spark, sf))


def _cleaned(spark, sf):
    return cleaning.clean_text(_normalized(spark, sf))


@query(
    "normalize_columns",
    over_raw(
        "SELECT " + ", ".join(f'"{h}" AS {n}' for h, n in RAW_NAMES.items()) + " FROM raw_v"
    ),
)
def normalize_columns(spark, sf):
    return _normalized(spark, sf)


LINE_NAMES = [
    "Order_ID", "Customer_ID", "Product_ID", "Quarter", "Product_Category", "Brand",
    "Quantity", "Discount_Percent", "Returned",
]


@query(
    "lowercase_columns",
    over_lines("SELECT " + ", ".join(f"{n} AS {n.lower()}" for n in LINE_NAMES) + " FROM orders_v"),
)
def lowercase_columns(spark, sf):
    return schema.lowercase_columns(star.order_lines(spark, sf).select(LINE_NAMES))


@query(
    "optional_columns",
    over_silver("SELECT Order_ID, Product_Category, Quantity, Order_Amount FROM silver_v"),
)
def optional_columns(spark, sf):
    """The whole cleaning plan on an input that lacks most columns."""
    some = _normalized(spark, sf).select(
        "Order_ID", "Product_Category", "Quantity", "Order_Amount"
    )
    return to_silver(some)


@query(
    "require_columns",
    over_lines("SELECT Order_ID, Customer_ID, Order_Amount FROM orders_v"),
)
def require_columns(spark, sf):
    names = ["Order_ID", "Customer_ID", "Order_Amount"]
    return schema.require_columns(star.order_lines(spark, sf), names).select(names)


@query(
    "project_rename",
    over_lines("SELECT Order_ID AS order_key, Brand AS label, Quantity AS units FROM orders_v"),
)
def project_rename(spark, sf):
    names = {"Order_ID": "order_key", "Brand": "label", "Quantity": "units"}
    return schema.project(star.order_lines(spark, sf), names)


@query(
    "drop_leakage_columns",
    over_lines(
        "SELECT Quarter AS quarter, Product_Category AS product_category, Brand AS brand, "
        "Quantity AS quantity, Discount_Percent AS discount_percent, Returned AS returned "
        "FROM orders_v"
    ),
)
def drop_leakage_columns(spark, sf):
    lines = star.order_lines(spark, sf).select([*LINE_NAMES, "Order_Status"])
    return schema.drop_leakage(schema.lowercase_columns(lines))


@query(
    "constant_column",
    over_lines(
        "SELECT Order_ID, Score, cast(0.4 AS double) AS selected_threshold, 'batch' AS source "
        "FROM orders_v"
    ),
)
def constant_column(spark, sf):
    scores = star.order_lines(spark, sf).select("Order_ID", "Score")
    return schema.constant_columns(scores, {"selected_threshold": 0.4, "source": "batch"})


@query(
    "cast_feature_types",
    over_lines(
        "SELECT cast(Quarter AS double) AS quarter, cast(Quantity AS double) AS quantity, "
        "cast(Customer_Age AS double) AS customer_age, Brand AS brand, Returned AS returned "
        "FROM orders_v"
    ),
)
def cast_feature_types(spark, sf):
    lines = star.order_lines(spark, sf).select(
        "Quarter", "Quantity", "Customer_Age", "Brand", "Returned"
    )
    return schema.cast_feature_types(schema.lowercase_columns(lines))


@query(
    "clean_whitespace",
    "SELECT doc_id, regexp_replace(trim(text), '\\s+', ' ', 'g') AS text FROM documents",
)
def clean_whitespace(spark, sf):
    return cleaning.clean_text(star.read_table(spark, sf, "documents").select("doc_id", "text"))


@query(
    "lowercase_values",
    over_raw(
        f"SELECT {text_sql('Order ID')} AS Order_ID, "
        f"lower({text_sql(' Product Category ')}) AS Product_Category, "
        f"lower({text_sql('Country')}) AS Country, lower({text_sql('Brand')}) AS Brand FROM raw_v"
    ),
)
def lowercase_values(spark, sf):
    return cleaning.lowercase_values(
        _cleaned(spark, sf).select("Order_ID", "Product_Category", "Country", "Brand")
    )


@query(
    "rebuild_date",
    over_raw(f"SELECT {text_sql('Order ID')} AS Order_ID, {DATE_SQL} AS Order_Date FROM raw_v"),
)
def rebuild_date(spark, sf):
    parts = _cleaned(spark, sf).select("Order_ID", "Month", "Day", "Year")
    return cleaning.rebuild_order_date(parts)


@query(
    "cast_numeric",
    over_silver(
        "SELECT Order_ID, Quantity, Customer_Age, Delivery_Days, Order_Amount, Review_Rating "
        "FROM silver_v"
    ),
)
def cast_numeric(spark, sf):
    return cleaning.cast_numerics(
        _cleaned(spark, sf).select(
            "Order_ID", "Quantity", "Customer_Age", "Delivery_Days", "Order_Amount",
            "Review_Rating",
        )
    )


@query(
    "normalize_flag",
    over_silver("SELECT Order_ID, Returned, Coupon_Used, High_Value_Order FROM silver_v"),
)
def normalize_flag(spark, sf):
    return cleaning.normalize_flags(
        _cleaned(spark, sf).select("Order_ID", "Returned", "Coupon_Used", "High_Value_Order")
    )


@query(
    "ordinal_map",
    over_silver("SELECT Order_ID, Membership_Status, Membership_Status_ord FROM silver_v"),
)
def ordinal_map(spark, sf):
    status = cleaning.lowercase_values(_cleaned(spark, sf).select("Order_ID", "Membership_Status"))
    return cleaning.add_membership_ordinal(status)


@query(
    "null_profile",
    over_silver(
        "SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {n} IS NULL) AS {n}" for n in SILVER_NAMES)
        + " FROM silver_v"
    ),
)
def null_profile(spark, sf):
    return quality.null_profile(to_silver(star.raw_lines(spark, sf)))


@query(
    "bad_date_count",
    over_silver("SELECT count(*) FILTER (WHERE Order_Date IS NULL) AS null_dates FROM silver_v"),
)
def bad_date_count(spark, sf):
    return quality.bad_date_count(to_silver(star.raw_lines(spark, sf)))


def silver_layers(spark, sf):
    """The job over raw lines as it meets them, text in CSV files, which go once it has ended."""
    path = scratch.scratch_path(spark, "silver")
    with scratch.scope(spark):
        raw = layers.read_orders_csv(
            spark, star.write_raw_lines(spark, sf), columns=list(RAW_NAMES)
        )
        return job_silver(raw, path)


@query("job_silver", over_silver("SELECT * FROM silver_v"))
def silver_job(spark, sf):
    return silver_layers(spark, sf)["silver"]


@query(
    "silver_profile_long",
    over_silver(
        "SELECT column_name, null_count FROM (UNPIVOT (SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {n} IS NULL) AS {n}" for n in SILVER_NAMES)
        + " FROM silver_v) ON COLUMNS(*) INTO NAME column_name VALUE null_count)"
    ),
)
def silver_profile_long(spark, sf):
    return silver_layers(spark, sf)["null_profile"]


@query(
    "utc_stamp",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS generated_at_utc FROM events",
)
def utc_stamp(spark, sf):
    events = star.read_table(spark, sf, "events")
    return events.select("event_id", stamp(F.col("ts")).alias("generated_at_utc"))


@query(
    "date_parts",
    over_lines(
        "SELECT Order_ID, cast(year(Order_Date) AS int) AS order_year, "
        "cast(month(Order_Date) AS int) AS order_month, cast(day(Order_Date) AS int) AS order_day, "
        "cast(dayofweek(Order_Date) + 1 AS int) AS order_dow FROM orders_v"
    ),
)
def date_parts(spark, sf):
    lines = star.order_lines(spark, sf).select("Order_ID", "Order_Date")
    return add_date_parts(lines, "Order_Date")


@query(
    "order_values",
    """SELECT l_orderkey, l_linenumber,
      cast(round(p * q, 2) AS decimal(18,2)) AS gross_amount,
      cast(round(p * q * d * 0.01, 2) AS decimal(18,2)) AS discount_amount,
      cast(round(p * q * (1 - d * 0.01) * t * 0.01, 2) AS decimal(18,2)) AS tax_amount,
      cast(round(p * q * (1 - d * 0.01) * (1 + t * 0.01) + 5.00, 2)
           AS decimal(18,2)) AS order_amount
    FROM (SELECT l_orderkey, l_linenumber, cast(l_extendedprice AS decimal(12,2)) AS p,
            cast(l_linenumber AS decimal(4,0)) AS q,
            cast(round(l_discount * 100) AS decimal(4,0)) AS d,
            cast(round(l_tax * 100) AS decimal(4,0)) AS t FROM lineitem)""",
)
def order_values(spark, sf):
    line = star.read_table(spark, sf, "lineitem")
    amounts = order_value_columns(
        F.col("l_extendedprice").cast("decimal(12,2)"),
        F.col("l_linenumber").cast("decimal(4,0)"),
        F.round(F.col("l_discount") * 100).cast("decimal(4,0)"),
        F.lit(5).cast("decimal(4,2)"),
        F.round(F.col("l_tax") * 100).cast("decimal(4,0)"),
    )
    return line.select(
        "l_orderkey",
        "l_linenumber",
        *[amount.cast("decimal(18,2)").alias(name) for name, amount in amounts.items()],
    )


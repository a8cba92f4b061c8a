"""Distributions, categories, splits and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import categories, quality, schema, splits, transactions
from orderlens.queries.registry import over_lines, query
from orderlens.sources import scratch, star

MIN_COUNT = 900  # collapses about half of the subcategories at scale factor 0.01

BUCKET_SQL = "cast('0x' || substr(md5(cast(Order_ID AS varchar)), 1, 8) AS bigint) % 100"


def capped(column: str, source: str = "orders_v", min_count: int = MIN_COUNT) -> str:
    """A column with its rare values recoded, as SQL over ``source``."""
    kept = f"count(*) OVER (PARTITION BY {column}) >= {min_count} OR {column} IS NULL"
    return f"CASE WHEN {kept} THEN {column} ELSE 'Other' END"


@query(
    "conditional_count",
    over_lines(
        "SELECT Product_Category, count(*) FILTER (WHERE Returned = 1) AS returned_lines, "
        "count(*) FILTER (WHERE Quantity > 25) AS bulk_lines FROM orders_v GROUP BY 1"
    ),
)
def conditional_count(spark, sf):
    lines = star.order_lines(spark, sf)
    conditions = {"returned_lines": F.col("Returned") == 1, "bulk_lines": F.col("Quantity") > 25}
    return quality.conditional_counts(lines, "Product_Category", conditions)


@query(
    "class_distribution",
    over_lines("SELECT Returned, count(*) AS n FROM orders_v GROUP BY Returned"),
)
def class_distribution(spark, sf):
    return quality.class_distribution(star.order_lines(spark, sf), "Returned")


@query(
    "category_frequency",
    over_lines(
        'SELECT \'Brand\' AS "column", Brand AS value, count(*) AS n FROM orders_v GROUP BY Brand '
        "UNION ALL SELECT 'Product_Subcategory', Product_Subcategory, count(*) FROM orders_v "
        "GROUP BY Product_Subcategory"
    ),
)
def category_frequency(spark, sf):
    lines = star.order_lines(spark, sf)
    return categories.category_frequency(lines, ["Brand", "Product_Subcategory"])


@query(
    "top_categories",
    over_lines(
        "SELECT Product_Subcategory, count(*) AS n FROM orders_v GROUP BY 1 "
        "ORDER BY n DESC, Product_Subcategory LIMIT 20"
    ),
)
def top_categories(spark, sf):
    return quality.top_values(star.order_lines(spark, sf), "Product_Subcategory", 20)


@query(
    "global_max",
    over_lines("SELECT max(Order_Amount) AS max_value, min(Order_Amount) AS min_value FROM orders_v"),
)
def global_max(spark, sf):
    return quality.extremes(star.order_lines(spark, sf), "Order_Amount")


@query(
    "global_min",
    over_lines("SELECT max(Score) AS max_value, min(Score) AS min_value FROM orders_v"),
)
def global_min(spark, sf):
    return quality.extremes(star.order_lines(spark, sf), "Score")


@query(
    "probability_summary",
    over_lines(
        "SELECT min(Score) AS min_probability, quantile_disc(Score, 0.25) AS p25, "
        "quantile_disc(Score, 0.5) AS median, quantile_disc(Score, 0.75) AS p75, "
        "max(Score) AS max_probability FROM orders_v"
    ),
)
def probability_summary(spark, sf):
    return quality.probability_summary(star.order_lines(spark, sf), "Score")


@query(
    "rare_category_cap",
    over_lines(
        f"SELECT Order_ID, {capped('Brand')} AS Brand, "
        f"{capped('Product_Subcategory')} AS Product_Subcategory, Quantity FROM orders_v"
    ),
)
def rare_category_cap(spark, sf):
    lines = star.order_lines(spark, sf).select(
        "Order_ID", "Brand", "Product_Subcategory", "Quantity"
    )
    return categories.cap_rare_categories(lines, ["Brand", "Product_Subcategory"], MIN_COUNT)


@query(
    "rare_category_cap_shuffled",
    over_lines(
        f"SELECT Order_ID, {capped('Product_Subcategory')} AS Product_Subcategory, Quantity "
        "FROM orders_v"
    ),
)
def rare_category_cap_shuffled(spark, sf):
    """The way taken when the kept values are too many to broadcast."""
    lines = star.order_lines(spark, sf).select("Order_ID", "Product_Subcategory", "Quantity")
    return categories.cap_rare_categories(
        lines, ["Product_Subcategory"], MIN_COUNT, broadcast_bytes=0
    )


FEATURE_SQL = {
    "customer_age": "cast(Customer_Age AS double)",
    "quantity": "cast(Quantity AS double)",
    "review_rating": "Review_Rating",
    "quarter": "cast(Quarter AS double)",
    "unit_price": "Unit_Price",
    "discount_percent": "cast(Discount_Percent AS double)",
    "discount_amount": "Discount_Amount",
    "tax_amount": "Tax_Amount",
    "order_amount": "Order_Amount",
    "delivery_days": "cast(Delivery_Days AS double)",
    "customer_lifetime_value": "Customer_Lifetime_Value",
    "profit_margin_percent": "Profit_Margin_Percent",
    "high_value_order": "cast(High_Value_Order AS double)",
    "order_year": "cast(year(Order_Date) AS double)",
    "order_month": "cast(month(Order_Date) AS double)",
    "order_day": "cast(day(Order_Date) AS double)",
    "order_dow": "cast(dayofweek(Order_Date) + 1 AS double)",
    "country": "Country",
    "customer_segment": "Customer_Segment",
    "product_category": "Product_Category",
    "payment_method": "Payment_Method",
    "membership_status": "Membership_Status",
    "product_subcategory": capped("Product_Subcategory"),
    "brand": capped("Brand"),
    "returned": "Returned",
}


@query(
    "rf_feature_layer",
    over_lines(
        ", f AS (SELECT "
        + ", ".join(f"{sql} AS {name}" for name, sql in FEATURE_SQL.items())
        + " FROM orders_v) SELECT * FROM f WHERE "
        + " AND ".join(f"{name} IS NOT NULL" for name in FEATURE_SQL)
    ),
)
def rf_feature_layer(spark, sf):
    return transactions.feature_layer(star.order_lines(spark, sf), MIN_COUNT)


def labelled_documents(spark, sf):
    documents = star.read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(star.read_table(spark, sf, "labels"), on="doc_id", how="left")


@query(
    "dropna_any",
    "SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) "
    "WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL "
    "AND n_chars IS NOT NULL",
)
def dropna_any(spark, sf):
    return labelled_documents(spark, sf).dropna()


@query(
    "null_profile_joined",
    "SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, "
    "count(*) FILTER (WHERE lang IS NULL) AS lang, "
    "count(*) FILTER (WHERE n_chars IS NULL) AS n_chars, "
    "count(*) FILTER (WHERE quality IS NULL) AS quality, "
    "count(*) FILTER (WHERE toxic IS NULL) AS toxic "
    "FROM documents LEFT JOIN labels USING (doc_id)",
)
def null_profile_joined(spark, sf):
    return quality.null_profile(labelled_documents(spark, sf))


@query(
    "require_nonempty",
    over_lines("SELECT Returned, count(*) AS n FROM orders_v GROUP BY Returned"),
)
def require_nonempty(spark, sf):
    lines = schema.require_nonempty(star.order_lines(spark, sf), "order lines")
    return quality.value_counts(lines, "Returned")


_SPLIT_COLUMNS = ["Order_ID", "Product_ID", "Quantity", "Returned"]
_SPLIT_V = (
    ", split_v AS (SELECT Order_ID, Product_ID, Quantity, Returned, "
    f"CASE WHEN {BUCKET_SQL} < 80 THEN 'train' ELSE 'test' END AS split FROM orders_v)"
)


@query("train_test_split", over_lines(f"{_SPLIT_V} SELECT * FROM split_v"))
def train_test_split(spark, sf):
    lines = star.order_lines(spark, sf).select(_SPLIT_COLUMNS)
    return splits.tag_split(lines, ["Order_ID"])


@query("tagged_union", over_lines(f"{_SPLIT_V} SELECT * FROM split_v"))
def tagged_union(spark, sf):
    lines = star.order_lines(spark, sf).select(_SPLIT_COLUMNS)
    return splits.tagged_union(*splits.train_test_split(lines, ["Order_ID"]))


@query(
    "filter_by_tag",
    over_lines(
        f"{_SPLIT_V} SELECT Order_ID, Product_ID, Quantity, Returned FROM split_v "
        "WHERE split = 'test'"
    ),
)
def filter_by_tag(spark, sf):
    lines = star.order_lines(spark, sf).select(_SPLIT_COLUMNS)
    return splits.take_split(splits.tag_split(lines, ["Order_ID"]), splits.TEST)


_STATUSES = ["gold", "platinum", "silver", "standard"]
_ORDER_STATUSES = ["f", "o", "p"]


@query(
    "one_hot_columns",
    over_lines(
        "SELECT Order_ID, "
        + ", ".join(
            f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS {column}_{v}"
            for column, values in (
                ("Membership_Status", _STATUSES), ("Order_Status", _ORDER_STATUSES)
            )
            for v in values
        )
        + " FROM orders_v"
    ),
)
def one_hot_columns(spark, sf):
    lines = star.order_lines(spark, sf).select("Order_ID", "Membership_Status", "Order_Status")
    return categories.one_hot_columns(lines, ["Membership_Status", "Order_Status"])


@query(
    "align_feature_columns",
    over_lines(
        "SELECT Order_ID, cast(Quantity AS double) AS Quantity, "
        "coalesce(Review_Rating, cast(0 AS double)) AS Review_Rating, "
        "CASE WHEN Membership_Status = 'gold' THEN cast(1 AS double) ELSE cast(0 AS double) END "
        "AS Membership_Status_gold, cast(0 AS double) AS Membership_Status_diamond FROM orders_v"
    ),
)
def align_feature_columns(spark, sf):
    """The trained columns lack most categories, and know one that does not occur."""
    lines = star.order_lines(spark, sf).select(
        "Order_ID", "Quantity", "Review_Rating", "Membership_Status"
    )
    trained = [
        "Quantity", "Review_Rating", "Membership_Status_gold", "Membership_Status_diamond"
    ]
    encoded = categories.one_hot_columns(lines, ["Membership_Status"])
    return categories.align_columns(encoded, trained, keep=["Order_ID"])


@query(
    "distinct_values",
    over_lines(
        "SELECT count(DISTINCT Brand) AS brands, "
        "count(DISTINCT Product_Subcategory) AS subcategories FROM orders_v"
    ),
)
def distinct_values(spark, sf):
    frequency = scratch.durable(
        categories.category_frequency(
            star.order_lines(spark, sf), ["Brand", "Product_Subcategory"]
        ),
        "frequency",
    )
    known = F.col("value").isNotNull()
    return frequency.agg(
        F.count_if(known & (F.col("column") == "Brand")).alias("brands"),
        F.count_if(known & (F.col("column") == "Product_Subcategory")).alias("subcategories"),
    )

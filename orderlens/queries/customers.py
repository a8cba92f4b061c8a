"""Customer, product and RFM features."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens import fields
from orderlens.operators import customer_state
from orderlens.operators import customers as ops
from orderlens.operators import ranking
from orderlens.queries.registry import cents, over_lines, query, ratio6
from orderlens.sources import scratch, star

# measures of one customer, written once for all oracles below
_BASE = """
  Customer_ID, count(Order_ID) AS total_orders, round(sum(Order_Amount), 2) AS total_spend,
  round(avg(Order_Amount) + 1e-9, 6) AS avg_order_value,
  max(Order_Date) AS last_order_date, min(Order_Date) AS first_order_date,
  count(DISTINCT Product_Category) AS distinct_categories,
  count(DISTINCT Product_ID) AS distinct_products,
  cast(sum(Returned) AS bigint) AS total_returns,
  round(avg(Review_Rating) + 1e-9, 6) AS avg_review_rating,
  cast(sum(Quantity) AS bigint) AS total_quantity_purchased"""
_FIRST = """
  arg_min(Customer_Segment, (Order_Date, Customer_Segment)) AS customer_segment,
  arg_min(Customer_Lifetime_Value, (Order_Date, Customer_Lifetime_Value))
    AS customer_lifetime_value,
  arg_min(Membership_Status, (Order_Date, Membership_Status)) AS membership_status,
  arg_min(Customer_Age, (Order_Date, Customer_Age)) FILTER (WHERE Customer_Age IS NOT NULL)
    AS customer_age"""
_PURCHASE = """
  count(DISTINCT Product_ID) AS ml_distinct_products_bought,
  count(DISTINCT Brand) AS ml_distinct_brands_bought,
  cast(sum(Quantity) AS bigint) AS ml_total_quantity_bought,
  round(avg(Quantity) + 1e-9, 6) AS ml_avg_quantity_per_line,
  round(avg(Profit_Margin_Percent) + 1e-9, 6) AS ml_avg_profit_margin_purchased,
  round(avg(Review_Rating) + 1e-9, 6) AS ml_avg_product_rating_purchased,
  count(*) FILTER (WHERE Returned = 1) AS ml_returned_line_count"""

_BASE_V = f", base_v AS (SELECT {_BASE}, {_FIRST} FROM orders_v GROUP BY Customer_ID)"
_AGE = """CASE WHEN customer_age < 18 THEN 'Under 18' WHEN customer_age <= 24 THEN '18-24'
  WHEN customer_age <= 34 THEN '25-34' WHEN customer_age <= 44 THEN '35-44'
  WHEN customer_age <= 54 THEN '45-54' WHEN customer_age <= 64 THEN '55-64'
  WHEN customer_age >= 65 THEN '65+' ELSE 'Unknown' END AS age_bucket"""
_DAYS = """
  cast(date_diff('day', first_order_date, last_order_date) AS int) AS customer_tenure_days,
  cast(date_diff('day', last_order_date, (SELECT max(Order_Date) FROM orders_v)) AS int)
    AS recency_days"""
_DAYS_V = f"{_BASE_V}, days_v AS (SELECT *, {_AGE}, {_DAYS} FROM base_v)"
_TILES = """
  cast(6 - ntile(5) OVER (ORDER BY recency_days ASC NULLS LAST, Customer_ID) AS int) AS r_score,
  cast(ntile(5) OVER (ORDER BY total_orders ASC NULLS FIRST, Customer_ID) AS int) AS f_score,
  cast(ntile(5) OVER (ORDER BY total_spend ASC NULLS FIRST, Customer_ID) AS int) AS m_score"""
_SEGMENT = """CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
  WHEN r_score + f_score + m_score >= 10 THEN 'Loyal Customers'
  WHEN r_score + f_score + m_score >= 7 THEN 'Potential Loyalists'
  WHEN r_score + f_score + m_score >= 4 THEN 'At Risk' ELSE 'Lost / Churned' END"""
_FEATURES_V = f"""{_DAYS_V}, tiles_v AS (SELECT *, {_TILES} FROM days_v),
  features_v AS (SELECT *, r_score + f_score + m_score AS rfm_score,
    {_SEGMENT} AS rfm_segment FROM tiles_v)"""
_TOP_V = """, counts_v AS (SELECT Customer_ID, Product_Category, count(Order_ID) AS n
    FROM orders_v GROUP BY ALL),
  top_v AS (SELECT Customer_ID, Product_Category AS favorite_product_category,
    n AS favorite_category_order_count
    FROM counts_v
    QUALIFY row_number() OVER (PARTITION BY Customer_ID ORDER BY n DESC, Product_Category) = 1)"""
_ML_V = f"""{_FEATURES_V}{_TOP_V},
  purchase_v AS (SELECT Customer_ID, {_PURCHASE} FROM orders_v GROUP BY Customer_ID)"""
FEATURES_V = _FEATURES_V

_SIX = ["avg_order_value", "avg_review_rating", "ml_avg_quantity_per_line",
        "ml_avg_profit_margin_purchased", "ml_avg_product_rating_purchased", "avg_profit_margin"]
_CENTS = ["total_spend", "total_revenue"]


def written_lines(spark, sf):
    """The order lines as a written layer, which the customer operators read twice."""
    lines = star.order_lines(spark, sf).select(fields.FEATURE_INPUTS)
    return scratch.durable(lines, "lines")


def comparable(df):
    """Sums of money to cents and averages to six places, as the oracles have them."""
    return df.withColumns(
        {c: ratio6(c) for c in _SIX if c in df.columns}
        | {c: cents(c) for c in _CENTS if c in df.columns}
    )


@query("customer_base", over_lines(f"{_BASE_V} SELECT * FROM base_v"))
def customer_base(spark, sf):
    return comparable(ops.customer_base(written_lines(spark, sf)))


@query(
    "customer_first_attrs",
    over_lines(f"SELECT Customer_ID, {_FIRST} FROM orders_v GROUP BY Customer_ID"),
)
def customer_first_attrs(spark, sf):
    return ops.customer_attributes(star.order_lines(spark, sf))


@query(
    "customer_product_agg",
    over_lines(f"SELECT Customer_ID, {_PURCHASE} FROM orders_v GROUP BY Customer_ID"),
)
def customer_product_agg(spark, sf):
    return comparable(ops.customer_product_agg(written_lines(spark, sf)))


@query(
    "distinct_count",
    over_lines(
        "SELECT Customer_ID, count(DISTINCT Product_ID) AS distinct_products, "
        "count(DISTINCT Brand) AS distinct_brands FROM orders_v GROUP BY Customer_ID"
    ),
)
def distinct_count(spark, sf):
    lines = star.order_lines(spark, sf).select(ops.KEY, "Order_ID", "Product_ID", "Brand")
    return ops.distinct_purchases(scratch.durable(lines, "purchases"))


@query(
    "category_order_count",
    over_lines(
        "SELECT Customer_ID, Product_Category, count(Order_ID) AS category_order_count "
        "FROM orders_v GROUP BY ALL"
    ),
)
def category_order_count(spark, sf):
    return ops.category_order_count(star.order_lines(spark, sf))


@query("top_category", over_lines(f"{_TOP_V} SELECT * FROM top_v"))
def top_category(spark, sf):
    return ops.top_category(star.order_lines(spark, sf))


@query(
    "filter_first_rank",
    over_lines(
        "SELECT Customer_ID, Order_Amount, Order_ID FROM orders_v QUALIFY row_number() OVER "
        "(PARTITION BY Customer_ID ORDER BY Order_Amount DESC, Order_ID) = 1"
    ),
)
def filter_first_rank(spark, sf):
    lines = star.order_lines(spark, sf).select("Customer_ID", "Order_Amount", "Order_ID")
    return ranking.first_per_group(
        lines, ["Customer_ID"], [F.desc("Order_Amount"), F.asc("Order_ID")]
    )


@query("age_bucket", over_lines(f"{_BASE_V} SELECT Customer_ID, customer_age, {_AGE} FROM base_v"))
def age_bucket(spark, sf):
    base = ops.customer_base(written_lines(spark, sf)).select(ops.KEY, "customer_age")
    return ops.add_age_bucket(base)


@query("tenure_recency", over_lines(f"{_BASE_V} SELECT Customer_ID, {_DAYS} FROM base_v"))
def tenure_recency(spark, sf):
    base = scratch.durable(
        ops.customer_base(written_lines(spark, sf)).select(
            ops.KEY, "first_order_date", "last_order_date"
        ),
        "dates",
    )
    return ops.add_tenure_recency(base).select(ops.KEY, "customer_tenure_days", "recency_days")


@query(
    "scalar_max_join",
    over_lines(
        "SELECT Order_ID, Order_Date, cast(date_diff('day', Order_Date, "
        "(SELECT max(Order_Date) FROM orders_v)) AS int) AS days_ago FROM orders_v"
    ),
)
def scalar_max_join(spark, sf):
    lines = star.order_lines(spark, sf).select("Order_ID", "Order_Date")
    return ops.add_days_before_latest(lines, "Order_Date", "days_ago")


@query(
    "rfm_ntile",
    over_lines(f"{_DAYS_V} SELECT Customer_ID, {_TILES} FROM days_v"),
)
def rfm_ntile(spark, sf):
    features = ops.customer_features(written_lines(spark, sf))
    return features.select(ops.KEY, "r_score", "f_score", "m_score")


@query(
    "rfm_score_segment",
    over_lines(f"{_FEATURES_V} SELECT Customer_ID, rfm_score, rfm_segment FROM features_v"),
)
def rfm_score_segment(spark, sf):
    features = ops.customer_features(written_lines(spark, sf))
    return features.select(ops.KEY, "rfm_score", "rfm_segment")


@query("customer_features", over_lines(f"{_FEATURES_V} SELECT * FROM features_v"))
def customer_features(spark, sf):
    return comparable(ops.customer_features(written_lines(spark, sf)))


@query(
    "customer_ml_features",
    over_lines(
        f"{_ML_V} SELECT * FROM features_v LEFT JOIN purchase_v USING (Customer_ID) "
        "LEFT JOIN top_v USING (Customer_ID)"
    ),
)
def customer_ml_features(spark, sf):
    return comparable(ops.customer_ml_features(written_lines(spark, sf)))


@query(
    "customer_ml_join",
    over_lines(
        f"{_ML_V} SELECT * FROM features_v LEFT JOIN purchase_v USING (Customer_ID) "
        "LEFT JOIN top_v USING (Customer_ID)"
    ),
)
def customer_ml_join(spark, sf):
    """The same table from three separately built ones."""
    lines = written_lines(spark, sf)
    joined = ops.join_customer_tables(
        ops.customer_features(lines), ops.customer_product_agg(lines), ops.top_category(lines)
    )
    return comparable(joined)


def merged_in_days(spark, sf):
    """The state after the order lines came in five parts, one of them twice, and a compaction."""
    lines = written_lines(spark, sf)
    path = scratch.scratch_path(spark, "customer-state")
    part = F.pmod(F.xxhash64("Order_ID"), F.lit(5))
    for day in [0, 1, 2, 1, 3, 4]:
        if day == 3:
            customer_state.compact(spark, path)
        customer_state.merge_day(lines.where(part == day), path, str(day), buckets=8)
    return path


@query(
    "customer_state_merged",
    over_lines(
        f"{_BASE_V}{_TOP_V}, purchase_v AS (SELECT Customer_ID, {_PURCHASE} FROM orders_v "
        "GROUP BY Customer_ID) SELECT * FROM base_v LEFT JOIN purchase_v USING (Customer_ID) "
        "LEFT JOIN top_v USING (Customer_ID)"
    ),
)
def customer_state_merged(spark, sf):
    """Merged days give what all lines give at once."""
    return comparable(customer_state.profile(spark, merged_in_days(spark, sf)))


PRODUCT_SQL = """SELECT Product_ID, Product_Category, Product_Subcategory, Brand,
  count(Order_ID) AS times_ordered, cast(sum(Quantity) AS bigint) AS total_quantity_sold,
  round(sum(Order_Amount), 2) AS total_revenue,
  round(avg(Review_Rating) + 1e-9, 6) AS avg_review_rating,
  cast(sum(Returned) AS bigint) AS total_returns,
  round(avg(Profit_Margin_Percent) + 1e-9, 6) AS avg_profit_margin
  FROM orders_v GROUP BY Product_ID, Product_Category, Product_Subcategory, Brand"""


@query("product_features", over_lines(PRODUCT_SQL))
def product_features(spark, sf):
    return comparable(ops.product_features(star.order_lines(spark, sf)))

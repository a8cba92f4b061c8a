"""Registration of queries and the views their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources import star

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return run

    return register


# --- values that compare equal across engines -------------------------------


def ratio6(value: Column | str) -> Column:
    """Six places; the small shift decides exact halves the same way in both engines."""
    return F.round((F.col(value) if isinstance(value, str) else value) + F.lit(1e-9), 6)


def cents(value: Column | str) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, 2)


# --- oracle views ------------------------------------------------------------


def _fill(template: str, **values: str) -> str:
    for name, value in values.items():
        template = template.replace("{" + name + "}", value)
    return template


ORDERS_V = _fill(
    star.ORDER_LINES_SQL,
    days="date_diff('day', o.Order_Date, cast(l.l_shipdate AS date))",
    **{name: name for name in star.TABLES},
)
RAW_V = _fill(star.RAW_LINES_SQL, text="varchar", tab="\t", lines="orders_v").replace("`", '"')

_COMMON = f"orders_v AS ({ORDERS_V})"
_RAW = f"{_COMMON}, raw_v AS ({RAW_V})"


def _text(header: str) -> str:
    return f"regexp_replace(trim(\"{header}\"), '\\s+', ' ', 'g')"


def _double(header: str) -> str:
    return f"try_cast({_text(header)} AS double)"


def _int(header: str) -> str:
    return f"cast(trunc(try_cast({_text(header)} AS double)) AS int)"


def _flag(header: str) -> str:
    hit = f"lower({_text(header)}) IN ('yes', 'y', 'true', '1')"
    return f"CASE WHEN {hit} THEN 1 ELSE 0 END"


RAW_NAMES = {
    "Order ID": "Order_ID", "Customer ID": "Customer_ID", "Product-ID": "Product_ID",
    "Month": "Month", "Day": "Day", "Year": "Year", "Quarter": "Quarter",
    " Product Category ": "Product_Category", "Product/Subcategory": "Product_Subcategory",
    "Brand": "Brand", "Customer Segment": "Customer_Segment", "Country": "Country",
    "Payment Method": "Payment_Method", "Order Status": "Order_Status",
    "Membership Status": "Membership_Status", "Customer Age": "Customer_Age",
    "Customer Lifetime Value": "Customer_Lifetime_Value", "Quantity": "Quantity",
    "Unit Price.": "Unit_Price", "Discount Percent": "Discount_Percent",
    "Discount-Amount": "Discount_Amount", "Tax Amount": "Tax_Amount",
    "Order Amount": "Order_Amount", "Shipping/Cost": "Shipping_Cost",
    "Delivery Days": "Delivery_Days", "Review Rating": "Review_Rating",
    "Profit Margin Percent": "Profit_Margin_Percent", "Coupon Used": "Coupon_Used",
    "High Value Order": "High_Value_Order", "Returned": "Returned",
}
_SILVER_KIND = (
    dict.fromkeys(["Order ID", "Customer ID", "Product-ID"], _text)
    | dict.fromkeys(
        ["Quantity", "Discount Percent", "Delivery Days", "Quarter", "Customer Age"], _int
    )
    | dict.fromkeys(
        ["Customer Lifetime Value", "Unit Price.", "Discount-Amount", "Tax Amount",
         "Order Amount", "Shipping/Cost", "Review Rating", "Profit Margin Percent"], _double
    )
    | dict.fromkeys(["Coupon Used", "High Value Order", "Returned"], _flag)
)
DATE_SQL = (
    "cast(try_strptime(concat_ws('/', {0}, {1}, {2}), '%m/%d/%Y') AS date)".format(
        _text("Month"), _text("Day"), _text("Year")
    )
)
_MEMBERSHIP = f"lower({_text('Membership Status')})"
SILVER_COLUMNS_SQL = ", ".join(
    [
        f"{_SILVER_KIND.get(header, lambda h: f'lower({_text(h)})')(header)} AS {name}"
        for header, name in RAW_NAMES.items()
        if name not in ("Month", "Day", "Year")
    ]
    + [
        f"{DATE_SQL} AS Order_Date",
        f"CASE {_MEMBERSHIP} WHEN 'standard' THEN 0 WHEN 'silver' THEN 1 "
        "WHEN 'gold' THEN 2 WHEN 'platinum' THEN 3 END AS Membership_Status_ord",
    ]
)
SILVER_NAMES = [n for n in RAW_NAMES.values() if n not in ("Month", "Day", "Year")] + [
    "Order_Date", "Membership_Status_ord",
]


def over_lines(body: str) -> str:
    """Oracle over ``orders_v``; ``body`` is a SELECT or starts with ", name AS (...)"."""
    return f"WITH {_COMMON} {body}"


def over_raw(body: str) -> str:
    return f"WITH {_RAW} {body}"


def over_silver(body: str) -> str:
    return f"WITH {_RAW}, silver_v AS (SELECT {SILVER_COLUMNS_SQL} FROM raw_v) {body}"


def text_sql(header: str) -> str:
    return _text(header)

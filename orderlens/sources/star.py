"""Order lines in silver and raw shape, made from a star schema of orders.

Adapts ``lineitem``, ``orders``, ``customer``, ``part`` and ``nation`` to the columns of
the order data model. Attributes the star schema lacks are deterministic functions of
keys. The raw shape holds the same lines as text, with headers and values in the
disorder that cleaning has to repair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources import layers, scratch

#: Lines of a compressed CSV file.
RAW_ROWS_PER_FILE = 500_000

TABLES = ["lineitem", "orders", "customer", "part", "nation"]

# Attributes of customers and parts are worked out on their small tables, before the joins.
# Money is counted in whole cents, whose products are exact in both number types used.
ORDER_LINES_SQL = """
SELECT o.o_orderkey AS Order_ID, o.o_custkey AS Customer_ID, l.l_partkey AS Product_ID,
  o.Order_Date, cast(quarter(o.Order_Date) AS int) AS Quarter,
  p.Product_Category, p.Product_Subcategory, p.Brand,
  o.Customer_Segment, o.Country, o.Payment_Method, o.Order_Status,
  o.Membership_Status, o.Customer_Age, o.c_acctbal AS Customer_Lifetime_Value,
  cast(l.l_quantity AS int) AS Quantity, cast(p.p_retailprice AS double) AS Unit_Price,
  cast(l.disc AS int) AS Discount_Percent,
  floor((l.price * l.disc + 50) / 100) / 100 AS Discount_Amount,
  floor((l.price * (100 - l.disc) * l.tax + 5000) / 10000) / 100 AS Tax_Amount,
  floor((l.price * (100 - l.disc) * (100 + l.tax) + 5000) / 10000) / 100 AS Order_Amount,
  cast(greatest({days}, 0) AS int) AS Delivery_Days,
  CASE WHEN l.l_linenumber = 7 THEN NULL
       ELSE cast(1 + l.l_partkey % 5 AS double) END AS Review_Rating,
  cast(5 + l.l_suppkey % 40 AS double) AS Profit_Margin_Percent,
  CASE WHEN l.disc > 5 THEN 1 ELSE 0 END AS Coupon_Used,
  CASE WHEN l.l_extendedprice > 50000 THEN 1 ELSE 0 END AS High_Value_Order,
  CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS Returned,
  ((l.l_partkey * 7919 + l.l_orderkey * 104729 + l.l_linenumber * 31) % 1000 * 8
    + CASE WHEN l.l_returnflag = 'R' THEN 1500 ELSE 0 END) / 10000 AS Score,
  ((l.l_partkey * 31 + l.l_orderkey * 17 + l.l_linenumber * 7) % 1000 * 7
    + CASE WHEN l.l_returnflag = 'R' THEN 2500 ELSE 0 END) / 10000 AS Score_B
FROM (SELECT *, cast(floor(l_extendedprice * 100 + 0.5) AS bigint) AS price,
             cast(floor(l_discount * 100 + 0.5) AS bigint) AS disc,
             cast(floor(l_tax * 100 + 0.5) AS bigint) AS tax
      FROM {lineitem}) l
JOIN (SELECT o_orderkey, o_custkey, cast(o_orderdate AS date) AS Order_Date,
        lower(o_orderpriority) AS Payment_Method, lower(o_orderstatus) AS Order_Status,
        c_acctbal, lower(c_mktsegment) AS Customer_Segment, lower(n_name) AS Country,
        CASE WHEN c_acctbal < 2500 THEN 'standard' WHEN c_acctbal < 5000 THEN 'silver'
             WHEN c_acctbal < 7500 THEN 'gold' ELSE 'platinum' END AS Membership_Status,
        CASE WHEN c_custkey % 37 = 0 THEN NULL
             ELSE cast(15 + c_custkey % 60 AS int) END AS Customer_Age
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey) o ON l.l_orderkey = o.o_orderkey
JOIN (SELECT p_partkey, p_retailprice, lower(p_type) AS Product_Category,
        lower(p_name) AS Product_Subcategory, lower(p_brand) AS Brand
      FROM {part}) p ON l.l_partkey = p.p_partkey
"""

RAW_LINES_SQL = """
SELECT cast(v.Order_ID AS {text}) AS `Order ID`,
  cast(v.Customer_ID AS {text}) AS `Customer ID`,
  cast(v.Product_ID AS {text}) AS `Product-ID`,
  CASE WHEN v.Order_ID % 97 = 0 THEN '13'
       ELSE cast(month(v.Order_Date) AS {text}) END AS `Month`,
  CASE WHEN v.Order_ID % 101 = 0 THEN NULL
       ELSE cast(day(v.Order_Date) AS {text}) END AS `Day`,
  cast(year(v.Order_Date) AS {text}) AS `Year`,
  cast(v.Quarter AS {text}) AS `Quarter`,
  concat('  ', upper(replace(v.Product_Category, ' ', '  ')), '{tab}') AS ` Product Category `,
  upper(v.Product_Subcategory) AS `Product/Subcategory`,
  concat('{tab}', upper(v.Brand)) AS `Brand`,
  upper(v.Customer_Segment) AS `Customer Segment`,
  concat(upper(v.Country), ' ') AS `Country`,
  upper(v.Payment_Method) AS `Payment Method`,
  v.Order_Status AS `Order Status`,
  CASE WHEN v.Order_ID % 71 = 0 THEN 'bronze'
       WHEN v.Order_ID % 2 = 0 THEN upper(v.Membership_Status)
       ELSE concat(' ', v.Membership_Status) END AS `Membership Status`,
  cast(v.Customer_Age AS {text}) AS `Customer Age`,
  cast(cast(v.Customer_Lifetime_Value AS decimal(18,2)) AS {text}) AS `Customer Lifetime Value`,
  CASE WHEN v.Order_ID % 53 = 0 THEN 'abc' WHEN v.Order_ID % 59 = 0 THEN '3.7'
       ELSE cast(v.Quantity AS {text}) END AS `Quantity`,
  cast(cast(v.Unit_Price AS decimal(18,2)) AS {text}) AS `Unit Price.`,
  cast(v.Discount_Percent AS {text}) AS `Discount Percent`,
  cast(cast(v.Discount_Amount AS decimal(18,2)) AS {text}) AS `Discount-Amount`,
  cast(cast(v.Tax_Amount AS decimal(18,2)) AS {text}) AS `Tax Amount`,
  CASE WHEN v.Order_ID % 61 = 0 THEN ''
       WHEN v.Order_ID % 67 = 0
       THEN concat('  ', cast(cast(v.Order_Amount AS decimal(18,2)) AS {text}), ' ')
       ELSE cast(cast(v.Order_Amount AS decimal(18,2)) AS {text}) END AS `Order Amount`,
  cast(cast(5 + v.Product_ID % 20 AS decimal(18,2)) AS {text}) AS `Shipping/Cost`,
  cast(v.Delivery_Days AS {text}) AS `Delivery Days`,
  cast(cast(v.Review_Rating AS decimal(4,1)) AS {text}) AS `Review Rating`,
  cast(cast(v.Profit_Margin_Percent AS decimal(6,2)) AS {text}) AS `Profit Margin Percent`,
  CASE WHEN v.Coupon_Used = 1 THEN 'Yes' ELSE 'No' END AS `Coupon Used`,
  CASE WHEN v.High_Value_Order = 1 THEN 'true' ELSE 'false' END AS `High Value Order`,
  CASE v.Order_ID % 7 WHEN 0 THEN 'YES' WHEN 1 THEN 'y' WHEN 2 THEN 'True' WHEN 3 THEN '1'
       WHEN 4 THEN 'no' WHEN 5 THEN NULL ELSE 'yess' END AS `Returned`
FROM {lines} v
"""

# The lines of RAW_LINES_SQL for Spark, with the same text made where it costs least. Where a
# number is too large for its type, the text of a part or customer is null and its lines raise.
PART_TEXT_SQL = """
SELECT p_partkey, p_retailprice,
  concat('  ', upper(replace(lower(p_type), ' ', '  ')), '\t') AS category,
  upper(lower(p_name)) AS subcategory, concat('\t', upper(lower(p_brand))) AS brand,
  cast(try_cast(cast(p_retailprice AS double) AS decimal(18,2)) AS string) AS unit_price
FROM {part}
"""

ORDER_TEXT_SQL = """
SELECT o_orderkey, Order_Date, c_acctbal, cast(o_custkey AS string) AS customer_id,
  CASE WHEN o_orderkey % 97 = 0 THEN '13' ELSE cast(month(Order_Date) AS string) END AS month,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE cast(day(Order_Date) AS string) END AS day,
  cast(year(Order_Date) AS string) AS year, cast(quarter(Order_Date) AS string) AS quarter,
  segment, country, upper(lower(o_orderpriority)) AS payment, lower(o_orderstatus) AS status,
  CASE WHEN o_orderkey % 71 = 0 THEN 'bronze'
       WHEN o_orderkey % 2 = 0 THEN upper(Membership_Status)
       ELSE concat(' ', Membership_Status) END AS membership,
  age, lifetime_value
FROM (SELECT *, cast(o_orderdate AS date) AS Order_Date FROM {orders})
JOIN (SELECT c_custkey, c_acctbal, upper(lower(c_mktsegment)) AS segment,
        concat(upper(lower(n_name)), ' ') AS country,
        CASE WHEN c_acctbal < 2500 THEN 'standard' WHEN c_acctbal < 5000 THEN 'silver'
             WHEN c_acctbal < 7500 THEN 'gold' ELSE 'platinum' END AS Membership_Status,
        CASE WHEN c_custkey % 37 = 0 THEN NULL
             ELSE cast(cast(15 + c_custkey % 60 AS int) AS string) END AS age,
        cast(try_cast(c_acctbal AS decimal(18,2)) AS string) AS lifetime_value
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey) ON o_custkey = c_custkey
"""

LINE_TEXT_SQL = """
SELECT cast(o.o_orderkey AS string) AS `Order ID`, o.customer_id AS `Customer ID`,
  cast(l.l_partkey AS string) AS `Product-ID`,
  o.month AS `Month`, o.day AS `Day`, o.year AS `Year`, o.quarter AS `Quarter`,
  p.category AS ` Product Category `, p.subcategory AS `Product/Subcategory`, p.brand AS `Brand`,
  o.segment AS `Customer Segment`, o.country AS `Country`, o.payment AS `Payment Method`,
  o.status AS `Order Status`, o.membership AS `Membership Status`, o.age AS `Customer Age`,
  coalesce(o.lifetime_value, cast(cast(o.c_acctbal AS decimal(18,2)) AS string))
    AS `Customer Lifetime Value`,
  CASE WHEN o.o_orderkey % 53 = 0 THEN 'abc' WHEN o.o_orderkey % 59 = 0 THEN '3.7'
       ELSE cast(cast(l.l_quantity AS int) AS string) END AS `Quantity`,
  coalesce(p.unit_price, cast(cast(cast(p.p_retailprice AS double) AS decimal(18,2)) AS string))
    AS `Unit Price.`,
  cast(cast(l.disc AS int) AS string) AS `Discount Percent`,
  cast(cast(floor((l.price * l.disc + 50) / 100) / 100 AS decimal(18,2)) AS string)
    AS `Discount-Amount`,
  cast(cast(floor((l.price * (100 - l.disc) * l.tax + 5000) / 10000) / 100
    AS decimal(18,2)) AS string) AS `Tax Amount`,
  CASE WHEN o.o_orderkey % 61 = 0 THEN '' ELSE concat(
       CASE WHEN o.o_orderkey % 67 = 0 THEN '  ' ELSE '' END,
       cast(cast(floor((l.price * (100 - l.disc) * (100 + l.tax) + 5000) / 10000) / 100
         AS decimal(18,2)) AS string),
       CASE WHEN o.o_orderkey % 67 = 0 THEN ' ' ELSE '' END) END AS `Order Amount`,
  concat(5 + l.l_partkey % 20, '.00') AS `Shipping/Cost`,
  cast(cast(greatest({days}, 0) AS int) AS string) AS `Delivery Days`,
  CASE WHEN l.l_linenumber = 7 THEN NULL
       ELSE concat(1 + l.l_partkey % 5, '.0') END AS `Review Rating`,
  concat(5 + l.l_suppkey % 40, '.00') AS `Profit Margin Percent`,
  CASE WHEN l.disc > 5 THEN 'Yes' ELSE 'No' END AS `Coupon Used`,
  CASE WHEN l.l_extendedprice > 50000 THEN 'true' ELSE 'false' END AS `High Value Order`,
  CASE o.o_orderkey % 7 WHEN 0 THEN 'YES' WHEN 1 THEN 'y' WHEN 2 THEN 'True' WHEN 3 THEN '1'
       WHEN 4 THEN 'no' WHEN 5 THEN NULL ELSE 'yess' END AS `Returned`
FROM (SELECT *, cast(floor(l_extendedprice * 100 + 0.5) AS bigint) AS price,
             cast(floor(l_discount * 100 + 0.5) AS bigint) AS disc,
             cast(floor(l_tax * 100 + 0.5) AS bigint) AS tax
      FROM {lineitem}) l
JOIN {parts} p ON l.l_partkey = p.p_partkey
JOIN {purchases} o ON l.l_orderkey = o.o_orderkey
"""

_SPARK_DAYS = "datediff(cast(l.l_shipdate AS date), o.Order_Date)"


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute a test table that splits into fewer parts than there are cores.

    The test tables are single files of one row group, which would keep every narrow step on
    one core. Tables with enough splits come back as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def order_lines(spark: SparkSession, path: str) -> DataFrame:
    """Typed order lines; unused columns and joins' payload are pruned by the caller's plan."""
    query = ORDER_LINES_SQL.replace("{days}", _SPARK_DAYS)
    tables = {name: read_table(spark, path, name) for name in TABLES}
    tables["lineitem"] = _spread(tables["lineitem"], "l_orderkey", "l_linenumber")
    return spark.sql(query, **tables)


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same lines as dirty text: the rows of ``RAW_LINES_SQL`` over ``order_lines``.

    Text that depends on a part, customer or order alone is made once for each of them, before
    the joins. Parts come first, since their text is the narrower one to shuffle with the lines.
    """
    tables = {name: read_table(spark, path, name) for name in TABLES}
    tables["lineitem"] = _spread(tables["lineitem"], "l_orderkey", "l_linenumber")
    tables["parts"] = spark.sql(PART_TEXT_SQL, part=tables["part"])
    tables["purchases"] = spark.sql(
        ORDER_TEXT_SQL, **{name: tables[name] for name in ("orders", "customer", "nation")}
    )
    query = LINE_TEXT_SQL.replace("{days}", _SPARK_DAYS)
    return spark.sql(query, **{name: tables[name] for name in ("lineitem", "parts", "purchases")})


def write_raw_lines(spark: SparkSession, path: str) -> str:
    """Write the raw lines as compressed CSV files below the scratch folder and return their place.

    Their text takes several times the tables it is made from; a file is small enough for a task.
    """
    target = scratch.scratch_path(spark, "raw_lines")
    layers.write_csv(raw_lines(spark, path), target, "gzip", rows_per_file=RAW_ROWS_PER_FILE)
    scratch.release_shuffles(spark)
    return target

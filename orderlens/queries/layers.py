"""Sources and sinks: round trips through scratch folders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orderlens import fields
from orderlens.operators import customers, evaluation, splits
from orderlens.queries.customers import PRODUCT_SQL, comparable
from orderlens.queries.evaluation import THRESHOLD_SQL
from orderlens.queries.registry import RAW_NAMES, over_lines, over_raw, query, ratio6
from orderlens.sources import layers, registry, scratch, star

_NARROW = ["Order_ID", "Product_ID", "Quantity", "Order_Amount"]
_NARROW_SQL = over_lines("SELECT Order_ID, Product_ID, Quantity, Order_Amount FROM orders_v")


@query(
    "read_orders_csv",
    over_raw(
        "SELECT * REPLACE (nullif(\"Order Amount\", '') AS \"Order Amount\") FROM raw_v"
    ),
)
def read_orders_csv(spark, sf):
    """An empty field reads as null, quoted or not."""
    path = star.write_raw_lines(spark, sf)
    return layers.read_orders_csv(spark, path, columns=list(RAW_NAMES))


# what becomes of every line of a file in which some lines lost or gained fields
_DAMAGE_SQL = (
    "CASE WHEN Order_ID % 89 = 0 THEN 'too few fields' WHEN Order_ID % 83 = 0 THEN 'too many fields' "
    "WHEN Order_ID % 79 = 0 THEN 'open quote' END"
)
_DAMAGED_LINE = {
    None: "concat_ws(',', Order_ID, concat('\"', Product_Category, ', \"\"new\"\"\"'), Quantity, Order_Status)",
    "too few fields": "concat_ws(',', Order_ID, Quantity)",
    "too many fields": "concat_ws(',', Order_ID, Product_Category, Quantity, Order_Status, 'more', '')",
    "open quote": "concat_ws(',', Order_ID, concat('\"', Product_Category), Quantity, Order_Status)",
}


def damaged_lines(spark, sf):
    """Order lines as CSV text with one quoted field, some of them damaged."""
    lines = star.order_lines(spark, sf)
    damage = F.expr(_DAMAGE_SQL)
    text = F.expr(_DAMAGED_LINE[None])
    for reason, made in _DAMAGED_LINE.items():
        if reason:
            text = F.when(damage == reason, F.expr(made)).otherwise(text)
    return lines.select(text.alias("value"))


@query(
    "read_orders_checked",
    over_lines(
        f"SELECT Order_ID, coalesce({_DAMAGE_SQL}, 'good') AS outcome, count(*) AS n, "
        f"cast(CASE {_DAMAGE_SQL} WHEN 'too few fields' THEN 2 WHEN 'too many fields' THEN 6 "
        "WHEN 'open quote' THEN 4 ELSE 4 END AS int) AS fields, "
        f"CASE WHEN {_DAMAGE_SQL} IS NULL THEN min(Product_Category || ', \"new\"') END AS category "
        "FROM orders_v GROUP BY Order_ID"
    ),
)
def read_orders_checked(spark, sf):
    """Every line is a good row or a quarantined one, which keeps its text and has a reason."""
    path = scratch.scratch_path(spark, "damaged_csv")
    damaged_lines(spark, sf).write.text(path)
    columns = ["Order_ID", "Product_Category", "Quantity", "Order_Status"]
    read = layers.read_orders_checked(spark, path, columns, header=False)
    good = read.rows.select(
        F.col("Order_ID").cast("long").alias("Order_ID"),
        F.lit("good").alias("outcome"),
        F.lit(len(columns)).alias("fields"),
        F.col("Product_Category").alias("category"),
    )
    bad = read.quarantined.select(
        F.substring_index("line", ",", 1).cast("long").alias("Order_ID"),
        F.col("reason").alias("outcome"),
        "fields",
        F.lit(None).cast("string").alias("category"),
    )
    both = good.unionByName(bad)
    return both.groupBy("Order_ID", "outcome", "fields").agg(
        F.count("*").alias("n"), F.min("category").alias("category")
    )


@query("read_layer", _NARROW_SQL)
def read_layer(spark, sf):
    path = scratch.scratch_path(spark, "lines")
    layers.write_layer(star.order_lines(spark, sf).select(*_NARROW, "Brand"), path)
    return layers.read_layer(spark, path).select(_NARROW)


@query(
    "write_layer_overwrite",
    over_lines(
        "SELECT 'now' AS version, Order_ID, Product_ID, Quantity, Order_Amount FROM orders_v "
        "UNION ALL SELECT 'before', Order_ID, Product_ID, cast(NULL AS int), cast(NULL AS double) "
        "FROM orders_v WHERE Returned = 1"
    ),
)
def write_layer_overwrite(spark, sf):
    """The second write replaces rows and schema; a reader opened before keeps the first."""
    path = scratch.scratch_path(spark, "replaced")
    lines = star.order_lines(spark, sf)
    before = layers.write_layer(lines.where("Returned = 1").select("Order_ID", "Product_ID"), path)
    now = layers.write_layer(lines.select(_NARROW), path)
    return now.select(F.lit("now").alias("version"), *_NARROW).unionByName(
        before.select(F.lit("before").alias("version"), "Order_ID", "Product_ID"),
        allowMissingColumns=True,
    )


def yearly_runs(spark, sf):
    """One run per order year: how well a score of 0.5 tells returns apart in that year."""
    lines = star.order_lines(spark, sf).select("Order_Date", "Returned", "Score")
    hit = (F.col("Score") >= 0.5).cast("int") == F.col("Returned")
    return lines.groupBy(F.year("Order_Date").alias("run_year")).agg(
        F.count("*").alias("test_rows"),
        F.avg(hit.cast("int")).alias("test_accuracy"),
        F.max("Order_Date").alias("logged_on"),
    )


_RUNS_V = """, runs_v AS (SELECT cast(year(Order_Date) AS int) AS run_year,
    count(*) AS test_rows,
    round(avg(CASE WHEN (CASE WHEN Score >= 0.5 THEN 1 ELSE 0 END) = Returned
              THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS test_accuracy,
    max(Order_Date) AS logged_on FROM orders_v GROUP BY 1)"""


@query(
    "append_run_log",
    over_lines(
        f"{_RUNS_V} SELECT run_year, test_rows, test_accuracy, "
        "CASE WHEN run_year % 2 = 1 THEN logged_on END AS logged_on FROM runs_v"
    ),
)
def append_run_log(spark, sf):
    """Two appends, of which only the second has the column ``logged_on``; both are retried."""
    path = scratch.scratch_path(spark, "run_log")
    runs = yearly_runs(spark, sf)
    odd = F.col("run_year") % 2 == 1
    for _ in range(2):
        layers.append_rows(runs.filter(~odd).drop("logged_on"), path, run_id="even")
        layers.append_rows(runs.filter(odd), path, run_id="odd")
    log = layers.read_log(spark, path)
    return log.select("run_year", "test_rows", ratio6("test_accuracy").alias("test_accuracy"), "logged_on")


@query(
    "latest_run",
    over_lines(
        f"{_RUNS_V} SELECT 'run-' || run_year AS run_id, test_rows, "
        "cast(logged_on AS timestamp) AS logged_at_utc FROM runs_v "
        "ORDER BY logged_on DESC LIMIT 1"
    ),
)
def latest_run(spark, sf):
    log = yearly_runs(spark, sf).select(
        F.concat(F.lit("run-"), F.col("run_year").cast("string")).alias("run_id"),
        "test_rows",
        F.col("logged_on").cast("timestamp_ntz").alias("logged_at_utc"),
    )
    return registry.latest_run(log)


@query("write_csv_extract", over_lines(PRODUCT_SQL))
def write_csv_extract(spark, sf):
    path = scratch.scratch_path(spark, "products_csv")
    products = customers.product_features(star.order_lines(spark, sf))
    layers.write_csv(products, path)
    return comparable(spark.read.schema(products.schema).option("header", True).csv(path))


_COUNT_SQL = over_lines(
    "SELECT Customer_ID, Product_Category, count(Order_ID) AS category_order_count "
    "FROM orders_v GROUP BY ALL"
)


@query("write_csv_single", _COUNT_SQL)
def write_csv_single(spark, sf):
    path = scratch.scratch_path(spark, "counts_csv")
    counts = customers.category_order_count(star.order_lines(spark, sf))
    layers.write_csv_single(counts, path)
    return spark.read.schema(counts.schema).option("header", True).csv(path)


@query("save_catalog_tables", _COUNT_SQL)
def save_catalog_tables(spark, sf):
    database = f"orderlens_{uuid.uuid4().hex[:12]}"
    counts = customers.category_order_count(star.order_lines(spark, sf))
    layers.save_tables(
        spark, database, {"category_counts": counts}, scratch.scratch_path(spark, database)
    )
    return spark.table(f"{database}.category_counts")


@query("rows_to_table", over_lines(THRESHOLD_SQL))
def rows_to_table(spark, sf):
    """Five metric rows through the driver and back into a table with declared types."""
    lines = star.order_lines(spark, sf)
    metrics = evaluation.threshold_metrics(lines, "Returned", "Score")
    rows = metrics.collect()
    return layers.rows_to_table(spark, rows, metrics.schema)


@query(
    "persist_reload",
    over_lines(
        "SELECT CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split, Returned AS returned, "
        "count(*) AS n FROM (SELECT *, cast('0x' || substr(md5(cast(Order_ID AS varchar)), 1, 8) "
        "AS bigint) % 100 AS bucket FROM orders_v) GROUP BY ALL"
    ),
)
def persist_reload(spark, sf):
    """Both splits written and read back, so later stages see the same rows."""
    lines = star.order_lines(spark, sf).select("Order_ID", F.col("Returned").alias("returned"))
    train, test = splits.train_test_split(lines, ["Order_ID"])
    parts = splits.tagged_union(
        scratch.durable(train, "train_split"), scratch.durable(test, "test_split")
    )
    return parts.groupBy("split", fields.LABEL).agg(F.count("*").alias("n"))


@query(
    "read_back_validate",
    over_lines(
        ", c AS (SELECT count(*) AS n FROM orders_v), d AS (SELECT count(*) AS n FROM "
        "(SELECT DISTINCT Customer_ID, Product_Category FROM orders_v)) "
        "SELECT 'lines' AS layer, n AS rows, cast(4 AS int) AS columns, true AS ok FROM c "
        "UNION ALL SELECT 'categories', n, 3, true FROM d "
        "UNION ALL SELECT 'changed', n, 4, false FROM c "
        "UNION ALL SELECT 'doubled', 2 * n, 4, false FROM c"
    ),
)
def read_back_validate(spark, sf):
    """Two written layers against their fingerprints, and two that are no longer what was written."""
    lines = star.order_lines(spark, sf)
    paths = {name: scratch.scratch_path(spark, name) for name in ("lines", "categories")}
    read = {
        "lines": layers.write_layer(lines.select(_NARROW), paths["lines"]),
        "categories": layers.write_layer(
            customers.category_order_count(lines), paths["categories"]
        ),
    }
    stored = {name: layers.stored_fingerprint(spark, path) for name, path in paths.items()}
    first = read["lines"].agg(F.min("Order_ID")).scalar()
    one_more = F.col("Quantity") + F.when(F.col("Order_ID") == first, 1).otherwise(0)
    read["changed"] = read["lines"].withColumn("Quantity", one_more)
    read["doubled"] = read["lines"].unionAll(read["lines"])
    stored |= dict.fromkeys(("changed", "doubled"), stored["lines"])
    return layers.layer_counts(read, stored)


@query(
    "preview_rows",
    over_lines(
        "SELECT Order_ID, Product_ID, Quantity, Order_Amount FROM orders_v "
        "ORDER BY Order_Amount DESC, Order_ID, Product_ID, Quantity LIMIT 10"
    ),
)
def preview_rows(spark, sf):
    lines = star.order_lines(spark, sf).select(_NARROW)
    return layers.preview(
        lines, 10, [F.desc("Order_Amount"), "Order_ID", "Product_ID", "Quantity"]
    )


@query(
    "artifact_check",
    over_lines(
        "SELECT 'lines' AS layer, count(*) AS rows, '' AS missing_columns, true AS ok "
        "FROM orders_v UNION ALL SELECT 'returned_free', "
        "count(*) FILTER (WHERE Returned = 1 AND Score < 0), 'Brand', false FROM orders_v "
        "UNION ALL SELECT 'lost', count(*) FILTER (WHERE Returned = 1), '', false FROM orders_v"
    ),
)
def artifact_check(spark, sf):
    """A sound layer, an empty one that lacks a column, and one that lost rows since its write."""
    path = scratch.scratch_path(spark, "artifact")
    lines = layers.write_layer(star.order_lines(spark, sf).select(*_NARROW, "Returned", "Score"), path)
    stored = layers.stored_fingerprint(spark, path)
    never = (F.col("Returned") == 1) & (F.col("Score") < 0)
    return layers.artifact_check(
        {
            "lines": lines,
            "returned_free": lines.filter(never).select(_NARROW),
            "lost": lines.filter(F.col("Returned") == 1),
        },
        {"lines": _NARROW, "returned_free": ["Brand", "Order_ID"]},
        {"lines": stored, "lost": stored},
    )


def event_registry(spark, sf):
    """Runs, tags and experiments read off the events: an event is a run of its user."""
    events = star.read_table(spark, sf, "events")
    runs = events.select(
        F.col("event_id").alias("run_uuid"),
        F.col("user_id").alias("experiment_id"),
        F.when(F.col("event_id") % 10 == 0, "FAILED").otherwise("FINISHED").alias("status"),
        F.col("ts").alias("start_time"),
    )
    tags = events.select(
        F.col("event_id").alias("run_uuid"),
        F.lit("kind").alias("key"),
        F.col("event_type").alias("value"),
    )
    experiments = events.select(
        F.col("user_id").alias("experiment_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
    ).distinct()
    return experiments, runs, tags


_NEWEST = """SELECT {0}, event_id AS run_id, ts AS start_time FROM events
  WHERE event_type = 'purchase' AND event_id % 10 <> 0
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("read_registry_sql", _NEWEST.format("'user-' || user_id AS experiment_name"))
def read_registry_sql(spark, sf):
    experiments, runs, tags = event_registry(spark, sf)
    return registry.latest_runs_sql(spark, experiments, runs, tags, "kind", "purchase")


@query("latest_finished_run", _NEWEST.format("user_id AS experiment_id"))
def latest_finished_run(spark, sf):
    _, runs, tags = event_registry(spark, sf)
    return registry.latest_finished_runs(runs, tags, "kind", "purchase")


_KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "metric_kv_pivot",
    "SELECT user_id, "
    + ", ".join(
        f"round(max(value) FILTER (WHERE event_type = '{k}'), 6) AS {k}" for k in _KINDS
    )
    + " FROM events GROUP BY user_id",
)
def metric_kv_pivot(spark, sf):
    pairs = star.read_table(spark, sf, "events")
    wide = registry.key_values_wide(pairs, "user_id", "event_type", "value", _KINDS)
    return wide.select("user_id", *[F.round(k, 6).alias(k) for k in _KINDS])

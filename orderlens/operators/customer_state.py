"""Customer aggregates kept up day by day, without the earlier lines.

A day of order lines becomes partial states: per customer and category its sums, counts, dates and
first attributes, and the distinct products and brands of each customer. They are appended,
each day's once however often it is tried, in folders by a hash of the customer. A customer's
aggregates are the merged states, so a day reads its own lines and the states in the buckets of
the customers it touches, not the lines of earlier days. ``compact`` merges the states of all
days into one and starts the next generation by one rename.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators import customers
from orderlens.operators.customers import KEY
from orderlens.sources import files, layers

BUCKETS = 64
_BUCKET = "bucket__"
_POINTER = "_generation"
_PRODUCT, _BRAND = "product", "brand"
_COMPACTED = "compacted"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(KEY)), F.lit(buckets)).cast("int")


def purchase_values(lines: DataFrame) -> DataFrame:
    """Distinct (customer, kind, value) of products and brands; null is no value."""
    values = F.array(
        F.struct(F.lit(_PRODUCT).alias("kind"), F.col("Product_ID").cast("string").alias("value")),
        F.struct(F.lit(_BRAND).alias("kind"), F.col("Brand").cast("string").alias("value")),
    )
    return (
        lines.select(KEY, F.explode(values).alias("v"))
        .select(KEY, "v.kind", "v.value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def _variety(values: DataFrame) -> DataFrame:
    """Distinct products and brands per customer; a value may stand there for several days."""

    def of_kind(kind: str, name: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull()).alias(name)

    # a distinct count of each kind would shuffle every value once per kind
    return values.select(KEY, "kind", "value").distinct().groupBy(KEY).agg(
        of_kind(_PRODUCT, "distinct_products"), of_kind(_BRAND, "distinct_brands")
    )


def _generation(spark: SparkSession, path: str) -> dict:
    text = files.read_text(spark, f"{path}/{_POINTER}")
    return json.loads(text) if text else {"folder": "g-0", "days": [], "buckets": None, "schemas": {}}


def _append(states: dict[str, DataFrame], folder: str, run: str, buckets: int) -> None:
    """Write states by bucket; a bucket larger than a task should get is split over several."""
    for name, state in states.items():
        layers.commit_rows(
            state.withColumn(_BUCKET, _bucket(buckets)).hint("rebalance", F.col(_BUCKET)),
            f"{folder}/{name}",
            run_id=run,
            partition_by=[_BUCKET],
        )


def merged_days(spark: SparkSession, path: str) -> list[str]:
    """Days that the state holds, sorted."""
    now = _generation(spark, path)
    logged = layers.logged_runs(spark, f"{path}/{now['folder']}/variety").collect()
    return sorted({*now["days"], *(r["run_id"] for r in logged)} - {_COMPACTED})


def merge_day(lines: DataFrame, path: str, day: str, buckets: int = BUCKETS) -> bool:
    """Add a day's lines to the state; False, and nothing changes, if the day is in already.

    ``buckets`` is that of the first day; ``compact`` can change it.

    The part that counts a day is written last: a try that died between the parts is made good
    by the next one, whose first part is then left out as the day's second.
    """
    spark = lines.sparkSession
    if day in merged_days(spark, path):
        return False
    now = _generation(spark, path)
    states = {"measures": customers.category_state(lines), "variety": purchase_values(lines)}
    if now["buckets"] is None:
        schemas = {name: state.schema.jsonValue() for name, state in states.items()}
        now |= {"buckets": buckets, "schemas": schemas}
        files.replace_text(spark, f"{path}/{_POINTER}", json.dumps(now))
    _append(states, f"{path}/{now['folder']}", day, now["buckets"])
    return True


def _states(spark: SparkSession, path: str, touched: DataFrame | None) -> list[DataFrame]:
    now = _generation(spark, path)
    days = layers.logged_runs(spark, f"{path}/{now['folder']}/variety")
    found = []
    for name in ("measures", "variety"):
        schema = T.StructType.fromJson(now["schemas"][name]).add(_BUCKET, T.IntegerType())
        rows = layers.read_log(
            spark, f"{path}/{now['folder']}/{name}", runs=days, schema=schema
        )
        if touched is not None:
            keys = touched.select(F.col(KEY).alias("touched__")).distinct()
            # at most as many numbers as there are buckets; folders of others are not read
            buckets = [
                r[0] for r in touched.select(_bucket(now["buckets"])).distinct().collect()
            ]
            rows = rows.where(F.col(_BUCKET).isin(buckets)).join(
                keys, F.col(KEY).eqNullSafe(F.col("touched__")), "left_semi"
            )
        found.append(rows.drop(_BUCKET))
    return found


def profile(spark: SparkSession, path: str, touched: DataFrame | None = None) -> DataFrame:
    """What ``customers.customer_profile`` gives for the lines of all merged days.

    ``touched``: a table with the customers wanted, such as a day's lines; without it all.
    """
    measures, variety = _states(spark, path, touched)
    return customers.profile_of(customers.merge_category_states(measures), _variety(variety))


def compact(spark: SparkSession, path: str, buckets: int | None = None) -> None:
    """Merge the states of all days into one, optionally in another number of buckets.

    Readers and writers go on with the old generation until one rename; its folder is then
    deleted. Days that are merged meanwhile would be lost with it, so no other job may write.
    """
    now = _generation(spark, path)
    days = merged_days(spark, path)
    measures, variety = _states(spark, path, None)
    target, buckets = f"g-{uuid.uuid4().hex[:12]}", buckets or now["buckets"]
    states = {"measures": customers.merge_category_states(measures), "variety": variety.distinct()}
    _append(states, f"{path}/{target}", _COMPACTED, buckets)
    after = now | {"folder": target, "days": days, "buckets": buckets}
    files.replace_text(spark, f"{path}/{_POINTER}", json.dumps(after))
    files.delete(spark, f"{path}/{now['folder']}")

"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

All queries run once to warm up; then each runs three times and the median counts. Every
registered query is timed as registered; what many of them share, the order lines, is also
timed alone, so that an operator's own time can be told from it. Names as arguments limit
the run to those queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from orderlens.plans.features import job_features
from orderlens.queries import QUERIES
from orderlens.sources import scratch, star

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def force(df: DataFrame) -> None:
    """Compute every column of every row."""
    df.write.format("noop").mode("overwrite").save()


def registered(key: str):
    return lambda spark, sf: force(QUERIES[key](spark, sf))


def order_lines(spark, sf):
    """The four-way join behind most queries, all columns."""
    force(star.order_lines(spark, sf))


def features_job(spark, sf):
    """All three feature layers of the order lines, written."""
    job_features(star.order_lines(spark, sf), scratch.scratch_path(spark, "features"))


BENCHED = {
    key: registered(key)
    for key in (
        "product_features",
        "customer_base",
        "customer_features",
        "customer_ml_features",
        "rfm_ntile",
        "top_category",
        "threshold_metrics",
        "classification_report",
        "eval_roc_auc",
        "rare_category_cap",
        "rf_feature_layer",
        "job_silver",
        "clean_whitespace",
    )
}
BENCHED |= {
    "order_lines": order_lines,
    "job_features": features_job,
    "train_random_forest": registered("train_random_forest"),
}


def measure(key: str, run, spark) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run(spark, SF_DIR)
        times.append(time.perf_counter() - start)
    median = round(statistics.median(times), 3)
    print(key, median, file=sys.stderr, flush=True)
    return median


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("orderlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # keep every query's compiled code between runs
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = [a for a in sys.argv[1:] if not a.startswith("--")]
    benched = {k: run for k, run in BENCHED.items() if not only or k in only}
    for run in benched.values():
        run(spark, SF_DIR)
    ours = {key: measure(key, run, spark) for key, run in benched.items()}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(ours.values()), 3),
        "unit": "sec",
        "queries": ours,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    scratch.drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()

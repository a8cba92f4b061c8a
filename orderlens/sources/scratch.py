"""Durable intermediate tables.

A frame that is read more than once, or whose rows must not move between reads,
is written to the folder the cluster shares (``spark.checkpoint.dir``) and read
back. Unlike a cached frame it outlives lost executors, and unlike a checkpoint
it stays columnar, so later reads still prune columns. Without that setting the folder is below
the SQL warehouse, which a cluster shares as well. ``scope`` deletes what a job wrote.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources import files

SCRATCH_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"

_scopes: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared scratch folder."""
    app = spark.conf.get("spark.app.id")
    configured = spark.conf.get(SCRATCH_SETTING, None)
    if configured:
        return f"{configured.rstrip('/')}/orderlens-{app}"
    warehouse = spark.conf.get(WAREHOUSE_SETTING, None) or ""
    master = spark.conf.get("spark.master", "")
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and (warehouse.startswith("file:") or ":/" not in warehouse):
        raise ValueError(
            f"{SCRATCH_SETTING} or {WAREHOUSE_SETTING} must name a folder that all executors "
            "share; a machine-local folder cannot serve a cluster"
        )
    return f"{warehouse.rstrip('/')}/_scratch/orderlens-{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet."""
    return "/".join([scratch_root(spark), *_scopes, f"{name}-{uuid.uuid4().hex[:12]}"])


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are deleted at the end, also after an error.

    What leaves the scope must be written elsewhere by then.
    """
    _scopes.append(f"scope-{uuid.uuid4().hex[:12]}")
    path = "/".join([scratch_root(spark), *_scopes])
    try:
        yield
    finally:
        _scopes.pop()
        files.delete(spark, path)


def durable(
    df: DataFrame, name: str, partition_by: str | None = None, rows_per_file: int | None = None
) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written rows."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nobody holds any more.

    It does so when the driver collects its garbage, which a driver with little to do may put off
    for half an hour, while the next step of a job needs their disk.
    """
    gc.collect()
    spark._jvm.System.gc()


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once nothing reads them any more."""
    files.delete(spark, scratch_root(spark))

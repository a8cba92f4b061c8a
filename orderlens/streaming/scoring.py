"""Continuous scoring of transaction files as they arrive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderlens import fields
from orderlens.plans.scoring import RECORD_SCHEMA, score_batch


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RECORD_SCHEMA,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Stream of record files. The schema is given, never inferred."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_score(
    model: PipelineModel,
    records: DataFrame,
    output: str,
    checkpoint: str,
    threshold: float = fields.SERVING_THRESHOLD,
    keep: Sequence[str] = (),
    interval: str | None = None,
    fmt: str = "parquet",
    defaults: Mapping[str, float] | None = None,
) -> StreamingQuery:
    """Append scores to a layer of files, each record exactly once.

    Scoring is stateless. Without ``interval`` the query handles what is there and ends.
    """
    writer = (
        score_batch(model, records, threshold, keep, defaults)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start(output)

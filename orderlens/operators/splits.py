"""Train/test splits and reshaping of small result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.functions import scoring
from orderlens.sources import scratch

SPLIT_COLUMN = "split"
TRAIN, TEST, VALIDATION = "train", "test", "validation"


def split_bucket(*keys: str):
    """Bucket 0..99 of a row key, the same in every run and on every partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def tag_split(
    df: DataFrame,
    keys: Sequence[str],
    train_percent: int = fields.TRAIN_PERCENT,
    validation_percent: int = 0,
) -> DataFrame:
    """Mark each row by a hash of its key; equal keys stay together.

    Validation rows are the last ``validation_percent`` buckets of the training side, so
    the test rows are the same with and without them.
    """
    bucket = split_bucket(*keys)
    part = F.when(bucket < train_percent - validation_percent, TRAIN).when(
        bucket < train_percent, VALIDATION
    )
    return df.withColumn(SPLIT_COLUMN, part.otherwise(TEST))


def train_test_split(
    df: DataFrame, keys: Sequence[str], train_percent: int = fields.TRAIN_PERCENT
) -> tuple[DataFrame, DataFrame]:
    tagged = tag_split(df, keys, train_percent)
    return take_split(tagged, TRAIN), take_split(tagged, TEST)


def random_split(
    df: DataFrame, train_percent: int = fields.TRAIN_PERCENT, seed: int = fields.SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split.

    It depends on the order and the partitioning of the rows, so these are written first:
    both parts then read the same files, and every row is in one of them.
    """
    rows = scratch.durable(df, "random-split")
    train, test = rows.randomSplit([train_percent / 100, 1 - train_percent / 100], seed=seed)
    return train, test


def take_split(tagged: DataFrame, part: str) -> DataFrame:
    return tagged.filter(F.col(SPLIT_COLUMN) == part).drop(SPLIT_COLUMN)


def tagged_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both parts in one table with a marker column."""
    return train.withColumn(SPLIT_COLUMN, F.lit(TRAIN)).unionByName(
        test.withColumn(SPLIT_COLUMN, F.lit(TEST))
    )


def melt_metrics(
    comparison: DataFrame,
    id_column: str = "model_name",
    metrics: Sequence[str] = fields.COMPARED_METRICS,
) -> DataFrame:
    """Wide metrics to (model, metric, score) rows; absent metrics are skipped."""
    have = [m for m in metrics if m in comparison.columns]
    return comparison.unpivot([id_column], have, "metric", "score")


def label_metrics(melted: DataFrame) -> DataFrame:
    return melted.withColumn("metric", scoring.metric_label(F.col("metric")))

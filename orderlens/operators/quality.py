"""Profiles and distributions; each is one aggregate with map-side combine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators import ranking


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of every column, one wide row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_profile_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of every column, one row per column."""
    wide = null_profile(df, columns)
    return wide.unpivot([], wide.columns, "column_name", "null_count")


def bad_date_count(df: DataFrame, column: str = "Order_Date") -> DataFrame:
    return null_profile(df, [column]).withColumnRenamed(column, "null_dates")


def value_counts(df: DataFrame, *columns: str, count: str = "n") -> DataFrame:
    """Rows per value: label, segment, category or (actual, predicted) distribution."""
    return df.groupBy(*columns).agg(F.count("*").alias(count))


def conditional_counts(df: DataFrame, key: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Per key, the rows that meet each named condition; null conditions are not met."""
    return df.groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def top_rows(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows in an order; every task keeps ``k`` rows at most."""
    return df.orderBy(*order).limit(k)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return value_counts(df, label).orderBy(label)


def segment_distribution(df: DataFrame, segment: str = "rfm_segment") -> DataFrame:
    return value_counts(df, segment).orderBy(F.desc("n"), F.asc(segment))


def top_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def probability_summary(df: DataFrame, score: str) -> DataFrame:
    """Min, quartiles and max of a score; quartiles are exact observed values."""
    names = ["min_probability", "p25", "median", "p75", "max_probability"]
    values = ranking.quantiles(df, score, [0, 0.25, 0.5, 0.75, 1])
    kind = df.schema[score].dataType
    return df.sparkSession.createDataFrame(
        [tuple(values)], T.StructType([T.StructField(n, kind) for n in names])
    )


def extremes(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))

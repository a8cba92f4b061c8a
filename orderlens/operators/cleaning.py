"""Repair of raw order lines. Each step touches only the columns that exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import fields
from orderlens.functions import cleaning
from orderlens.operators.schema import map_present, present


def clean_text(df: DataFrame) -> DataFrame:
    """Normalise whitespace in every string column; columns nobody reads are pruned."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return map_present(df, names, cleaning.clean_whitespace)


def rebuild_order_date(df: DataFrame) -> DataFrame:
    """Replace Month, Day and Year by ``Order_Date``; a bad date is null."""
    if len(present(df, fields.DATE_PARTS)) < len(fields.DATE_PARTS):
        return df
    date = cleaning.date_from_parts(*[F.col(part) for part in fields.DATE_PARTS])
    return df.withColumn("Order_Date", date).drop(*fields.DATE_PARTS)


def cast_numerics(df: DataFrame) -> DataFrame:
    """Numeric text to double or int; bad values are null."""
    typed = map_present(df, fields.DOUBLE_COLUMNS, cleaning.to_double)
    return map_present(typed, fields.INT_COLUMNS, cleaning.to_int)


def normalize_flags(df: DataFrame) -> DataFrame:
    return map_present(df, fields.FLAG_COLUMNS, cleaning.yes_no_flag)


def lowercase_values(df: DataFrame) -> DataFrame:
    return map_present(df, fields.LOWERCASE_COLUMNS, F.lower)


def add_membership_ordinal(df: DataFrame) -> DataFrame:
    if not present(df, [fields.MEMBERSHIP_COLUMN]):
        return df
    level = cleaning.ordinal(F.col(fields.MEMBERSHIP_COLUMN), fields.MEMBERSHIP_LEVELS)
    return df.withColumn(f"{fields.MEMBERSHIP_COLUMN}_ord", level)

"""Expressions over one row of customer or order features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens import fields


def age_bucket(age: Column) -> Column:
    """Age band label; a missing age is its own band."""
    label = F.when(age.isNull(), fields.UNKNOWN_AGE)
    for lowest, name in reversed(fields.AGE_BANDS):
        label = label.when(age >= lowest, name)
    return label.otherwise(fields.UNDER_AGE)


def rfm_segment(score: Column) -> Column:
    label = None
    for lowest, name in fields.RFM_SEGMENTS:
        label = (F if label is None else label).when(score >= lowest, name)
    return label.otherwise(fields.RFM_LOWEST_SEGMENT)


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar features; ``order_dow`` counts from Sunday = 1."""
    return {
        "order_year": F.year(day),
        "order_month": F.month(day),
        "order_day": F.dayofmonth(day),
        "order_dow": F.dayofweek(day),
    }


def order_values(
    unit_price: Column,
    quantity: Column,
    discount_percent: Column,
    shipping_cost: Column,
    tax_percent: Column,
) -> dict[str, Column]:
    """Gross, discount, tax and final amount of an order line, to cents.

    Pass decimals for exact cents; doubles work too and carry binary rounding.
    """
    gross = unit_price * quantity
    discount = gross * discount_percent / 100
    taxable = gross - discount
    tax = taxable * tax_percent / 100
    return {
        "gross_amount": F.round(gross, 2),
        "discount_amount": F.round(discount, 2),
        "tax_amount": F.round(tax, 2),
        "order_amount": F.round(taxable + tax + shipping_cost, 2),
    }

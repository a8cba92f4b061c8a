"""Expressions over model scores and metric names."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens import fields


def return_probability(probability: Column) -> Column:
    """Positive-class probability of a [P(kept), P(returned)] vector.

    Indexes by position, so sparse vectors give the right entry as well.
    """
    return vector_to_array(probability)[1]


def threshold_flag(score: Column, threshold: Column | float) -> Column:
    """1 where the score reaches the threshold, else 0; a null score is 0."""
    return F.when(score >= threshold, 1).otherwise(0)


def risk_label(probability: Column) -> Column:
    label = None
    for lowest, name in fields.RISK_LABELS:
        label = (F if label is None else label).when(probability >= lowest, name)
    return label.otherwise(fields.LOWEST_RISK_LABEL)


def round_score(probability: Column) -> Column:
    return F.round(probability, 6)


def metric_label(name: Column) -> Column:
    """Display name of a metric column."""
    upper = F.upper(name)
    return F.when(upper == "ROC_AUC", "ROC-AUC").otherwise(upper)


def utc_stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss 'UTC'")

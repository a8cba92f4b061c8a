"""Scoring of transaction records, in batch; ``streaming.scoring`` reuses it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import fields
from orderlens.functions import cleaning, scoring
from orderlens.functions.customer import date_parts

# every field of a record may be missing or null
RECORD_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in fields.NUMERIC_FEATURES]
    + [T.StructField(name, T.StringType()) for name in fields.CATEGORICAL_FEATURES]
)

# values that training keeps as they are: silver lower-cases the other categories
_CASED = {"day_of_week"}


def _category(name: str, text: Column) -> Column:
    text = cleaning.clean_whitespace(text.cast("string"))
    if name in _CASED:
        return text
    return F.when(text == fields.RARE_LABEL, text).otherwise(F.lower(text))


def prepare_records(
    records: DataFrame,
    defaults: Mapping[str, float] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Records in the shape the model was trained on.

    Columns are found in any case; others are ignored. Text gets the cleaning of the
    silver layer, and date features come from an order date where they are not given. A
    missing or unknown category sets the extra last indicator, which training never sees; a
    missing number becomes its entry in ``defaults`` (such as ``training_means``), or 0.
    """
    given = {name.lower(): F.col(f"`{name}`") for name in records.columns}
    if len(given) < len(records.columns):
        raise ValueError(f"columns differ only in case: {sorted(records.columns)}")
    if "order_date" in given:
        given = date_parts(given["order_date"]) | given
    missing, values = F.lit(None), defaults or {}
    numbers = [
        F.coalesce(
            given.get(name, missing).cast("double"), F.lit(float(values.get(name, 0.0)))
        ).alias(name)
        for name in fields.NUMERIC_FEATURES
    ]
    texts = [
        _category(name, given.get(name, missing)).alias(name)
        for name in fields.CATEGORICAL_FEATURES
    ]
    return records.select(*keep, *numbers, *texts)


def training_means(train: DataFrame) -> dict[str, float]:
    """Mean of each numeric feature, as defaults for incomplete records."""
    names = [n for n in fields.NUMERIC_FEATURES if n in train.columns]
    means = train.agg(*[F.avg(n).alias(n) for n in names]).first().asDict()
    return {name: mean for name, mean in means.items() if mean is not None}


def defaults_table(spark: SparkSession, defaults: Mapping[str, float]) -> DataFrame:
    """Scoring defaults as a layer beside the model; ``read_defaults`` is the way back."""
    return spark.createDataFrame(list(defaults.items()), "feature string, value double")


def read_defaults(table: DataFrame) -> dict[str, float]:
    """One row per numeric feature."""
    return {row["feature"]: row["value"] for row in table.collect()}


def score_batch(
    model: PipelineModel,
    records: DataFrame,
    threshold: float = fields.SERVING_THRESHOLD,
    keep: Sequence[str] = (),
    defaults: Mapping[str, float] | None = None,
) -> DataFrame:
    """Prediction, rounded probability, threshold and risk label of each record.

    Decision and label use the unrounded probability.
    """
    scored = model.transform(prepare_records(records, defaults, keep))
    return label_scores(
        scored.select(*keep, scoring.return_probability(F.col("probability")).alias("p")),
        "p",
        threshold,
        keep,
    )


def label_scores(
    df: DataFrame, score: str, threshold: float, keep: Sequence[str] = ()
) -> DataFrame:
    p = F.col(score)
    return df.select(
        *keep,
        scoring.threshold_flag(p, F.lit(threshold)).alias("prediction"),
        scoring.round_score(p).alias("return_probability"),
        F.lit(float(threshold)).alias("threshold"),
        scoring.risk_label(p).alias("risk_label"),
    )

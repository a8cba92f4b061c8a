"""Random forests over the transaction feature layer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import fields
from orderlens.functions.scoring import return_probability
from orderlens.operators import schema
from orderlens.sources import scratch

WEIGHT = "class_weight"
#: What a task should hold of the rows that a forest is grown on, and their size there: the
#: trainer keeps a number for every feature of a row, and a count for every tree.
TASK_BYTES = 64 << 20
_ROW_BYTES, _NUMBER_BYTES = 100, 4


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Categorical and numeric features that ``df`` has; raises when there are none."""
    categorical = schema.present(df, fields.CATEGORICAL_FEATURES)
    numeric = schema.present(df, fields.NUMERIC_FEATURES)
    if not categorical and not numeric:
        raise ValueError("no usable feature columns")
    return categorical, numeric


def string_indexer(columns: Sequence[str]) -> StringIndexer:
    """One indexer for all columns (one job): frequent values first, ties by name."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns],
        outputCols=[f"{c}_ohe" for c in columns],
        handleInvalid="keep",
    )


def assembler(categorical: Sequence[str], numeric: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[f"{c}_ohe" for c in categorical] + list(numeric),
        outputCol="features",
        handleInvalid="keep",
    )


def hasher(categorical: Sequence[str], width: int) -> FeatureHasher:
    return FeatureHasher(
        inputCols=list(categorical), outputCol="categories", numFeatures=width,
        categoricalCols=list(categorical),
    )


def preparation_stages(
    categorical: Sequence[str], numeric: Sequence[str], hash_features: int | None = None
) -> list:
    if hash_features and categorical:
        inputs = ["categories", *numeric]
        return [
            hasher(categorical, hash_features),
            VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"),
        ]
    encoded = [string_indexer(categorical), one_hot_encoder(categorical)] if categorical else []
    return [*encoded, assembler(categorical, numeric)]


def classifier(
    trees: int,
    depth: int,
    weight: str | None = None,
    seed: int = fields.SPLIT_SEED,
    **options,
) -> RandomForestClassifier:
    """The forest of this project over a vector column ``features``."""
    forest = RandomForestClassifier(
        labelCol=fields.LABEL,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        **{"featureSubsetStrategy": "sqrt", **options},
    )
    return forest.setWeightCol(weight) if weight else forest


def train_random_forest(
    train: DataFrame,
    trees: int = fields.FOREST_TREES,
    depth: int = fields.FOREST_DEPTH,
    weight: str | None = None,
    seed: int = fields.SPLIT_SEED,
    hash_features: int | None = None,
    **options,
) -> PipelineModel:
    """Fit preprocessing and forest as one pipeline.

    ``train`` is scanned several times and should be a written layer. Its vectors are made
    once and written in so many files, a task each, that none grows trees on more than
    ``TASK_BYTES``, however densely the layer's own files are packed. Categories are
    one-hot encoded, for which Spark's indexer holds their values on the driver; columns
    of very many values take ``hash_features``, a vector of that width instead, or
    ``dictionary.assemble`` and ``classifier``, which keep values in a table.
    """
    categorical, numeric = feature_columns(train)
    prepared = Pipeline(stages=preparation_stages(categorical, numeric, hash_features)).fit(train)
    forest = classifier(trees, depth, weight, seed, **options)
    spark = train.sparkSession
    # the vectors go once the trees are grown
    with scratch.scope(spark), _task_per_file(spark):
        grown = forest.fit(write_vectors(prepared.transform(train), trees, weight))
    return PipelineModel(stages=[*prepared.stages, grown])


def write_vectors(prepared: DataFrame, trees: int, weight: str | None = None) -> DataFrame:
    """Label, vector and weight of every row, in files of ``TASK_BYTES`` while trees are grown.

    A vector is sparse in files, where a part of usual size holds millions, but not in the
    trainer, which also reads its rows several times.
    """
    width = prepared.schema["features"].metadata["ml_attr"]["num_attrs"]
    rows = max(TASK_BYTES // (_ROW_BYTES + _NUMBER_BYTES * (width + trees)), 1)
    narrow = prepared.select(fields.LABEL, "features", *([weight] if weight else []))
    return scratch.durable(narrow, "vectors", rows_per_file=rows)


@contextmanager
def _task_per_file(spark: SparkSession) -> Iterator[None]:
    """Reads planned inside give every file a task: opening one costs a whole part."""
    setting = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def class_weights(df: DataFrame, label: str = fields.LABEL) -> DataFrame:
    """Balanced weight per class: rows / (classes x rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("classes")))
    total = totals.scalar()
    return counts.withColumn(
        "weight",
        total["n"].cast("double") / (total["classes"].cast("double") * F.col("n")),
    )


def with_class_weight(df: DataFrame, label: str = fields.LABEL) -> DataFrame:
    """Attach each row's class weight; the label must be 0, 1 or null.

    Both class counts come from one aggregate, a scalar subquery of the same plan.
    """
    value = F.col(label)
    ones, zeros = F.count_if(value == 1), F.count_if(value == 0)
    present = F.when(ones > 0, 1).otherwise(0) + F.when(zeros > 0, 1).otherwise(0)
    total = ((ones + zeros) / present).alias("share")
    counts = df.agg(F.struct(total, ones.alias("ones"), zeros.alias("zeros"))).scalar()
    weight = (
        F.when(value.isNull(), F.lit(None).cast("double"))
        .when(value == 1, counts["share"] / counts["ones"])
        .when(value == 0, counts["share"] / counts["zeros"])
        .otherwise(F.raise_error(F.lit(f"{label} must be 0 or 1")).cast("double"))
    )
    return df.withColumn(WEIGHT, weight)


def train_balanced_forest(
    train: DataFrame,
    trees: int = fields.BALANCED_TREES,
    depth: int = fields.BALANCED_DEPTH,
    **options,
) -> PipelineModel:
    """Forest whose classes weigh the same in total, for recall on the rare class."""
    return train_random_forest(with_class_weight(train), trees, depth, weight=WEIGHT, **options)


def batch_predict(model: PipelineModel, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Label, prediction and probability vector of every row."""
    return model.transform(rows).select(*keep, fields.LABEL, "prediction", "probability")


def with_probability(predictions: DataFrame) -> DataFrame:
    """Prediction layer with integer columns and the probability as a number.

    The probability may be a model's vector, or the array that formats without vectors store.
    """
    schema.require_columns(predictions, [fields.LABEL, "prediction", "probability"])
    stored = isinstance(predictions.schema["probability"].dataType, T.ArrayType)
    probability = F.col("probability")
    return predictions.withColumns(
        {
            fields.LABEL: F.col(fields.LABEL).cast("int"),
            "default_prediction": F.col("prediction").cast("int"),
            "return_probability": probability[1] if stored else return_probability(probability),
        }
    ).drop("prediction", "probability")


def feature_importances(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(feature, importance) of the fitted forest; names come from the vector's metadata."""
    attributes = model.transform(rows.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
    values = model.stages[-1].featureImportances.toArray().tolist()
    return rows.sparkSession.createDataFrame(
        [(names[i], value) for i, value in enumerate(values)], "feature string, importance double"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

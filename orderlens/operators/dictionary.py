"""Category dictionaries as tables: indices, one-hot vectors and names without value lists.

Spark's own indexer keeps every value of a column in its model, on the driver. Here values
are counted, ranked (most frequent first, then by value) and numbered by range partitions with
prefix counts, and stay a table. Rows get their index by a join: by broadcast if the values'
measured size allows it, else by a merge join in which frequent values are dealt over tasks.
The driver learns one row of totals a column. Vectors equal those of the indexer and encoder in
``forest``, slot by slot, so a forest fitted on them is the same forest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import ranking
from orderlens.operators.categories import BROADCAST_BYTES, category_frequency
from orderlens.sources import scratch

# besides its text, a broadcast value takes about as many bytes
_ROW_BYTES = 64


@dataclass
class Dictionary:
    """``values``: column, value, n (rows), index (from 0); and per column its totals."""

    values: DataFrame
    sizes: dict[str, int]
    rows: dict[str, int]
    bytes: dict[str, int]

    @property
    def columns(self) -> list[str]:
        return list(self.sizes)


def build(df: DataFrame, columns: Sequence[str]) -> Dictionary:
    """The values of several columns, counted in one pass; null is no value.

    A column without a value has size 0, and every row of it the unseen index.
    """
    frequency = scratch.durable(
        category_frequency(df, columns).where(F.col("value").isNotNull()), "dictionary-counts"
    )
    ranked = ranking.number_rows(
        frequency, ["column"], [F.desc("n"), F.asc("value")], "dictionary-ranks"
    )
    return load(
        scratch.durable(ranked.withColumnRenamed("position", "index"), "dictionary"), columns
    )


def load(values: DataFrame, columns: Sequence[str]) -> Dictionary:
    """A dictionary from its stored table."""
    totals = {
        row["column"]: row
        for row in values.groupBy("column")
        .agg(
            F.count("*").alias("size"),
            F.sum("n").alias("rows"),
            F.sum(F.octet_length("value") + _ROW_BYTES).alias("bytes"),
        )
        .where(F.col("column").isin(list(columns)))
        .collect()
    }

    def of(name: str) -> dict[str, int]:
        return {c: totals[c][name] if c in totals else 0 for c in columns}

    return Dictionary(values, of("size"), of("rows"), of("bytes"))


def encode(
    df: DataFrame, dictionary: Dictionary, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Adds ``<column>_idx`` for each column of the dictionary, as a double.

    Null and unseen values have the index after the last one. The column's metadata tells
    the number of values, so that encoders need no pass over the rows, but none of the values.
    """
    for column in dictionary.columns:
        values = dictionary.values.where(F.col("column") == column).select(
            F.col("value").alias("value__"), F.col("index").alias("index__"), F.col("n").alias("n__")
        )
        size = dictionary.sizes[column]
        before = df.columns
        if dictionary.bytes[column] <= broadcast_bytes:
            small = F.broadcast(values.drop("n__"))
            met = df.join(small, F.col(f"`{column}`") == F.col("value__"), "left")
        else:
            met = _salted(df, column, values, dictionary.rows[column])
        index = F.coalesce(F.col("index__"), F.lit(size)).cast("double")
        attribute = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": f"{column}_idx"}}
        df = met.select(
            *[F.col(f"`{c}`") for c in before], index.alias(f"{column}_idx", metadata=attribute)
        )
    return df


def _salted(df: DataFrame, column: str, values: DataFrame, rows: int) -> DataFrame:
    """Left merge join in which values on more rows than a task's share are dealt by a salt.

    Fewer values than there are tasks can be that frequent, so their table is broadcast. A
    row's salt is a hash of the row, the same in every run; null meets nothing and is
    dealt over all tasks.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1.0, rows / parts)
    value = F.col(f"`{column}`")
    salts = F.greatest(F.ceil(F.col("n__") / share).cast("int"), F.lit(1))
    hot = values.where(F.col("n__") > share).select(
        F.col("value__").alias("hot__"), salts.alias("salts__")
    )
    dealt = F.when(value.isNull(), parts).otherwise(F.coalesce("salts__", F.lit(1)))
    salted = df.join(F.broadcast(hot), value == F.col("hot__"), "left").withColumn(
        "salt__", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), dealt).cast("int")
    )
    copies = values.select(
        "value__", "index__", F.explode(F.sequence(F.lit(0), salts - 1)).alias("copy__")
    ).hint("merge")
    return salted.join(
        copies, (value == F.col("value__")) & (F.col("salt__") == F.col("copy__")), "left"
    )


def one_hot(encoded: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Adds ``<column>_ohe``: a sparse vector of a slot a value and a last one for unseen values."""
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in dictionary.columns],
        outputCols=[f"{c}_ohe" for c in dictionary.columns],
        handleInvalid="keep",
    )
    return encoder.fit(encoded).transform(encoded)


def assemble(
    df: DataFrame,
    dictionary: Dictionary,
    numeric: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``features``: the one-hot vectors of all columns, then the numbers; null is NaN."""
    encoded = one_hot(encode(df, dictionary, broadcast_bytes), dictionary)
    vectors = [f"{c}_ohe" for c in dictionary.columns]
    assembler = VectorAssembler(
        inputCols=[*vectors, *numeric], outputCol="features", handleInvalid="keep"
    )
    helpers = [f"{c}_{kind}" for c in dictionary.columns for kind in ("idx", "ohe")]
    return assembler.transform(encoded).drop(*helpers)


def feature_names(dictionary: Dictionary, numeric: Sequence[str] = ()) -> DataFrame:
    """(slot, feature) of the assembled vector, as a table: values, unseen slots, numbers.

    Names are those that the indexer's metadata would give, ``column_ohe_value``.
    """
    spark = dictionary.values.sparkSession
    starts, at = [], 0
    for column, size in dictionary.sizes.items():
        starts.append((column, at, size))
        at += size + 1
    offsets = spark.createDataFrame(starts, "column string, start long, size long")
    seen = dictionary.values.join(F.broadcast(offsets), "column").select(
        (F.col("start") + F.col("index")).alias("slot"),
        F.concat("column", F.lit("_ohe_"), "value").alias("feature"),
    )
    unseen = offsets.select(
        (F.col("start") + F.col("size")).alias("slot"),
        F.concat("column", F.lit("_ohe___unknown")).alias("feature"),
    )
    numbers = spark.createDataFrame(
        [(at + i, name) for i, name in enumerate(numeric)], "slot long, feature string"
    )
    return seen.unionByName(unseen).unionByName(numbers)

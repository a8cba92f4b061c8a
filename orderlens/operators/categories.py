"""Categorical columns: frequencies, rare-value capping, vocabularies, one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import fields
from orderlens.operators.schema import present
from orderlens.sources import scratch

# a value table is broadcast only when its measured size is below this
BROADCAST_BYTES = 64 << 20
# a table gets at most so many columns from its values
MAX_COLUMNS = 10_000
# per-row overhead assumed for a broadcast value besides its text
_ROW_BYTES = 64


def category_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column as (column, value, n), in one pass over ``df``."""
    return df.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(
        F.count("*").alias("n")
    )


def cap_rare_categories(
    df: DataFrame,
    columns: Sequence[str] = fields.CAPPED_FEATURES,
    min_count: int = fields.RARE_MIN_COUNT,
    other: str = fields.RARE_LABEL,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Recode values on fewer than ``min_count`` rows to ``other``; null stays null.

    The frequencies of all columns are counted once and written. Per column only the
    values that stay are looked up, by broadcast where their measured size allows it.
    Otherwise rows and values are shuffled; a value on more rows than a task should get,
    and null, are dealt over several tasks by a salt. ``df`` is read once for the result.
    """
    columns = present(df, columns)
    if not columns:
        return df
    frequency = scratch.durable(category_frequency(df, columns), "frequency")
    kept = frequency.filter(F.col("value").isNotNull() & (F.col("n") >= min_count))
    totals = {
        row["column"]: row
        for row in frequency.groupBy("column")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(
                F.when(
                    F.col("value").isNotNull() & (F.col("n") >= min_count),
                    F.octet_length("value") + _ROW_BYTES,
                )
            ).alias("kept_bytes"),
        )
        .collect()
    }
    shuffle_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for column in columns:
        if column not in totals:  # no rows at all
            continue
        values = kept.filter(F.col("column") == column).select(
            F.col("value").alias(f"{column}_kept"), "n"
        )
        if (totals[column]["kept_bytes"] or 0) <= broadcast_bytes:
            df = _recode(df, column, F.broadcast(values.drop("n")), other)
        else:
            df = _recode_salted(
                df, column, values, other, totals[column]["rows"] / shuffle_parts, shuffle_parts
            )
    return df


def _recode_salted(
    df: DataFrame, column: str, kept: DataFrame, other: str, share: float, parts: int
) -> DataFrame:
    """Recode by a shuffled join; ``share``: rows that one task should get.

    Fewer than ``parts`` values can be on more rows than that, whatever the data, so their
    table is broadcast. A row's salt is a hash of the row, the same in every run.
    """
    value, found = F.col(column), F.col(f"{column}_kept")
    salts = F.ceil(F.col("n") / share).cast("int")
    hot = kept.where(F.col("n") > share).select(found.alias("hot__"), salts.alias("salts__"))
    salted = df.join(F.broadcast(hot), value == F.col("hot__"), "left").withColumn(
        "salt__",
        F.pmod(
            F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
            F.when(value.isNull(), parts).otherwise(F.coalesce("salts__", F.lit(1))),
        ).cast("int"),
    )
    repeated = kept.select(
        found, F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)).alias("salt_kept__")
    ).hint("merge")
    recoded = F.when(value.isNotNull() & found.isNull(), other).otherwise(value)
    return (
        salted.join(repeated, (value == found) & (F.col("salt__") == F.col("salt_kept__")), "left")
        .withColumn(column, recoded)
        .select(*df.columns)
    )


def _recode(df: DataFrame, column: str, kept: DataFrame, other: str) -> DataFrame:
    value, found = F.col(column), F.col(f"{column}_kept")
    recoded = F.when(value.isNotNull() & found.isNull(), other).otherwise(value)
    return (
        df.join(kept, value == found, "left").withColumn(column, recoded).select(*df.columns)
    )


def vocabularies(
    df: DataFrame, columns: Sequence[str], max_values: int = MAX_COLUMNS
) -> dict[str, list[str]]:
    """Sorted distinct non-null values of each column, counted in one pass.

    Columns with more than ``max_values`` values together raise before any value is
    brought to the driver.
    """
    values = scratch.durable(
        category_frequency(df, columns).where(F.col("value").isNotNull()).select("column", "value"),
        "vocabulary",
    )
    n = values.count()
    if n > max_values:
        raise ValueError(
            f"{', '.join(columns)} have {n} values, more than {max_values}; "
            "dictionary.one_hot gives vectors without a column for each"
        )
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in values.collect():
        found[row["column"]].append(row["value"])
    return {c: sorted(v) for c, v in found.items()}


def one_hot_columns(
    df: DataFrame, columns: Sequence[str], max_values: int = MAX_COLUMNS
) -> DataFrame:
    """Replace each column by 0/1 columns named ``column_value``; null is 0 everywhere.

    One column per value is what the caller asks for here, and a table's columns are known to
    the driver, so their number is bounded; ``dictionary.one_hot`` gives a vector of any width.
    Take the union of both splits as input, so that they share their columns.
    """
    rest = [c for c in df.columns if c not in set(columns)]
    encoded: dict[str, Column] = {}
    for column, values in vocabularies(df, columns, max_values).items():
        for value in values:
            name = f"{column}_{value}"
            if name in encoded or name in rest:
                raise ValueError(f"two columns would be called {name}")
            encoded[name] = F.when(F.col(column) == value, 1).otherwise(0).alias(name)
    return df.select(*[F.col(f"`{c}`") for c in rest], *encoded.values())


def align_columns(df: DataFrame, trained: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the trained columns as doubles: unknown ones go, missing ones and nulls are 0."""
    have = set(df.columns)
    zero = F.lit(0.0)
    aligned = [
        (F.coalesce(F.col(f"`{c}`").cast("double"), zero) if c in have else zero).alias(c)
        for c in trained
    ]
    return df.select(*keep, *aligned)

"""Column names, presence checks and casts. None of these runs a job but ``require_nonempty``."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import fields


def _rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"columns would share a name: {', '.join(clashes)}")
    return df.toDF(*names)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Header text to identifiers: outer spaces and dots go; space, slash and hyphen become _."""
    table = str.maketrans({" ": "_", "/": "_", "-": "_", ".": None})
    return _rename_all(df, [name.strip().translate(table) for name in df.columns])


def lowercase_columns(df: DataFrame) -> DataFrame:
    return _rename_all(df, [name.lower() for name in df.columns])


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that ``df`` has, in the given order."""
    have = set(df.columns)
    return [name for name in names if name in have]


def map_present(
    df: DataFrame, names: Iterable[str], expression: Callable[[Column], Column]
) -> DataFrame:
    """Rewrite the columns that exist, all in one projection."""
    return df.withColumns({name: expression(F.col(name)) for name in present(df, names)})


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def require_nonempty(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise when there is no row; looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename: source name -> new name."""
    return df.select([F.col(source).alias(target) for source, target in names.items()])


def constant_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def drop_leakage(df: DataFrame, columns: Sequence[str] = fields.LEAKAGE_COLUMNS) -> DataFrame:
    """Drop identifiers and columns known only after the outcome; absent names are fine."""
    return df.drop(*columns)


def cast_feature_types(
    df: DataFrame,
    numeric: Sequence[str] = fields.NUMERIC_FEATURES,
    categorical: Sequence[str] = fields.CATEGORICAL_FEATURES,
    label: str = fields.LABEL,
) -> DataFrame:
    """Numerics to double, categories to string, label to int, where present."""
    types = (
        dict.fromkeys(present(df, numeric), "double")
        | dict.fromkeys(present(df, categorical), "string")
        | dict.fromkeys(present(df, [label]), "int")
    )
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})

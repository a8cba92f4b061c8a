"""Fingerprint of a table: its rows as a multiset, whatever their order and files.

Every row gets two 64-bit hashes of different seeds, over its columns by name and which of them
are null. Their sums and the number of rows are the fingerprint, one aggregate that combines
before any shuffle. A changed, lost or doubled row changes the sums but for a chance of 2 ** -128.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEEDS = {"sum_a": 0, "sum_b": 1_000_003}
# a hash is added up in three parts of so many bits, as longs, which 2 ** 42 rows do not overflow
_PART_BITS = 21
ROWS = "rows"
Fingerprint = Mapping[str, str]


def _row_hash(df: DataFrame, seed: int) -> Column:
    parts: list[Column] = [F.lit(seed)]
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        value = F.col(f"`{field.name}`")
        # maps have no hash
        parts.append(F.to_json(value) if "map<" in field.dataType.simpleString() else value)
        parts.append(value.isNull())
    return F.xxhash64(*parts)


def _hash_sum(value: Column) -> Column:
    """Exact sum of 64-bit numbers, 0 without rows. Adding decimals costs more than the hash."""
    mask = F.lit((1 << _PART_BITS) - 1)
    low = value.bitwiseAND(mask)
    middle = F.shiftright(value, _PART_BITS).bitwiseAND(mask)
    high = F.shiftright(value, 2 * _PART_BITS)
    sums = [F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") for part in (low, middle, high)]
    scales = [F.lit(1 << i * _PART_BITS).cast("decimal(14,0)") for i in range(3)]
    return sums[0] * scales[0] + sums[1] * scales[1] + sums[2] * scales[2]


def aggregates(df: DataFrame) -> list[Column]:
    """Aggregates that make up the fingerprint, by its keys."""
    sums = [
        _hash_sum(_row_hash(df, seed)).cast("string").alias(name) for name, seed in _SEEDS.items()
    ]
    return [F.count(F.lit(1)).cast("string").alias(ROWS), *sums]


def equals(stored: Fingerprint) -> Column:
    """Whether columns named like the aggregates hold a stored fingerprint."""
    same = F.lit(True)
    for name in (ROWS, *_SEEDS):
        same = same & (F.col(name) == F.lit(stored[name]))
    return same


def of(df: DataFrame) -> dict[str, str]:
    return df.agg(*aggregates(df)).first().asDict()

"""Exact ``ntile`` over a whole table, without a whole-table window.

``ntile(k)`` without PARTITION BY sends every row to one task. Only the k - 1 rows on
the tile borders matter, though: a row's tile is one more than the number of border
rows that it follows. The border rows are found by range-partitioning narrow
(value, key) rows, counting them per partition and ranking inside the few partitions
that hold a border. The wide rows are never shuffled; they are compared with
at most k - 1 literals per measure.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.sources import scratch

NULLS_FIRST, NULLS_LAST = "first", "last"


def ntile_columns(
    df: DataFrame,
    key: str,
    measures: Mapping[str, tuple[str, str]],
    tiles: int,
) -> DataFrame:
    """Add one ntile column per measure: new name -> (column, nulls "first" or "last").

    Ascending, ties broken by ``key``, which must be unique. ``df`` is read several
    times, so it must be a written table that gives the same rows each time.
    """
    borders = _border_rows(df, key, measures, tiles)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            name: _tile(
                _position(column, nulls, key),
                [
                    F.struct(
                        F.lit(blank).alias("blank"),
                        F.lit(value).cast("double").alias("value"),
                        F.lit(row_key).cast(types[key]).alias("key"),
                    )
                    for blank, value, row_key in borders.get(name, [])
                ],
            )
            for name, (column, nulls) in measures.items()
        }
    )


def _position(column: str, nulls: str, key: str) -> Column:
    """Sort position as one comparable struct; struct order puts null fields first."""
    blank = F.col(column).isNull() if nulls == NULLS_LAST else F.col(column).isNotNull()
    return F.struct(
        blank.alias("blank"),
        F.col(column).cast("double").alias("value"),
        F.col(key).alias("key"),
    )


def _tile(position: Column, borders: list[Column]) -> Column:
    tile = F.lit(1)
    for border in borders:
        tile = tile + F.when(position > border, 1).otherwise(0)
    return tile


def border_ranks(n: int, tiles: int) -> list[int]:
    """Ranks (from 1) of the last rows of tiles 1 .. tiles - 1; longer tiles come first."""
    size, longer = divmod(n, tiles)
    sizes = [size + (tile < longer) for tile in range(tiles - 1)]
    return [rank for rank in accumulate(sizes) if rank > 0]


def _border_rows(
    df: DataFrame, key: str, measures: Mapping[str, tuple[str, str]], tiles: int
) -> dict[str, list[tuple]]:
    """Sort positions on the tile borders of each measure, in order."""
    # one narrow row per measure and input row, all ranked by the same shuffle
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("measure"), _position(column, nulls, key).alias("at"))
                    for name, (column, nulls) in measures.items()
                ]
            )
        ).alias("m")
    ).select("m.measure", "m.at.*")
    found = rows_at_ranks(long, ["blank", "value", "key"], lambda n: border_ranks(n, tiles))
    return {
        measure: [(row["blank"], row["value"], row["key"]) for row in rows]
        for measure, rows in found.items()
    }


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list:
    """Exact quantiles: the least value that at least that share of the values does not exceed.

    Nulls do not count; without values every quantile is null.
    """
    long = df.select(F.lit(column).alias("measure"), F.col(column).alias("value")).dropna()
    found = rows_at_ranks(
        long, ["value"], lambda n: [max(1, math.ceil(Fraction(str(s)) * n)) for s in shares]
    )
    return [row["value"] for row in found.get(column, [])] or [None] * len(shares)


def rows_at_ranks(
    long: DataFrame, by: Sequence[str], ranks: Callable[[int], list[int]]
) -> dict[str, list[Row]]:
    """Per measure, its rows at some ranks (from 1) in the order of ``by``.

    ``long`` has a column ``measure`` and those of ``by``; ``ranks`` gets a measure's
    number of rows. Equal rows may stand in any order, since they look the same.
    """
    order = ["measure", *by]
    # Range bounds are sampled, so the partitioned rows are written before they are
    # read twice. A part is a folder: later reads prune to the parts they need.
    ranged = scratch.durable(
        long.repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
        "ranges",
        partition_by="part",
    )
    sizes = ranged.groupBy("measure", "part").count().orderBy("measure", "part").collect()

    wanted = []  # (measure, part, rank inside the part)
    for measure in dict.fromkeys(row["measure"] for row in sizes):
        parts = [(row["part"], row["count"]) for row in sizes if row["measure"] == measure]
        ends = list(accumulate(n for _, n in parts))
        for rank in ranks(ends[-1]):
            at = next(i for i, end in enumerate(ends) if end >= rank)
            wanted.append((measure, parts[at][0], rank - (ends[at] - parts[at][1])))
    if not wanted:
        return {}

    inside = Window.partitionBy("measure", "part").orderBy(*by)
    is_border = [
        (F.col("measure") == measure) & (F.col("part") == part) & (F.col("rank") == rank)
        for measure, part, rank in sorted(set(wanted))
    ]
    rows = (
        ranged.filter(F.col("part").isin(sorted({part for _, part, _ in wanted})))
        .withColumn("rank", F.row_number().over(inside))
        .filter(_any(is_border))
        .collect()
    )
    found = {(row["measure"], row["part"], row["rank"]): row for row in rows}
    result: dict[str, list[Row]] = {}
    for target in wanted:
        result.setdefault(target[0], []).append(found[target])
    return result


def _any(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in a total order.

    Spark keeps only each task's first rows before the shuffle (a window group limit),
    so a large group does not travel.
    """
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rn") == 1).drop("rn")


# a monotonically increasing id holds the number of its task above these bits
_PART_BITS = 33


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Adds ``position``: a row's place in its group from 0, in a total order of its rows.

    No window holds a group, which may be most of the table: rows are range partitioned by
    group and order and written in that order, so a row knows its place within its part, and
    only the number of rows per part and group, a narrow table, is summed. Groups may be
    null. Rows equal in the order keep the places they are written with.
    """
    groups = [F.col(g) for g in group]
    written = scratch.durable(
        df.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("at__", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("at__", _PART_BITS)
    runs = written.groupBy(part.alias("part__"), *group).agg(
        F.min("at__").alias("first__"), F.count("*").alias("n__")
    )
    earlier = F.sum("n__").over(Window.partitionBy(*group).orderBy("part__")) - F.col("n__")
    runs = runs.select(
        F.col("part__").alias("run_part__"),
        *[F.col(g).alias(f"run_{g}__") for g in group],
        (earlier - F.col("first__")).alias("shift__"),
    )
    same = part == F.col("run_part__")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"run_{g}__"))
    return written.join(runs, same).select(
        *df.columns, (F.col("at__") + F.col("shift__")).alias("position")
    )

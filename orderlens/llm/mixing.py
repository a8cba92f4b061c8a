"""Mixing sources to target weights by Pfair scheduling.

The rows of a source form blocks of ``block_rows``; one slot of the mixture takes one block.
Slots come in cycles. How many blocks of each source the slots before a cycle hold follows
from its number alone: the sources are the leaves of a tree, and at every node the slots so
far are split between two sides by their exact weights, rounded down on one. Sides hold at
most two thirds of their node unless they are single sources, so a source is less than four
blocks away from its share at each border, however many cycles came before. Within a cycle
of M slots block j of a source's m is released at slot floor(j * M / m) and due by slot
ceil((j + 1) * M / m), and every slot takes the released block that is due earliest. All meet
their deadlines.

A source that runs out leaves its slots to the others, whose weights keep their
proportions; once half of the weight has run out, the tree is made again for the rest, so
the cycles are never many more than the blocks need. Cycles are counted and scheduled in
tasks, each by itself. No row is dropped or repeated.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources import scratch

#: Slots of a cycle, of which sources that ran out leave some.
CYCLE = 1000
BLOCK_ROWS = 64
#: Scheduled slots up to which the schedule is broadcast; beyond, it is joined.
BROADCAST_SLOTS = 500_000
#: A source that needs more slots than this is left to the next epochs.
MOST_SLOTS = 1 << 50
#: Rows that are numbered in one group, on average.
GROUP_ROWS = 4096


def source_weights(
    sizes: DataFrame,
    targets: Mapping[str, float] | None = None,
    rest: float = 1.0,
    temperature: float = 0.7,
) -> DataFrame:
    """Adds ``weight`` to a table of ``source`` and its ``rows``.

    Without targets, rows ** temperature: small sources are raised, order by size stays.
    With targets, a source that is not named gets ``rest``.
    """
    if targets is None:
        return sizes.withColumn("weight", F.pow(F.col("rows").cast("double"), temperature))
    if not targets or min(*targets.values(), rest) <= 0:
        raise ValueError("weights must be above 0")
    given = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    weight = F.coalesce(F.try_element_at(given, F.col("source")), F.lit(rest))
    return sizes.withColumn("weight", weight.cast("double"))


def tree_paths(weights: Sequence[float]) -> list[list[tuple[bool, float]]]:
    """For each weight, its way from the root: which side, and the first side's share."""
    order = sorted(range(len(weights)), key=lambda i: -weights[i])
    upto = [0.0, *accumulate(weights[i] for i in order)]
    paths: list[list[tuple[bool, float]]] = [[] for _ in weights]
    nodes = [(0, len(order))]
    while nodes:
        start, end = nodes.pop()
        if end - start < 2:
            continue
        half = (upto[start] + upto[end]) / 2
        cut = min(max(bisect_left(upto, half, start, end), start + 1), end - 1)
        if cut - 1 > start and half - upto[cut - 1] <= upto[cut] - half:
            cut -= 1
        share = (upto[cut] - upto[start]) / (upto[end] - upto[start])
        for k in range(start, end):
            paths[order[k]].append((k < cut, share))
        nodes += [(start, cut), (cut, end)]
    return paths


def blocks_before(path: Sequence[tuple[bool, float]], slots: int) -> int:
    """Blocks of a source in the first ``slots`` slots, while all sources last."""
    for first, share in path:
        part = int(slots * share)
        slots = part if first else slots - part
    return slots


def _blocks_before(path: Column, slots: Column) -> Column:
    """The same of a column."""

    def step(n, side):
        part = F.floor(n * side["share"]).cast("long")
        return F.when(side["first"], part).otherwise(n - part)

    return F.aggregate(path, slots.cast("long"), step)


def epochs(sources: Sequence[tuple[str, int, float]], cycle: int) -> list[tuple]:
    """(slots before an epoch, its cycles, key, path, blocks before it, blocks left) by source.

    ``sources``: key, blocks and weight. An epoch ends with the cycle in which half of its
    weight has run out.
    """
    left = {key: blocks for key, blocks, _ in sources if blocks}
    total = dict(left)
    weight = {key: w for key, _, w in sources}
    out, base = [], 0
    while left:
        keys = sorted(left, key=lambda k: (-weight[k], -total[k], k))
        paths = tree_paths([weight[k] for k in keys])
        ends = []
        for key, path in zip(keys, paths, strict=True):
            high = 1
            while blocks_before(path, high * cycle) < left[key] and high * cycle < MOST_SLOTS:
                high *= 2
            ends.append(1 + bisect_left(range(1, high), left[key], key=lambda c: blocks_before(path, c * cycle)))
        gone, half = 0.0, sum(weight[k] for k in keys) / 2
        for n, k in sorted(zip(ends, keys, strict=True)):
            cycles = n
            gone += weight[k]
            if gone >= half:
                break
        used = 0
        for key, path in zip(keys, paths, strict=True):
            out.append((base, cycles, key, path, total[key] - left[key], left[key]))
            taken = min(left[key], blocks_before(path, cycles * cycle))
            left[key] -= taken
            used += taken
        base += used
        left = {k: n for k, n in left.items() if n}
    return out


def schedule(weights: DataFrame, cycle: int, block_rows: int) -> DataFrame:
    """``key``, ``block`` and ``slot`` of every block of a table of ``key``, ``rows``, ``weight``."""
    parts = weights.select("key", F.ceil(F.col("rows") / block_rows).cast("long"), "weight")
    made = epochs([tuple(r) for r in parts.collect()], cycle)  # one row per source
    if not made:
        return weights.sparkSession.createDataFrame([], "key string, block long, slot long")
    table = weights.sparkSession.createDataFrame(
        made,
        "base long, cycles long, key string,"
        " path array<struct<first:boolean,share:double>>, before long, left long",
    )
    upto = lambda c: F.least("left", _blocks_before(F.col("path"), c * cycle))
    counted = (
        table.withColumn("cycle", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cycles") - 1)))
        .withColumn("start", upto(F.col("cycle")))
        .withColumn("m", upto(F.col("cycle") + 1) - F.col("start"))
    )
    has = F.when(F.col("m") > 0, F.struct("key", "m", (F.col("before") + F.col("start")).alias("from")))
    cycles = (
        counted.groupBy("base", "cycle")
        .agg(
            (F.col("base") + F.sum("start")).alias("begin"),
            F.sum("m").alias("slots"),
            F.sort_array(F.collect_list(has)).alias("s"),
        )
        .where("slots > 0")
        .withColumn("order", earliest_deadline_first(F.transform("s", lambda x: x["m"]), F.col("slots")))
    )
    placed = cycles.select("begin", "s", F.posexplode("order").alias("place", "who")).withColumn(
        "x", F.get("s", F.col("who"))
    )
    turn = Window.partitionBy("begin", "who").orderBy("place")
    return placed.select(
        F.col("x.key").alias("key"),
        (F.col("x.from") + F.row_number().over(turn) - 1).cast("long").alias("block"),
        (F.col("begin") + F.col("place")).cast("long").alias("slot"),
    )


def earliest_deadline_first(counts: Column, slots: Column) -> Column:
    """For each of ``slots`` slots, the index of the source that has it.

    ``counts``: blocks of each source; they add up to ``slots``.
    """
    never = F.lit(2**62)

    def step(state, t):
        due = F.zip_with(
            counts,
            state["done"],
            lambda m, d: F.when(
                (m > d) & (F.floor(d * slots / F.greatest(m, F.lit(1))) <= t),
                F.ceil((d + 1) * slots / F.greatest(m, F.lit(1))),
            ).otherwise(never),
        )
        chosen = F.transform(
            F.array(due), lambda d: (F.array_position(d, F.array_min(d)) - 1).cast("int")
        )
        return F.transform(
            chosen,
            lambda c: F.struct(
                F.transform(
                    state["done"], lambda d, k: d + F.when(k == c, F.lit(1)).otherwise(0)
                ).alias("done"),
                F.concat(state["order"], F.array(c)).alias("order"),
            ),
        )[0]

    start = F.struct(
        F.transform(counts, lambda m: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<int>").alias("order"),
    )
    every = F.sequence(F.lit(0).cast("long"), slots - 1)
    return F.aggregate(every, start, step, lambda s: s["order"])


def mix(
    df: DataFrame,
    source_col: str = "source",
    order_cols: Sequence[str] = ("doc_id",),
    targets: Mapping[str, float] | None = None,
    rest: float = 1.0,
    temperature: float = 0.7,
    block_rows: int = BLOCK_ROWS,
    cycle: int = CYCLE,
) -> DataFrame:
    """``df`` with ``mix_block`` (of its source), ``mix_slot`` and ``mix_position``.

    Positions rise along the mixture; a source's last block may be short, so some positions
    stay free. Rows of a source come in the order of a hash of ``order_cols``, then of the
    columns themselves; repeated rows stay, next to each other. A null source is a source of
    its own. ``df`` must not have columns of the three names. An empty table gives an empty
    result. Rows are numbered in groups of a source by hash, so that a source of any
    size spreads over many tasks.
    """
    made = ("mix_block", "mix_slot", "mix_position")
    if clash := {c for c in df.columns if c in made or c.endswith("__")}:
        raise ValueError(f"columns clash with the mixture's: {sorted(clash)}")
    columns = df.columns
    source = F.col(f"`{source_col}`").cast("string")
    ordered = [F.col(f"`{c}`") for c in order_cols]
    keyed = df.withColumn(
        "key__", F.when(source.isNull(), "n").otherwise(F.concat(F.lit("v"), source))
    ).withColumn("hash__", F.xxhash64(*ordered))
    counted = keyed.select("key__", "hash__")
    total = counted.count()
    groups = max(1, -(-total // GROUP_ROWS))
    group = F.pmod("hash__", F.lit(groups)).cast("int")
    sizes = scratch.durable(
        counted.groupBy("key__", group.alias("group__")).count(), "mix-sizes"
    )
    before = Window.partitionBy("key__").orderBy("group__").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "key__", "group__", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset__")
    )
    by_source = sizes.groupBy(F.col("key__").alias("key")).agg(F.sum("count").alias("rows"))
    named = by_source.withColumn(
        "source", F.when(F.col("key") != "n", F.substring("key", 2, 1 << 30))
    )
    weights = source_weights(named, targets, rest, temperature)
    scheduled = scratch.durable(schedule(weights, cycle, block_rows), "mix-schedule")
    slots = scheduled.count()
    places = scheduled.select(
        F.col("key").alias("key__"),
        F.col("block").alias("mix_block"),
        F.col("slot").alias("mix_slot"),
    )
    within = Window.partitionBy("key__", "group__").orderBy("hash__", *ordered)
    numbered = (
        keyed.withColumn("group__", group)
        .withColumn("rank__", F.row_number().over(within) - 1)
        .join(offsets, ["key__", "group__"])
        .withColumn("rank__", F.col("rank__") + F.col("offset__"))
        .withColumn("mix_block", F.floor(F.col("rank__") / block_rows).cast("long"))
        .join(
            F.broadcast(places) if slots <= BROADCAST_SLOTS else places, ["key__", "mix_block"]
        )
    )
    return (
        numbered
        .withColumn(
            "mix_position",
            F.col("mix_slot") * block_rows + (F.col("rank__") % block_rows),
        )
        .select(*[F.col(f"`{c}`") for c in columns], *made)
    )

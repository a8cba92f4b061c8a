"""Merkle manifest of a dataset: a tree of digests per group, and one over the groups' roots.

Rows get digests (leaves), which stand in order of a key within their group. Every ``FANOUT``
consecutive nodes become the digest of their concatenated digests until one node is left, the
group's subroot; subroots, in order of the group, become the root in the same way. Whoever holds
the root can check one row with its proof, the siblings on its way up.

The levels are made by a slot pivot. A node at position p is the child of node p div FANOUT in
slot p mod FANOUT, and conditional aggregates spread the children of a node into FANOUT columns.
Their concatenation is what the node's digest is taken of, and leaving out a child's own column
gives its siblings. A level has a third of the rows of the level below, so all levels together
take half as many rows as the leaves. Proofs are handed down: a node's path is joined to its
children as one row, so the leaves meet their paths at a third of their number.

Positions need no window over a group, which may hold most rows: rows are range partitioned by
group and key, numbered within each part, and the numbers of rows per part and group are summed.
Nodes are dealt by (tree, parent), so a large group spreads over all tasks. Nothing but the
height of the trees, the number of groups and the root reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources import scratch

FANOUT = 3
_PATH = "array<struct<before:string,after:string>>"
# monotonically increasing ids hold the number of the task above these bits
_PART_BITS = 33


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the values' concatenated text."""
    return F.sha2(F.concat(*values), 256)


def leaf(*values: Column) -> Column:
    """Digest of a row: every value as its UTF-8 length, a colon and its text; ``-`` for null."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[framed(v) for v in values])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["before"], node, s["after"]))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf's level up, left to right."""
    return F.sha2(
        F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256
    )


@dataclass
class Manifest:
    """The trees of a table.

    ``leaves``: row (the row given, as a struct), leaf, tree (number of its group), position,
    subroot and path. ``nodes``: tree, level, position and digest of all nodes of the groups'
    trees, leaves being level 0. ``root``: the digest of all, None for an empty table.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _positions(rows: DataFrame) -> DataFrame:
    """Adds ``tree`` (rank of the group, null first), ``position`` and ``width`` of the tree.

    ``rows``: row, group, key, leaf. Equal rows may stand in any order, since they look the
    same. The rows are written.
    """
    order = ["group", "key", "leaf"]
    ranked = scratch.durable(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "merkle-leaves",
    )
    part = F.shiftright("at", _PART_BITS).alias("part")
    runs = ranked.groupBy(part, "group").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # a group has at most one run a part, and a part at most one run a row
    of_group = Window.partitionBy("group").orderBy("part")
    runs = runs.select(
        "part",
        "group",
        "first",
        (F.sum("n").over(of_group) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("group")).alias("width"),
        F.when(F.row_number().over(of_group) == 1, 1).otherwise(0).alias("opens"),
    )
    in_part = Window.partitionBy("part").orderBy("first")
    runs = scratch.durable(runs.withColumn("opened", F.sum("opens").over(in_part)), "merkle-runs")
    parts = runs.groupBy("part").agg(F.sum("opens").alias("n"))
    # one row a part of the shuffle, whatever the table's size
    earlier = parts.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier")
    )
    # a run that opens no group goes on with the last group opened before its part
    runs = runs.join(earlier, "part").select(
        F.col("part").alias("run_part"),
        F.col("group").alias("run_group"),
        "first",
        "before",
        "width",
        (F.col("earlier") + F.col("opened") - 1).alias("tree"),
    )
    same = (F.col("part") == F.col("run_part")) & F.col("group").eqNullSafe(F.col("run_group"))
    return ranked.withColumn("part", part).join(runs, same).select(
        "row",
        "tree",
        (F.col("before") + F.col("at") - F.col("first")).alias("position"),
        "width",
        F.col("leaf").alias("digest"),
    )


def _children() -> list[str]:
    return [f"child_{slot}" for slot in range(FANOUT)]


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """Per level its parents: tree, parent, width of the level, children by slot, digest.

    ``nodes``: tree, position, width, digest of the lowest level. Trees of one node have none.
    """
    widest = nodes.agg(F.max("width")).first()[0] or 0
    levels = []
    while widest > 1:
        slot = F.pmod("position", F.lit(FANOUT))
        children = [
            F.max(F.when(slot == i, F.col("digest"))).alias(name)
            for i, name in enumerate(_children())
        ]
        pivot = (
            nodes.where("width > 1")
            .groupBy("tree", F.expr(f"position div {FANOUT}").alias("parent"), "width")
            .agg(*children)
            .withColumn("digest", F.sha2(F.concat_ws("", *_children()), 256))
        )
        levels.append(scratch.durable(pivot, "merkle-level"))
        nodes = _parents(levels[-1])
        widest = -(-widest // FANOUT)
    return levels


def _parents(level: DataFrame) -> DataFrame:
    width = F.expr(f"(width + {FANOUT - 1}) div {FANOUT}").alias("width")
    return level.select("tree", F.col("parent").alias("position"), width, "digest")


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> list[DataFrame]:
    """Per height the trees that end there, with their last digest."""
    all_levels = [nodes, *[_parents(level) for level in levels]]
    return [level.where("width = 1").select("tree", "digest") for level in all_levels]


def _beside(children: list[str]) -> Column:
    """The concatenated digests of some slots; slots of a last, shorter run are empty."""
    return F.concat_ws("", *children) if children else F.lit("")


def _step(slot: int) -> Column:
    names = _children()
    return F.struct(
        _beside(names[:slot]).alias("before"), _beside(names[slot + 1 :]).alias("after")
    )


def _with_paths(
    leaves: DataFrame, levels: list[DataFrame], tops: list[DataFrame], carried: list[str]
) -> DataFrame:
    """Leaves (tree, position and others) with their path up, and what ``tops`` carry.

    ``tops``: per height, the trees that end there: tree, path above the tree, ``carried``.
    """

    def of_height(height: int) -> DataFrame:
        return tops[height].select("tree", F.lit(0).cast("long").alias("position"), "path", *carried)

    above = of_height(len(levels))
    for height in range(len(levels) - 1, 0, -1):
        met = _met(levels[height], above)
        steps = F.array(
            *[
                F.when(
                    F.col(name).isNotNull(),
                    F.struct(
                        (F.col("parent") * FANOUT + slot).alias("position"),
                        F.concat(F.array(_step(slot)), "path").alias("path"),
                    ),
                )
                for slot, name in enumerate(_children())
            ]
        )
        handed = met.select("tree", F.explode(F.array_compact(steps)).alias("c"), *carried)
        above = handed.select("tree", "c.position", "c.path", *carried).unionByName(
            of_height(height)
        )
    alone = leaves.where("width = 1").join(
        tops[0].select("tree", "path", *carried), "tree"
    )
    if not levels:
        return alone
    met = _met(levels[0], above).select(
        "tree", "parent", F.array(*[_step(i) for i in range(FANOUT)]).alias("steps"), "path", *carried
    )
    slot = F.pmod("position", F.lit(FANOUT)).cast("int")
    many = (
        leaves.where("width > 1")
        .withColumn("parent", F.expr(f"position div {FANOUT}"))
        .join(met, ["tree", "parent"])
        .withColumn("path", F.concat(F.array(F.col("steps")[slot]), "path"))
    )
    columns = [*leaves.columns, "path", *carried]
    return many.select(*columns).unionByName(alone.select(*columns))


def _met(level: DataFrame, above: DataFrame) -> DataFrame:
    """Parents of a level with their own paths."""
    return level.select("tree", "parent", *_children()).join(
        above.withColumnRenamed("position", "parent"), ["tree", "parent"]
    )


def manifest(rows: DataFrame, leaf: Column, group: str, order: list[str]) -> Manifest:
    """Trees over ``rows``, whose digests are ``leaf``, one for each value of ``group``.

    Groups come in order, null first. ``order``: columns that put the rows of a group in order,
    null first; rows equal in them come in order of their leaf. Repeated rows are leaves of
    their own. Columns of any name may be among the rows', since a row travels as one struct;
    select before what shall travel. An empty table has no root.
    """
    leaves = _positions(
        rows.select(
            F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
            F.col(f"`{group}`").alias("group"),
            F.struct(*[F.col(f"`{c}`") for c in order]).alias("key"),
            leaf.alias("leaf"),
        )
    )
    nodes = leaves.select("tree", "position", "width", "digest")
    levels = _levels(nodes)
    tops = [
        top.withColumn("height", F.lit(height)) for height, top in enumerate(_tops(nodes, levels))
    ]
    subroots = scratch.durable(reduce(DataFrame.unionByName, tops), "merkle-subroots")

    upper = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("position"),
        F.lit(subroots.count()).cast("long").alias("width"),
        "digest",
        "height",
    )
    upper_levels = _levels(upper)
    upper_tops = _tops(upper, upper_levels)
    root = upper_tops[-1].select("digest").first()
    ends = [top.select("tree", F.array().cast(_PATH).alias("path")) for top in upper_tops]
    of_trees = scratch.durable(
        _with_paths(upper, upper_levels, ends, []).select(
            F.col("position").alias("tree"), "path", F.col("digest").alias("subroot"), "height"
        ),
        "merkle-groups",
    )

    inner = [
        level.select("tree", F.lit(i).alias("level"), F.col("parent").alias("position"), "digest")
        for i, level in enumerate(levels, 1)
    ]
    lowest = nodes.select("tree", F.lit(0).alias("level"), "position", "digest")
    ends = [of_trees.where(F.col("height") == h).drop("height") for h in range(len(levels) + 1)]
    found = _with_paths(leaves, levels, ends, ["subroot"])
    return Manifest(
        found.select("row", F.col("digest").alias("leaf"), "tree", "position", "subroot", "path"),
        reduce(DataFrame.unionByName, inner, lowest),
        root["digest"] if root else None,
    )

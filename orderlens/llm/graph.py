"""Connected components of large graphs."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.sources import scratch

#: Rounds that only pass labels on, before each that also follows the label's label.
PLAIN_ROUNDS = 2


def _contract(batches: Iterator) -> Iterator:
    """The edges of one task as stars: every node with the least node it reaches there."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def root(n: int) -> int:
        top = n
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[n] != top:
            parent[n], n = top, parent[n]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())],
        names=["a", "b"],
    )


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``edges`` (a, b): the least node it reaches.

    Each task first reduces its own edges to stars. Then every round a node hears the labels
    of the neighbours whose label changed in the round before, and takes the least; after some
    rounds also the label of its label, so that long paths take a number of rounds that
    grows with the logarithm of their length. Each round is written and read again. Rounds
    end when no label changes. Nodes are never null.
    """
    stars = scratch.durable(
        edges.select("a", "b").mapInArrow(_contract, "a long, b long").distinct(),
        "component-stars",
    )
    both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    labels = scratch.durable(
        stars.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")),
        "component-labels",
    )
    rounds, changed = 0, labels
    while True:
        heard = both.join(changed.select(F.col("node").alias("b"), "label"), "b").select(
            F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("own")
        )
        told = labels.select("node", "label", F.col("label").alias("own"))
        moved = (
            heard.union(told)
            .groupBy("node")
            .agg(F.min("label").alias("label"), F.min("own").alias("old"))
        )
        rounds += 1
        if rounds % (PLAIN_ROUNDS + 1) == 0:
            above = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
            moved = moved.join(above, "label").select(
                "node", F.least("label", "top").alias("label"), "old"
            )
        moved = scratch.durable(moved, "component-labels")
        labels = moved.select("node", "label")
        changed = moved.where(F.col("label") != F.col("old"))
        if changed.isEmpty():
            return labels

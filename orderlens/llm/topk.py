"""Exact top-k search by inner product: ball trees, branch and bound.

Candidates are dealt over shards of bounded size. A shard builds a ball tree: every node has
a centre and a radius, and for a query q no member scores above ``q.centre + |q| * radius``.
A query visits the leaves of a shard by falling bound and stops where the bound cannot
reach its kth score so far.

The kth score is shared in two rounds. First every shard answers each query from its best
leaf alone; the kth best of those answers, over all shards, is a lower bound of the true
kth score. Then every shard starts from that bound and so prunes whole subtrees before
it has found k rows of its own.

Scores are exact integers: components are whole numbers, and sums that double precision
cannot hold exactly are added up in integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources import scratch

#: Rows of a ball tree and queries of a block: what one task holds at a time.
SHARD_ROWS = 4096
BLOCK_QUERIES = 2048
LEAF_ROWS = 128
#: Doubles hold whole numbers up to this exactly.
_EXACT = 2.0**53


def valid(vector: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)
        ),
    )
    return vector.isNotNull() & (F.size(vector) > 0) & finite


class BallTree:
    """Leaves of nearby vectors with centre and radius; inner nodes bound several leaves."""

    def __init__(self, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.arange(len(vectors))
        self.nodes: list[tuple[np.ndarray, float, int, int, int, int]] = []
        self.order = order
        self.vectors = vectors
        self._split(0, len(vectors), leaf_rows)
        self.vectors = vectors[self.order]
        self.centres = np.array([n[0] for n in self.nodes])
        self.radii = np.array([n[1] for n in self.nodes])

    def _split(self, low: int, high: int, leaf_rows: int) -> int:
        rows = self.vectors[self.order[low:high]]
        centre = rows.mean(axis=0)
        radius = float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
        me = len(self.nodes)
        self.nodes.append((centre, radius, low, high, -1, -1))
        if high - low > leaf_rows and radius > 0:
            far = rows[((rows - centre) ** 2).sum(axis=1).argmax()]
            other = rows[((rows - far) ** 2).sum(axis=1).argmax()]
            along = np.argsort(rows @ (other - far), kind="stable")
            self.order[low:high] = self.order[low:high][along]
            middle = (low + high) // 2
            left = self._split(low, middle, leaf_rows)
            right = self._split(middle, high, leaf_rows)
            self.nodes[me] = (centre, radius, low, high, left, right)
        return me

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, no smaller than any member's score."""
        norms = np.sqrt((queries**2).sum(axis=1))
        bound = queries @ self.centres.T + norms[:, None] * self.radii[None, :]
        return bound + 1e-9 * (1.0 + np.abs(bound))  # rounding must not prune


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * rows.shape[1]
    if largest < _EXACT:
        return np.rint(queries @ rows.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in rows]
    out = np.empty((len(queries), len(rows)), dtype=object)
    for i, q in enumerate(queries):
        q = [int(x) for x in q]
        out[i] = [sum(a * b for a, b in zip(q, row, strict=True)) for row in whole]
    return out


class _Best:
    """The k best (score, id) of each query of a block."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k, self.floor = ids, k, floor
        self.scores: list[np.ndarray] = [np.empty(0, np.int64) for _ in ids]
        self.found: list[np.ndarray] = [np.empty(0, np.int64) for _ in ids]

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: a row for each of the queries ``which``, a column for each of ``ids``."""
        good = scores >= self.floor[which][:, None]
        good &= ids[None, :] != self.ids[which][:, None]
        for row in np.flatnonzero(good.any(axis=1)):
            i, some = which[row], good[row]
            s = np.concatenate([self.scores[i], scores[row][some]])
            d = np.concatenate([self.found[i], ids[some]])
            top = np.lexsort((d, -s))[: self.k]
            self.scores[i], self.found[i] = s[top], d[top]
            if len(top) == self.k:
                self.floor[i] = max(self.floor[i], s[top[-1]])


def search_block(
    tree: BallTree,
    ids: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    floor: np.ndarray,
    k: int,
    best_leaf_only: bool = False,
) -> _Best:
    """Branch and bound of a block of queries over one tree.

    A node is entered with the queries whose bound there reaches their floor, the child
    that promises more to them first. ``floor``: scores below it are of no use.
    """
    best = _Best(query_ids, k, floor.copy())
    bounds = tree.bounds(queries)
    ids = ids[tree.order]
    if best_leaf_only:
        leaves = np.array([n for n, node in enumerate(tree.nodes) if node[4] < 0])
        first = leaves[bounds[:, leaves].argmax(axis=1)]
        for leaf in np.unique(first):
            _, _, low, high, _, _ = tree.nodes[leaf]
            which = np.flatnonzero(first == leaf)
            best.offer(which, _scores(queries[which], tree.vectors[low:high]), ids[low:high])
        return best
    stack = [(0, np.arange(len(queries)))]
    while stack:
        node, which = stack.pop()
        which = which[bounds[which, node] >= best.floor[which]]
        if not len(which):
            continue
        _, _, low, high, left, right = tree.nodes[node]
        if left < 0:
            best.offer(which, _scores(queries[which], tree.vectors[low:high]), ids[low:high])
            continue
        to_left = bounds[which, left] >= bounds[which, right]
        for first, second, some in ((left, right, to_left), (right, left, ~to_left)):
            if some.any():  # the last pushed is searched first
                stack.append((second, which[some]))
                stack.append((first, which[some]))
    return best


def _search(k: int, best_leaf_only: bool):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """One shard (left) against the queries sent to it (right)."""
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if left.empty or right.empty:
            return empty
        ids = left["vec_id"].to_numpy(np.int64)
        tree = BallTree(np.stack(left["vector"].to_numpy()).astype(float))
        found = search_block(
            tree,
            ids,
            right["query_id"].to_numpy(np.int64),
            np.stack(right["vector"].to_numpy()).astype(float),
            right["floor"].to_numpy(float),
            k,
            best_leaf_only,
        )
        sizes = [len(s) for s in found.scores]
        return pd.DataFrame(
            {
                "query_id": np.repeat(found.ids, sizes),
                "vec_id": np.concatenate(found.found),
                "score": np.concatenate(found.scores).astype(np.int64),
            }
        )

    return run


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` candidates of largest inner product.

    Vectors hold whole numbers. Ties go to the smaller id; a query never meets rows with its
    own id. A query with fewer candidates gets all. Vectors that are null, empty or hold a
    null or non-finite component, and rows without an id, take no part; vectors of different
    lengths have no product, so each length is searched by itself. Repeated rows of one id
    and vector count once; other columns are not read. Empty tables give an empty result.

    Every block of queries meets every shard. Shards and blocks hold ``shard_rows`` and
    ``BLOCK_QUERIES`` rows on average, so that only their number grows with the tables.
    """

    def pick(df: DataFrame, name: str) -> DataFrame:
        return (
            df.select(
                F.col(f"`{id_col}`").cast("long").alias(name),
                F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
            )
            .where(F.col(name).isNotNull() & valid(F.col("vector")))
            .withColumn("dim", F.size("vector"))
            .dropDuplicates()
        )

    rows = scratch.durable(pick(candidates, "vec_id"), "topk-rows")
    asked = scratch.durable(pick(queries, "query_id"), "topk-queries")
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def part(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    keys = ["dim", "shard", "block"]
    dealt = rows.withColumn("shard", part("vec_id", shards)).withColumn("block", numbers(blocks))

    def answers(floors: DataFrame, best_leaf_only: bool) -> DataFrame:
        """At most ``k`` rows of each shard for a query, then the best ``k`` of all."""
        sent = floors.withColumn("block", part("query_id", blocks)).withColumn(
            "shard", numbers(shards)
        )
        found = (
            dealt.groupBy(*keys)
            .cogroup(sent.groupBy(*keys))
            .applyInPandas(
                _search(k, best_leaf_only), "query_id long, vec_id long, score long"
            )
        )
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    start = answers(asked.withColumn("floor", F.lit(float("-inf"))), True)
    kth = scratch.durable(
        start.where(F.col("rank") == k).select(
            "query_id", F.col("score").cast("double").alias("floor")
        ),
        "topk-floors",
    )
    shared = asked.join(kth, "query_id", "left").fillna(float("-inf"), ["floor"])
    return answers(shared, False).select("query_id", "rank", "vec_id", "score")

"""Similarity join of documents on word n-grams, by adaptive multi-match prefixes.

A document's set holds the 64-bit hashes of its distinct ``shingle``-word n-grams; sets of
one fingerprint are joined at once. Two sets whose Jaccard similarity reaches the threshold
t share, in the order of the hashes, at least L of their first P + L - 1 members, for any L,
where P = n - ceil(t * n) + 1. So candidates come from prefixes alone:

* Members that many prefixes hold (``HOT`` or more) generate no candidates. A document
  lengthens its prefix until P members of it are rare, and further by ``LENGTHEN`` times
  the logarithm of the candidates that its prefix promises. With h hot and e further members, two documents
  of prefixes P + h + e must share h + e + 1 members, and so at least e + 1 rare ones.
* The shorter of the two lengthenings counts for a pair.
* Documents that stay without P rare members within the stored prefix are dense: they
  consist of what many share. They meet through their hot members, and have no limit either.

Candidates form clusters. Each cluster's whole sets are compared exactly, in blocks of
``BLOCK`` documents, so that a cluster of any size spreads over many tasks. Of a cluster of
several blocks, those whose documents still lie outside its largest component meet all
others; documents that are connected already are not compared again.

No group of documents is expanded into all its pairs, and no link between different sets is
lost: what comes out are the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.graph import components
from orderlens.sources import scratch

#: Prefixes that hold a member from which on it generates no candidates by itself.
HOT = 32
#: Members by which a prefix is lengthened for each doubling of its candidates.
LENGTHEN = 3
#: Documents of a block: what one task compares at a time with as many others.
BLOCK = 1024
#: Rows up to which a table of document keys is broadcast; beyond, it is joined.
BROADCAST_ROWS = 1_000_000
#: Words whose hashes a worker keeps.
CACHE_WORDS = 1_000_000

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5],
    dtype=np.uint64,
)


@dataclass(frozen=True)
class Similarity:
    """Sets of ``shingle``-word n-grams link at ``percent`` per cent Jaccard or more."""

    shingle: int = 5
    percent: int = 80


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, shingle: int):
        self.shingle, self.hashes = shingle, _WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        """ASCII letters in lower case; words between ASCII white space.

        A text of fewer words than a shingle has its whole sequence as the one member; a
        text without words has none.
        """
        import xxhash

        words = text.encode().lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.shingle:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
        if len(self.hashes) > CACHE_WORDS:
            self.hashes.clear()
        each = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n = len(each) - self.shingle + 1
        mixed = np.zeros(n, np.uint64)
        for k in range(self.shingle):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[k % 4] + each[k : k + n]
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(33)
        return np.unique(mixed)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _extension(prefix: int) -> int:
    """Members stored beyond the plain prefix, for lengthening."""
    return 8 + prefix // 4


def _prefixes(rule: Similarity):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        shingler = Shingler(rule.shingle)
        for batch in batches:
            sizes, prints, stored = [], [], []
            for text in batch.column("text__"):
                members = shingler(text.as_py())
                n = len(members)
                p = prefix_size(n, rule.percent)
                sizes.append(n)
                prints.append(xxhash.xxh3_128_digest(members.tobytes()))
                stored.append(members[: p + _extension(p)].view(np.int64) if n else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id__"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(stored, pa.list_(pa.int64())),
                ],
                names=["id__", "text_hash", "n", "print", "members"],
            )

    return run


def _whole_sets(rule: Similarity):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingler = Shingler(rule.shingle)
        kept = ("node", "cluster", "size")
        for batch in batches:
            blobs = [shingler(text.as_py()).tobytes() for text in batch.column("text__")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(blobs, pa.binary())],
                names=[*kept, "members"],
            )

    return run


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def join(self, i: int, others: np.ndarray) -> None:
        for j in others:
            a, b = self.root(i), self.root(int(j))
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        parent = self.parent
        while (parent[parent] != parent).any():
            parent = parent[parent]
        self.parent = parent
        return parent


def linked(
    left: Sequence[np.ndarray],
    right: Sequence[np.ndarray] | None,
    percent: int,
    known: np.ndarray | None = None,
) -> np.ndarray:
    """Roots of the components of left + right sets by links of left with right.

    Without ``right``, links within left. ``known``: labels; equal ones are connected
    already. A document that has one component with all others of its side is passed over.
    """
    within = right is None
    others = left if within else right
    first = 0 if within else len(left)
    sizes = np.array([len(s) for s in others])
    members = np.concatenate(others) if len(others) else np.empty(0, np.uint64)
    order = np.argsort(members, kind="stable")
    members, owner = members[order], np.repeat(np.arange(len(others)), sizes)[order]
    forest = _Forest(first + len(others))
    if known is not None:
        _, start, inverse = np.unique(known, return_index=True, return_inverse=True)
        forest.parent = np.minimum(np.arange(len(known)), start[inverse])
    for i, mine in enumerate(left):
        if i % 16 == 0:
            roots = forest.roots()
            if (roots == roots[0]).all():
                break
        there = forest.roots()[first:]
        if (there == forest.root(i)).all():
            continue
        low = np.searchsorted(members, mine, "left")
        counts = np.searchsorted(members, mine, "right") - low
        total = int(counts.sum())
        if not total:
            continue
        at = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(total)
        common = np.bincount(owner[at], minlength=len(others))
        close = 100 * common >= percent * (len(mine) + sizes - common)
        close &= common > 0
        if within:
            close[i] = False
        hits = np.flatnonzero(close) + first
        if len(hits):
            forest.join(i, hits)
    return forest.roots()


def _compare(percent: int):
    def run(batches: Iterator) -> Iterator:
        """Rows sorted by task; side 0 alone is compared within, else with side 1."""
        import pyarrow as pa

        def done(nodes, sides, labels, blobs):
            sets = [np.frombuffer(b, np.uint64) for b in blobs]
            once = {(side, node): k for k, (side, node) in enumerate(zip(sides, nodes, strict=True))}
            order = [once[key] for key in sorted(once)]
            cut = sum(1 for side, _ in once if not side)
            known = np.array([labels[k] for k in order], dtype=np.int64)
            ordered = [sets[k] for k in order]
            roots = linked(
                ordered[:cut], ordered[cut:] if cut < len(order) else None, percent, known
            )
            a, b = [], []
            for place, root in enumerate(roots):
                if place != root:
                    a.append(nodes[order[place]])
                    b.append(nodes[order[root]])
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

        current, rows = None, ([], [], [], [])
        for batch in batches:
            columns = [
                batch.column(c).to_pylist() for c in ("task", "node", "side", "label", "members")
            ]
            for task, *row in zip(*columns, strict=True):
                if task != current and rows[0]:
                    yield done(*rows)
                    rows = ([], [], [], [])
                current = task
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
        if rows[0]:
            yield done(*rows)

    return run


def _candidates(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their prefixes let through, and glue between dense documents.

    ``members``: node, n, pos, t for the stored prefix of every distinct set.
    """
    shared = members.groupBy("t").count().where(F.col("count") > 1)
    prefix = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    rows = scratch.durable(
        members.join(shared, "t")
        .withColumn("hot", F.col("count") > HOT)
        .withColumn("p", prefix),
        "jaccard-members",
    )
    by_place = Window.partitionBy("node").orderBy("pos")
    every = Window.partitionBy("node")
    stored = F.least("n", F.col("p") + 8 + F.floor(F.col("p") / 4)).cast("int")
    hot = F.col("hot").cast("int")
    rare_place = F.col("pos") - (F.sum(hot).over(by_place) - hot)  # rare members before it
    placed = (
        rows.withColumn("rare_place", rare_place.cast("int"))
        .withColumn("spare", (stored - F.sum(hot).over(every) - F.col("p")).cast("int"))
        .withColumn(
            "cost",
            F.sum(
                F.when(~F.col("hot") & (F.col("rare_place") < F.col("p")), F.col("count") - 1)
            ).over(every),
        )
        .withColumn("dense", F.col("spare") < 0)
        .withColumn(
            "more",
            F.when(F.col("dense"), 0).otherwise(
                F.least(
                    F.col("spare"),
                    F.ceil(LENGTHEN * F.log2(1 + F.coalesce(F.col("cost"), F.lit(0)))).cast("int"),
                )
            ),
        )
        # hot members within the document's prefix of p + more rare ones
        .withColumn(
            "hot_inside",
            F.sum(
                F.when(
                    F.col("hot") & (F.col("rare_place") < F.col("p") + F.col("more")), 1
                ).otherwise(0)
            ).over(every),
        )
        # dense documents lengthen as far as any, and decide for no pair but their own
        .withColumn(
            "length",
            F.when(F.col("dense"), F.lit(1 << 20)).otherwise(
                1 + F.col("more") + F.col("hot_inside")
            ).cast("int"),
        )
    )
    used = placed.where(
        ~F.col("hot")
        & (F.col("dense") | (F.col("rare_place") < F.col("p") + F.col("more")))
    ).select("t", "node", "n", "pos", "p", "length", (F.col("more") + 1).alias("need"))
    # at most HOT rows of a member meet, in one row
    met = used.groupBy("t").agg(
        F.collect_list(F.struct(*[c for c in used.columns if c != "t"])).alias("all")
    ).where(F.size("all") > 1)
    a, b = F.col("a"), F.col("b")
    short = F.least(a["length"], b["length"])

    def partners(a):
        return lambda b: (a["node"] < b["node"]) & (
            100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"])
        )

    pairs = (
        met.select("all", F.explode("all").alias("a"))
        .select("a", F.explode(F.filter("all", partners(a))).alias("b"))
        .where((a["pos"] < a["p"] + short - 1) & (b["pos"] < b["p"] + short - 1))
        .select(
            a["node"].alias("a"),
            b["node"].alias("b"),
            F.when(a["length"] < b["length"], a["need"])
            .when(a["length"] > b["length"], b["need"])
            .otherwise(F.greatest(a["need"], b["need"]))
            .alias("need"),
        )
        .groupBy("a", "b")
        .agg(F.count("*").alias("matches"), F.max("need").alias("need"))
        .where("matches >= need")
        .select("a", "b")
    )
    crowd = placed.where(F.col("hot") & F.col("dense") & (F.col("pos") < F.col("p"))).select(
        "t", "node"
    )
    centre = crowd.groupBy("t").agg(F.min("node").alias("b"))
    glue = (
        crowd.join(centre, "t").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    )
    return pairs.union(glue)


def _small(keys: DataFrame) -> DataFrame:
    """Keys with a broadcast hint if they are few, else as they are."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _blocks(size: Column) -> Column:
    return F.ceil(size / BLOCK).cast("int")


def _tasks(rows: DataFrame, percent: int) -> DataFrame:
    """Links that the comparisons of all tasks find; ``rows``: task, side, node, label, members."""
    dealt = rows.repartition("task").sortWithinPartitions("task")
    return dealt.select("task", "node", "side", "label", "members").mapInArrow(
        _compare(percent), "a long, b long"
    )


def _links(clustered: DataFrame, percent: int) -> DataFrame:
    """Components of ``clustered``: node, cluster, size, members."""
    blocks = scratch.durable(
        clustered.withColumn("blocks", _blocks(F.col("size"))).withColumn(
            "block", F.pmod(F.xxhash64("node"), "blocks").cast("int")
        ),
        "jaccard-blocks",
    )
    def task(*parts) -> Column:
        return F.concat_ws("/", "cluster", *parts)

    # every block within itself, and the first block of a cluster with each of its others
    to_first = F.when(
        F.col("blocks") > 1,
        F.when(
            F.col("block") == 0,
            F.transform(
                F.sequence(F.lit(1), F.col("blocks") - 1),
                lambda j: F.struct(task(F.lit("0"), j).alias("task"), F.lit(0).alias("side")),
            ),
        ).otherwise(
            F.array(F.struct(task(F.lit("0"), "block").alias("task"), F.lit(1).alias("side")))
        ),
    )
    within = F.array(F.struct(task("block").alias("task"), F.lit(0).alias("side")))
    first = blocks.withColumn("label", F.col("node")).withColumn(
        "x", F.explode(F.concat(within, F.coalesce(to_first, F.filter(within, lambda x: F.lit(False)))))
    )
    found = scratch.durable(
        _tasks(first.select("x.task", "x.side", "node", "label", "members"), percent),
        "jaccard-links",
    )
    large = blocks.where("blocks > 1")
    if large.isEmpty():
        return components(found)
    labels = components(found)
    labelled = large.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    labelled = scratch.durable(labelled, "jaccard-labelled")
    counts = labelled.groupBy("cluster", "label").count()
    largest = counts.groupBy("cluster").agg(
        F.max(F.struct("count", F.col("label").alias("main"))).alias("m")
    ).select("cluster", F.col("m.main").alias("main"), F.col("m.count").alias("in_main"))
    outside = labelled.join(largest, "cluster").withColumn(
        "outside", F.col("label") != F.col("main")
    ).withColumn("queries", _blocks(F.greatest(F.col("size") - F.col("in_main"), F.lit(1))))
    asking = outside.where("outside").withColumn(
        "query", F.pmod(F.xxhash64("node", F.lit(1)), "queries").cast("int")
    )
    asks = asking.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = outside.withColumn(
        "query", F.explode(F.sequence(F.lit(0), F.col("queries") - 1))
    ).where("in_main < size")
    second = asks.select(
        task("query", "j").alias("task"), F.lit(0).alias("side"), "node", "label", "members"
    ).union(
        asked.select(
            task("query", "block").alias("task"), F.lit(1).alias("side"), "node", "label", "members"
        )
    )
    crossed = scratch.durable(_tasks(second, percent), "jaccard-links")
    return components(found.union(crossed))


def join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: Similarity = Similarity(),
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` for every row of ``df``.

    ``component_id`` is the smallest id that links reach, the row's own included. Null or empty
    texts, and texts without words, have no shingles and link with nothing. Rows with equal
    texts are linked, also under one id. A null id is never the smallest; rows that reach
    nulls only get null. Other columns are not read, and an empty table gives an empty
    result. No document is cut and no group is capped.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id__"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text__"),
    )
    docs = scratch.durable(
        source.mapInArrow(
            _prefixes(rule),
            "id__ long, text_hash long, n long, print binary, members array<long>",
        ).withColumn("row__", F.monotonically_increasing_id()),
        "jaccard-prefixes",
    )
    kinds = scratch.durable(
        docs.where("n > 0")
        .groupBy("print")
        .agg(
            F.min("row__").alias("node"),
            F.min("id__").alias("least"),
            F.min(F.struct("text_hash", "id__")).alias("text"),
        ),
        "jaccard-kinds",
    )
    copies = scratch.durable(
        docs.where("n > 0")
        .select("row__", "print")
        .join(kinds.select("print", "node"), "print")
        .where("row__ <> node")
        .select("row__"),
        "jaccard-copies",
    )
    members = (
        docs.where("n > 0")
        .join(_small(copies), "row__", "left_anti")
        .select(
            F.col("row__").alias("node"),
            F.col("n").cast("int").alias("n"),
            F.posexplode("members").alias("pos", "t"),
        )
    )
    edges = scratch.durable(_candidates(members, rule.percent), "jaccard-candidates")
    clusters = components(edges).withColumnRenamed("label", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    wanted = scratch.durable(
        clusters.join(sizes, "cluster").join(kinds.select("node", "text"), "node"),
        "jaccard-clusters",
    )
    # the text of one row for each set; rows that repeat id and text are told apart later
    texts = source.select(F.struct("text_hash", "id__").alias("text"), "text__").join(
        _small(wanted), "text"
    )
    sets = texts.select("node", "cluster", "size", "text__").mapInArrow(
        _whole_sets(rule), "node long, cluster long, size long, members binary"
    )
    labels = _links(sets, rule.percent)
    named = kinds.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = named.join(smallest, "label").select("print", "component_id")
    return docs.join(by_print, "print", "left").select(
        F.col("id__").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id__")).alias("component_id"),
    )

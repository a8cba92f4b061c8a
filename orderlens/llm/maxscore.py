"""Ranked lexical search: MaxScore whose bounds come from single terms and from pairs of terms.

A document's score for an item is the sum of its terms' impacts, whole numbers that grow with the
term's rarity and its count in the document and fall with the document's length. Documents lie
in blocks. The index of a block holds, for every term of the items, the documents with their
impacts and the highest impact, and for chosen pairs of terms the documents that hold both and
the highest joint impact.

An item's terms form pairs of neighbours in rarity. What both terms of a pair add to any one
document is at most the higher of their own maxima and of their joint maximum, which may
be far below the sum of their maxima. The pairs that, taken together, cannot lift a document
to the kth score so far are non-essential: only documents that hold a term of another pair are
looked at. Those are completed from the strongest remaining pair down, and a document leaves
once its score so far and the bounds of what remains cannot reach the kth score. A document
outside a pair's intersection list is bounded by the single maxima.
The bounds never fall short, so the result is exact whichever pairs are chosen.

Texts are read once and only counts of the items' terms are kept of them. An index block travels
to one task, whatever its terms. Items are answered in passes of bounded size; each
task returns at most k documents of an item, and a window keeps the best of all tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources import scratch

BLOCK_DOCS = 4096
#: Terms of items that one pass answers, about: what the driver and every task hold.
PASS_TERMS = 500_000
#: A pair's documents are listed if they are at most this share of a block; the bound always is.
LISTED_SHARE = 0.125
_DOCS, _TERM, _PAIR = 0, 1, 2
_INDEX = (
    "block long, kind int, a int, b int, bound long, docs array<int>, impacts array<int>, "
    "ids array<long>"
)

# what ends a term: ASCII other than letters and digits; A-Z become a-z
_FOLD = bytes(
    ord(chr(c).lower()) if chr(c).isalnum() else 0x20 for c in range(0x80)
) + bytes(range(0x80, 0x100))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order: letters and digits of ASCII, and all else beyond ASCII."""
    return text.encode().translate(_FOLD).split() if text else []


def _item_terms(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = [sorted(set(terms(text.as_py()))) for text in batch.column("text__")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id__"), pa.array(found, pa.list_(pa.binary()))], names=["id__", "terms"]
        )


def _count_terms(vocabulary):
    def run(batches: Iterator) -> Iterator:
        """Texts with a term: their number of terms and their counts of the vocabulary's."""
        import pyarrow as pa

        number = vocabulary.value
        for batch in batches:
            ids, sizes, which, counts = [], [], [], []
            for doc_id, text in zip(batch.column("id__"), batch.column("text__"), strict=True):
                words = terms(text.as_py())
                if not words:
                    continue
                known = [(number[w], n) for w, n in Counter(words).items() if w in number]
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                which.append([t for t, _ in known])
                counts.append([n for _, n in known])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(which, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                names=["id__", "n", "terms", "counts"],
            )

    return run


class _Terms:
    """Documents and impacts of every term of one block."""

    def __init__(self, which, docs, impacts, weights, size):
        order = np.argsort(which, kind="stable")
        which, self.docs, self.impacts = which[order], docs[order], impacts[order]
        starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else []
        ends = np.r_[starts[1:], len(which)] if len(which) else []
        self.place = {
            int(which[s]): (int(s), int(e)) for s, e in zip(starts, ends, strict=True)
        }
        self.weights = weights
        self.row = np.full(size, -1, np.int64)

    def __getitem__(self, term):
        low, high = self.place[term]
        return self.docs[low:high], self.impacts[low:high]

    def joint(self, a, b):
        """Documents that hold both terms, and their highest joint impact."""
        (of_a, impacts_a), (of_b, impacts_b) = self[a], self[b]
        self.row[of_a] = impacts_a * self.weights[a]
        other = self.row[of_b]
        self.row[of_a] = -1
        both = other >= 0
        joint = (other + impacts_b * self.weights[b])[both]
        return of_b[both], int(joint.max(initial=0))


def _build(shared, documents: int, length: int):
    def run(batches: Iterator) -> Iterator:
        """Index rows of the blocks of a task."""
        import pyarrow as pa
        from pyspark import TaskContext

        weights, pairs = shared.value
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, len(batch), BLOCK_DOCS):
                rows = batch.slice(at, BLOCK_DOCS)
                sizes = rows.column("n").to_pylist()
                norms = np.array([10 + 90 * n * documents // length for n in sizes], np.int64)
                which = rows.column("terms").flatten().to_numpy().astype(np.int64)
                counts = rows.column("counts").flatten().to_numpy().astype(np.int64)
                held = rows.column("terms").value_lengths().to_numpy()
                docs = np.repeat(np.arange(len(rows), dtype=np.int32), held)
                impacts = (1_000_000_000 * counts) // (1000 * counts + 8 * norms[docs])
                useful = weights[which] > 0
                lists = _Terms(which[useful], docs[useful], impacts[useful], weights, len(rows))
                found = [(_DOCS, None, None, None, None, None, rows.column("id__").to_pylist())]
                for term in lists.place:
                    members, own = lists[term]
                    bound = int(own.max()) * int(weights[term])
                    found.append((_TERM, term, None, bound, members, own.astype(np.int32), None))
                for a, b in pairs:
                    if a in lists.place and b in lists.place:
                        members, bound = lists.joint(a, b)
                        listed = len(members) <= LISTED_SHARE * len(rows)
                        found.append((_PAIR, a, b, bound, members if listed else None, None, None))
                columns = list(zip(*found, strict=True))
                types = [pa.int32()] * 3 + [pa.int64()] + [pa.list_(pa.int32())] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(found), pa.int64())]
                    + [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                    + [pa.array(columns[-1], pa.list_(pa.int64()))],
                    names=["block", "kind", "a", "b", "bound", "docs", "impacts", "ids"],
                )
                block += 1

    return run


class _Block:
    """One block of the index, and the search in it."""

    def __init__(self, rows, weights):
        self.terms, self.pairs, self.bounds = {}, {}, {}
        for kind, a, b, bound, docs, impacts, ids in rows:
            if kind == _DOCS:
                self.missing = ids.is_null().to_numpy(zero_copy_only=False)
                self.ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            elif kind == _TERM:
                self.terms[a] = docs.to_numpy(), impacts.to_numpy().astype(np.int64) * weights[a]
                self.bounds[a] = bound
            else:
                self.pairs[a, b] = bound, None if docs is None else docs.to_numpy()
        self.scores = np.zeros(len(self.ids), np.int64)

    def _groups(self, groups, with_pairs):
        """Bound, terms and pair of every group that the block holds, by rising bound."""
        found = []
        for group in groups:
            held = [t for t in group if t in self.terms]
            if len(held) == 2 and with_pairs:
                joint = self.pairs[group]
                highest = max(self.bounds[t] for t in held)
                found.append((max(highest, joint[0]), held, highest, joint))
            else:
                found += [(self.bounds[t], [t], self.bounds[t], None) for t in held]
        return sorted(found, key=lambda g: g[0])

    def search(self, groups, floor, with_pairs=True):
        """(documents, scores) that reach ``floor``, and the number of documents looked at."""
        found = self._groups(groups, with_pairs)
        below = essential = 0
        while essential < len(found) and below + found[essential][0] < floor:
            below += found[essential][0]
            essential += 1
        scores = self.scores
        scores[:] = 0
        for _, held, _, _ in found[essential:]:
            for term in held:
                docs, impacts = self.terms[term]
                scores[docs] += impacts
        candidates = np.flatnonzero(scores)
        looked = len(candidates)
        for bound, held, highest, joint in reversed(found[:essential]):
            candidates = candidates[scores[candidates] + below >= floor]
            if not len(candidates):
                break
            below -= bound
            if joint is not None and joint[1] is not None:
                inside = np.isin(candidates, joint[1], assume_unique=True)
                own = np.where(inside, bound, highest)
                candidates = candidates[scores[candidates] + own + below >= floor]
            for term in held:
                docs, impacts = self.terms[term]
                at = np.minimum(np.searchsorted(docs, candidates), len(docs) - 1)
                scores[candidates] += np.where(docs[at] == candidates, impacts[at], 0)
        candidates = candidates[scores[candidates] >= floor]
        return candidates, scores[candidates], looked


def _find(shared, k: int):
    def run(batches: Iterator) -> Iterator:
        """Index rows sorted by block: at most k documents of each item, the best of the task."""
        import pyarrow as pa

        weights, items = shared.value
        best: list[list] = [[] for _ in items]

        def answer(rows):
            block = _Block(rows, weights)
            for number, (_, groups) in enumerate(items):
                floor = best[number][-1][0] if len(best[number]) == k else 1
                docs, scores, _ = block.search(groups, floor)
                if len(docs):
                    first = np.lexsort((block.ids[docs], -scores))[:k]
                    best[number] += zip(
                        scores[first].tolist(),
                        block.ids[docs[first]].tolist(),
                        block.missing[docs[first]].tolist(),
                        strict=True,
                    )
                    best[number].sort(key=lambda row: (-row[0], row[1]))
                    del best[number][k:]

        current, rows = None, []
        for batch in batches:
            blocks = batch.column("block").to_pylist()
            plain = [batch.column(c).to_pylist() for c in ("kind", "a", "b", "bound")]
            lists = [
                [x.values if x.is_valid else None for x in batch.column(c)]
                for c in ("docs", "impacts", "ids")
            ]
            for block, *row in zip(blocks, *plain, *lists, strict=True):
                if rows and block != current:
                    answer(rows)
                    rows = []
                current = block
                rows.append(row)
        if rows:
            answer(rows)
        flat = [
            (number, items[number][0], None if missing else doc_id, score)
            for number, found in enumerate(best)
            for score, doc_id, missing in found
        ]
        columns = list(zip(*flat, strict=True)) or [[], [], [], []]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["item__", "id__", "doc_id", "score"],
        )

    return run


def term_weights(frequency: DataFrame, documents: int) -> DataFrame:
    """(term, weight): the rarer a term, the higher; 0 for a term of (nearly) all documents."""
    ratio = F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)
    return frequency.select("term", F.floor(1000 * F.ln(ratio)).cast("long").alias("weight"))


def pairs_of(held: list[int], weights: np.ndarray) -> list[tuple[int, ...]]:
    """An item's terms in pairs of neighbours in weight; the last may stay alone."""
    useful = sorted((t for t in held if weights[t] > 0), key=lambda t: (-weights[t], t))
    return [tuple(useful[i : i + 2]) for i in range(0, len(useful), 2)]


def build_index(docs: DataFrame, vocabulary: list[bytes], held: list[list[int]]):
    """The written index of ``docs`` (id__, text__) for some terms; their weights and pairs.

    ``held``: the terms of each item, by number. Returns (index, weights, groups of each item),
    or None if no document has a term.
    """
    context = docs.sparkSession.sparkContext
    numbers = context.broadcast({term: i for i, term in enumerate(vocabulary)})
    counted = scratch.durable(
        docs.mapInArrow(
            _count_terms(numbers), "id__ long, n long, terms array<int>, counts array<long>"
        ),
        "search-counts",
    )
    size = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    if not size["documents"]:
        return None
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df")
    )
    # one number a term of the pass
    known = term_weights(frequency, size["documents"]).toArrow()
    weights = np.zeros(len(vocabulary), np.int64)
    weights[known.column("term").to_numpy()] = known.column("weight").to_numpy()
    groups = [pairs_of(terms, weights) for terms in held]
    pairs = sorted({g for item in groups for g in item if len(g) == 2})
    index = scratch.durable(
        counted.mapInArrow(
            _build(context.broadcast((weights, pairs)), size["documents"], size["length"]), _INDEX
        ),
        "search-index",
    )
    return index, weights, groups


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """``item_col``, rank, ``id_col``, score: each item's k best documents with a score above 0.

    Ids are whole numbers. Equal scores come by id, a document without one last. Null or empty
    texts have no term: such documents count nowhere, such items find nothing. Every row of
    ``items`` is an item and every row of ``docs`` a document, also repeated ones, which
    rank one after another. Other columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    bare = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id__"), F.col(f"`{text_col}`").alias("text__")
    )
    listed = scratch.durable(
        items.select(
            F.col(f"`{item_col}`").cast("long").alias("id__"),
            F.col(f"`{item_text_col}`").alias("text__"),
        )
        .mapInArrow(_item_terms, "id__ long, terms array<binary>")
        .withColumn("at", F.monotonically_increasing_id()),
        "search-items",
    )
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = -(-total // pass_terms)
    results = []
    for number in range(passes):
        asked = listed.where(F.pmod(F.xxhash64("at"), F.lit(passes)) == number).toArrow()
        ids, of_items = asked.column("id__").to_pylist(), asked.column("terms").to_pylist()
        vocabulary = sorted({t for found in of_items for t in found})
        place = {term: i for i, term in enumerate(vocabulary)}
        built = build_index(bare, vocabulary, [[place[t] for t in found] for found in of_items])
        if built is None:
            continue
        index, weights, groups = built
        shared = spark.sparkContext.broadcast((weights, list(zip(ids, groups, strict=True))))
        found = (
            index.repartition("block")
            .sortWithinPartitions("block", "kind")
            .mapInArrow(_find(shared, k), "item__ int, id__ long, doc_id long, score long")
        )
        results.append(found.withColumn("pass__", F.lit(number)))
    order = Window.partitionBy("pass__", "item__").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_last()
    )
    if not results:
        return spark.createDataFrame([], f"{item_col} long, rank int, {id_col} long, score long")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("id__").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
    )

"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from orderlens.llm import maxscore

DOCS, ITEMS = "doc_id long, text string, term string, n int", "item_id long, text string, block int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain_search(docs, items, k):
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text, *_ in docs]
    counted = [(doc_id, c, sum(c.values())) for doc_id, c in counted if c]
    n_all, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    found = []
    for item_id, text, *_ in items:
        scored = []
        for doc_id, c, n in counted:
            m = 100 - 90 + (90 * n * n_all) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(plain_terms(text)) & set(c)
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=str)


def searched(spark, docs, items, k, **options):
    result = maxscore.search(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=k, **options
    )
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in result.collect()), key=str)


def made_up(seed, documents, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    docs = [
        (i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 30, 200]))), "x", 1)
        for i in range(documents)
    ]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 15))), 1) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_equals_scoring_all(spark, monkeypatch, block):
    monkeypatch.setattr(maxscore, "BLOCK_DOCS", block)
    docs, items = made_up(block, 300)
    assert searched(spark, docs, items, 5) == plain_search(docs, items, 5)


def test_passes_of_items_change_nothing(spark):
    docs, items = made_up(3, 120)
    assert searched(spark, docs, items, 4, pass_terms=20) == plain_search(docs, items, 4)


def test_nulls_empty_texts_ties_and_repeated_rows(spark):
    docs = [
        (None, "alpha beta", "x", 1), (3, "alpha beta", "x", 1), (3, "alpha beta", "x", 1),
        (1, "ALPHA-beta", "x", 1), (5, None, "x", 1), (6, "", None, 1), (7, " .,;\x00", "x", 1),
        (8, "été ÉTÉ alpha" + " pad" * 5000, "x", 1), (9, "unlike", "x", None),
    ]
    items = [
        (1, "alpha", 1), (1, "alpha", 1), (2, None, 1), (3, "", 1), (4, "nowhere", 1),
        (None, "beta Alpha alpha", 1), (6, "ÉTÉ", None), (7, "!!", 1),
    ]
    for k in (1, 3, 10):
        assert searched(spark, docs, items, k) == plain_search(docs, items, k)


def test_empty_tables(spark):
    docs, items = made_up(1, 3)
    assert searched(spark, docs, [], 3) == []
    assert searched(spark, [], items, 3) == []
    assert searched(spark, [(1, None, "", 1)], items, 3) == []


def test_pairs_prune_more_than_single_maxima():
    """Two terms that never meet at their best: the joint maximum leaves documents unseen."""
    weights = np.array([10, 10, 30])
    size = 1000
    a, b, rare = np.arange(0, 400), np.arange(400, 800), np.arange(0, size, 100)
    docs = np.concatenate([a, b, rare]).astype(np.int32)
    which = np.concatenate([np.zeros(400), np.ones(400), np.full(10, 2)]).astype(np.int64)
    lists = maxscore._Terms(which, docs, np.full(len(docs), 100), weights, size)
    rows = [(0, None, None, None, None, None, _array(range(size)))]
    for term in lists.place:
        members, impacts = lists[term]
        rows.append((1, term, None, int(impacts.max() * weights[term]), _array(members), _array(impacts), None))
    members, bound = lists.joint(0, 1)
    assert (len(members), bound) == (0, 0)
    rows.append((2, 0, 1, bound, _array(members), None, None))
    block = maxscore._Block(rows, weights)
    groups, floor = [(0, 1), (2,)], 1500
    with_pairs = block.search(groups, floor)
    single = block.search(groups, floor, with_pairs=False)
    assert with_pairs[0].tolist() == single[0].tolist() == rare.tolist()
    assert with_pairs[2] == 10 and single[2] > 400


def _array(values):
    import pyarrow as pa

    return pa.array([int(v) for v in values], pa.int64())

"""The manifest against a plain tree in Python."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlens.llm import merkle

SCHEMA = "doc_id long, source string, text string, leaf int"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves: list[str]) -> tuple[str, list[list[list[str]]]]:
    """The last digest, and of every leaf its siblings by level."""
    siblings: list[list[list[str]]] = [[] for _ in leaves]
    members, nodes = [[i] for i in range(len(leaves))], leaves
    while len(nodes) > 1:
        above, merged = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for slot in range(len(run)):
                for leaf in members[at + slot]:
                    siblings[leaf].append(run[:slot] + run[slot + 1 :])
            above.append(sha(*run))
            merged.append(sum(members[at : at + 3], []))
        nodes, members = above, merged
    return nodes[0], siblings


def nulls_first(value):
    return (value is not None, value.encode() if isinstance(value, str) else value or 0)


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof) of all rows."""
    groups: dict = {}
    for doc_id, source, text, _ in rows:
        leaf = sha(framed(doc_id), framed(source), framed(text))
        groups.setdefault(source, []).append((nulls_first(doc_id), leaf, doc_id))
    order = sorted(groups, key=nulls_first)
    trees = {s: plain_tree([leaf for _, leaf, _ in sorted(groups[s], key=lambda r: r[:2])]) for s in order}
    root, upper = plain_tree([trees[s][0] for s in order])
    found = []
    for number, source in enumerate(order):
        subroot, siblings = trees[source]
        for (_, leaf, doc_id), own in zip(
            sorted(groups[source], key=lambda r: r[:2]), siblings, strict=True
        ):
            proof = sha(*[d for level in own + upper[number] for d in level])
            found.append((doc_id, leaf, subroot, root, proof))
    return sorted(found, key=str)


def manifest_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    leaf = merkle.leaf(F.col("doc_id"), F.col("source"), F.col("text"))
    made = merkle.manifest(df, leaf, group="source", order=["doc_id"])
    found = made.leaves.select(
        "row.doc_id", "leaf", "subroot", F.lit(made.root).alias("root"),
        merkle.siblings_digest(F.col("path")).alias("proof"),
        merkle.fold(F.col("leaf"), F.col("path")).alias("folded"),
    ).collect()
    assert all(r["folded"] == r["root"] for r in found)
    return sorted([tuple(r)[:5] for r in found], key=str)


@pytest.mark.parametrize("sizes", [[1], [3, 1], [27, 28, 4], [10] + [1] * 10])
def test_trees_of_all_shapes(spark, sizes):
    rows = [
        (1000 * g + i, f"s{g}", f"text {g} {i}\n", 7) for g, n in enumerate(sizes) for i in range(n)
    ]
    assert manifest_rows(spark, rows) == plain_manifest(rows)


value = st.sampled_from([None, "", "a", "ä\n", "b" * 300])
row = st.tuples(
    st.one_of(st.none(), st.integers(-3, 12)), st.sampled_from([None, "", "x", "é", "z"]), value, st.just(1)
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_nulls_ties_and_repeated_rows(spark, rows):
    assert manifest_rows(spark, rows) == plain_manifest(rows)


def test_an_empty_table_has_no_root(spark):
    made = merkle.manifest(spark.createDataFrame([], SCHEMA), F.lit("x"), "source", ["doc_id"])
    assert made.root is None and made.leaves.count() == 0 and made.nodes.count() == 0


def test_a_group_over_many_parts_keeps_its_order(spark):
    """A hot group spans parts; the groups around it begin and end inside parts."""
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", f"t{i}", 0) for i in range(900)] + [
        (i, None, "n", 0) for i in range(5)
    ]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert manifest_rows(spark, rows) == plain_manifest(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_any_change_of_a_row_breaks_its_proof_only(spark):
    rows = [(i, f"s{i % 2}", f"t{i}", 0) for i in range(20)]
    leaf = merkle.leaf(F.col("doc_id"), F.col("source"), F.col("text"))
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA), leaf, "source", ["doc_id"])
    changed = F.when(F.col("row.doc_id") == 7, merkle.leaf(F.lit(7), F.lit("s1"), F.lit("t8")))
    folded = merkle.fold(F.coalesce(changed, "leaf"), F.col("path"))
    broken = made.leaves.where(folded != made.root).select("row.doc_id").collect()
    assert [r["doc_id"] for r in broken] == [7]


def test_nodes_hold_every_level(spark):
    rows = [(i, "s", f"t{i}", 0) for i in range(10)]
    leaf = merkle.leaf(F.col("doc_id"), F.col("source"), F.col("text"))
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA), leaf, "source", ["doc_id"])
    sizes = {r["level"]: r["count"] for r in made.nodes.groupBy("level").count().collect()}
    assert sizes == {0: 10, 1: 4, 2: 2, 3: 1}
    assert made.nodes.where("level = 3").first()["digest"] == made.leaves.first()["subroot"]

"""Order lines as text, made of odd tables."""

from __future__ import annotations

import datetime
from collections import Counter

import pytest

from orderlens.sources import star

DAY = datetime.datetime(2024, 2, 29, 13, 0)
LINE_KEYS = [(97, 1), (101, 2), (53, 3), (59, 1), (61, 2), (67, 3), (71, 1), (14, 2), (-7, -4), (None, 1), (8, None)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Null and repeated keys, null values, amounts below zero, numbers beyond their text's type."""
    folder = str(tmp_path_factory.mktemp("odd"))
    lines = []
    for order, part in LINE_KEYS:
        lines += [
            (order, part, 7, 1, 3.0, 60000.005, 0.07, 0.08, "R", DAY),
            (order, part, None, 7, None, -12.345, 0.0, None, None, None),
            (order, part, -50, 2, 5.9, 4e12, 0.01, 0.02, "N", DAY - datetime.timedelta(9)),
            (order, part, 40, 2, 1.0, None, None, 0.01, "A", DAY + datetime.timedelta(9)),
        ]
    orders = [(key, 1 + (key or 0) % 4, "O", None if key == 67 else DAY, "1-URGENT") for key, _ in LINE_KEYS]
    tables = {
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
        ),
        "orders": (
            [*orders, orders[0], (14, 74, None, DAY, None), (999, 9, "F", DAY, "5-LOW")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "customer": (
            [(1, 1, -0.005, "BUILDING"), (2, 1, None, None), (3, 2, 7500.0, "a"), (4, 2, float("nan"), "b"),
             (74, 1, 2500.0, "c"), (9, 1, 1e17, "d")],
            "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "part": (
            [(1, "Red  Ink", "Brand#1", "LARGE  TIN", 901.005), (2, None, None, None, None),
             (3, "x", "y", " z ", -0.5), (3, "x2", "y", "z", 1e15), (-4, "é", "Ü", "ß q", float("nan")),
             (5, "no line", "has", "it", 1e17)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double",
        ),
        "nation": ([(1, "FRANCE"), (2, None)], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def expected(spark, folder):
    query = star.RAW_LINES_SQL.replace("{text}", "string").replace("{tab}", "\t")
    return spark.sql(query, lines=star.order_lines(spark, folder))


def test_raw_lines_are_those_of_the_sql(spark, odd):
    made, wanted = star.raw_lines(spark, odd), expected(spark, odd)
    assert made.dtypes == wanted.dtypes
    rows = Counter(tuple(r) for r in wanted.collect())
    assert Counter(tuple(r) for r in made.collect()) == rows
    assert sum(rows.values()) > len(LINE_KEYS) * 4


def test_text_too_large_for_its_type_is_refused_where_a_line_needs_it(spark, odd, tmp_path):
    for name in star.TABLES:
        rows = star.read_table(spark, odd, name)
        if name == "part":
            rows = rows.replace(901.005, 1e17)
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    for lines in (expected(spark, str(tmp_path)), star.raw_lines(spark, str(tmp_path))):
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            lines.collect()


def test_text_of_parts_and_orders_is_made_before_the_joins(spark, odd):
    plan = star.raw_lines(spark, odd)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan[: plan.index("Join")], plan[plan.index("Join"):]
    for made in ("upper(", "month(", "quarter("):
        assert made not in above and made in below


def test_raw_lines_lie_compressed_and_whole(spark, monkeypatch):
    """The text would else take several times the disk of the tables it is made from."""
    from collections import Counter
    from pathlib import Path

    from orderlens.queries.registry import RAW_NAMES
    from orderlens.sources import layers

    monkeypatch.setattr(star, "RAW_ROWS_PER_FILE", 700)
    path = star.write_raw_lines(spark, "/root/testdata/sf0.001")
    files = [f for f in Path(path).iterdir() if f.name.startswith("part-")]
    assert all(f.name.endswith(".csv.gz") for f in files) and len(files) > 6000 // 700
    read = layers.read_orders_csv(spark, path, columns=list(RAW_NAMES))
    made = star.raw_lines(spark, "/root/testdata/sf0.001").replace("", None)
    assert Counter(map(tuple, read.collect())) == Counter(map(tuple, made.collect()))


def test_raw_text_goes_once_silver_is_written(spark):
    from pathlib import Path

    from orderlens.queries import QUERIES
    from orderlens.sources import scratch

    def kept():
        return {p for p in Path(scratch.scratch_root(spark)).rglob("raw_*") if p.is_dir()}

    before = kept()
    assert QUERIES["job_silver"](spark, "/root/testdata/sf0.001").count() == 6000
    assert kept() == before

"""Lines that do not fit are set apart with their reason; nothing is filled or cut."""

from __future__ import annotations

import pytest

from orderlens.sources import layers

COLUMNS = ["Order ID", "Brand", "Note"]
LINES = [
    "Order ID,Brand,Note",
    "1,a,x",
    '2,"b, c","said ""no"""',
    "3,,",
    "4,a",
    "5,a,x,more",
    '6,"a,x',
    "",
    '7,"a",""',
    "8",
    '9,"b, c",d,"e, f"',
    ",,,,",
    '10,a"b,c',
]


@pytest.fixture
def path(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(LINES[:7]) + "\n")
    (tmp_path / "in" / "b.csv").write_text("\n".join([LINES[0], *LINES[7:]]) + "\n")
    return str(tmp_path / "in")


def test_good_and_quarantined_rows_are_the_files_lines(spark, path):
    read = layers.read_orders_checked(spark, path, COLUMNS)
    assert read.rows.columns == COLUMNS
    assert sorted(map(tuple, read.rows.collect()), key=str) == sorted(
        [("1", "a", "x"), ("2", "b, c", 'said "no"'), ("3", None, None), ("7", "a", None), ("10", 'a"b', "c")],
        key=str,
    )
    assert sorted(map(tuple, read.quarantined.collect())) == sorted(
        [
            ("4,a", "too few fields", 2),
            ("5,a,x,more", "too many fields", 4),
            ('6,"a,x', "open quote", 3),
            ("8", "too few fields", 1),
            ('9,"b, c",d,"e, f"', "too many fields", 4),
            (",,,,", "too many fields", 5),
        ]
    )
    assert read.rows.count() + read.quarantined.count() == len([x for x in LINES[1:] if x])


def test_a_narrow_selection_still_counts_fields(spark, path):
    read = layers.read_orders_checked(spark, path, COLUMNS)
    assert read.rows.select("Brand").count() == 5 and read.quarantined.select("reason").count() == 6


def test_other_headers_are_refused(spark, path):
    with pytest.raises(Exception, match="(?i)header"):
        layers.read_orders_checked(spark, path, ["Order ID", "Note", "Brand"])


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("Order ID,Brand,Note\n")
    read = layers.read_orders_checked(spark, str(tmp_path / "e.csv"), COLUMNS)
    assert read.rows.count() == read.quarantined.count() == 0

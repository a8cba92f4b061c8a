"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import pytest

from orderlens.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, key):
    difference = differences(QUERIES[key](spark, SF_DIR), duck, ORACLES[key])
    assert difference is None, difference


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

from __future__ import annotations

from collections import Counter

from orderlens.queries import models

SCHEMA = "a long, b double, c string"
ROWS = [(1, 0.5, "x"), (1, 0.5, "x"), (2, None, None), (3, 1.0, "y"), (3, 1.0, "y"), (3, 1.0, "y")]
OTHERS = [(1, 0.5, "x"), (2, None, None), (2, None, None), (4, 1.0, "y"), (3, 1.0, "y")]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_tables_are_counted_against_each_other_in_one_shuffle(spark):
    rows, others = (spark.createDataFrame(r, SCHEMA) for r in (ROWS, OTHERS))
    found = models._differing(rows, others)
    a, b = Counter(ROWS), Counter(OTHERS)
    want = (len(ROWS), sum((a - b).values()) + sum((b - a).values()))
    assert shuffles(found) == 1
    assert [tuple(r) for r in found.collect()] == [want]
    same = models._differing(rows, rows).collect()
    none = models._differing(rows.limit(0), rows.limit(0)).collect()
    assert [tuple(r) for r in same + none] == [(len(ROWS), 0), (0, 0)]

"""Column expressions over whole texts, shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words: space, and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    A lambda computes what stands inside it for every element, and the optimizer may move a
    column's expression into a lambda that names it. A lambda's own variable stays a value.
    """
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def words(text: Column) -> Column:
    """Words between white space, in order; null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(parts, lambda w: w != "")


def spans(text: Column, pattern: Column) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, found>>.

    Offsets count code points; the end is exclusive. The text between two matches and the
    matches alternate, so a match starts after all earlier parts of both kinds.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern)
    pairs = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        found,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")),
    )
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,found:string>>").alias("spans"),
    )

    def step(state, pair):
        begins = state["at"] + pair["gap"]
        ends = begins + F.length(pair["hit"])
        span = F.struct(begins.alias("start"), ends.alias("end"), pair["hit"].alias("found"))
        return F.struct(
            ends.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")
        )

    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def join_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the array's order."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        ),
        ",",
    )


def covered(start: Column, end: Column, spans: Column) -> Column:
    """Whether some span of the array overlaps [start, end)."""
    return F.exists(spans, lambda s: (s["start"] < end) & (s["end"] > start))

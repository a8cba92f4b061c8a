"""Expressions that repair raw text columns.

Spark 4 runs in ANSI mode, where a bad cast or date fails the job. The cleaning
contract is that a bad value becomes null and is counted, so the ``try_`` forms
are used throughout.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens import fields

# digits with an optional fraction; an exponent or a type suffix is no integer
_WHOLE_OR_FRACTION = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"


# whitespace that is no single space; text without it only has to be trimmed
_UNEVEN = "[\\t-\\r]|  "
# year, month and day in as many digits as both readers of dates take
_PLAIN_DATE = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"


def clean_whitespace(text: Column) -> Column:
    """Trim spaces, then turn every run of whitespace into one space.

    ``trim`` removes spaces only, so a leading tab survives as a leading space. Only uneven text
    is rewritten, as the one element of an array, whose function stands outside the generated
    method: a wide table's would otherwise be too long for the JVM to compile.
    """

    def rewritten(value: Column) -> Column:
        return F.regexp_replace(F.trim(value), r"\s+", " ")

    uneven = F.transform(F.array(text), rewritten)[0]
    return F.when(text.rlike(_UNEVEN), uneven).otherwise(F.trim(text))


def to_double(text: Column) -> Column:
    """Text to double; outer whitespace is ignored and a bad value becomes null."""
    return text.try_cast("double")


def to_int(text: Column) -> Column:
    """Text to int, dropping a fraction ("3.7" -> 3); anything else becomes null."""
    return F.when(text.rlike(_WHOLE_OR_FRACTION), text.try_cast("double").try_cast("int"))


def yes_no_flag(text: Column) -> Column:
    """1 for yes/y/true/1 in any case, else 0; null counts as 0."""
    return F.when(text.rlike(fields.FLAG_PATTERN), 1).otherwise(0)


def ordinal(text: Column, levels: Mapping[str, int]) -> Column:
    """Position of a level name; names outside ``levels`` give null."""
    entries = [F.lit(part) for level in levels.items() for part in level]
    return F.create_map(*entries)[text]


def date_from_parts(month: Column, day: Column, year: Column) -> Column:
    """Date of three text or number columns; null where they form no date.

    Parts of the usual digits are cast as an ISO date, which spares the formatter and, where
    they form no date, its exception; all others go through the pattern.
    """
    texts = [part.cast("string") for part in (month, day, year)]
    m, d, y = [F.trim(text) for text in texts]
    plain = F.concat(y, F.lit("-"), m, F.lit("-"), d)
    parts = [clean_whitespace(text) for text in texts]
    return F.when(plain.rlike(_PLAIN_DATE), plain.try_cast("date")).otherwise(
        F.try_to_date(F.concat_ws("/", *parts), fields.DATE_PATTERN)
    )

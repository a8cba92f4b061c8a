"""Raw order text to the silver layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlens.operators import cleaning, quality, schema
from orderlens.sources import layers

# Numbers and dates ignore outer whitespace themselves, so text is cleaned after them:
# only columns that stay text pay for it, and the generated code stays small enough for
# the JVM to compile.
STEPS = [
    schema.normalize_columns,
    cleaning.rebuild_order_date,
    cleaning.cast_numerics,
    cleaning.clean_text,
    cleaning.normalize_flags,
    cleaning.lowercase_values,
    cleaning.add_membership_ordinal,
]


def to_silver(raw: DataFrame) -> DataFrame:
    """All cleaning steps; Catalyst merges them into one projection over the scan."""
    for step in STEPS:
        raw = step(raw)
    return raw


def job_silver(
    raw: DataFrame, path: str, fmt: str = layers.DEFAULT_FORMAT, csv_path: str | None = None
) -> dict[str, DataFrame]:
    """Clean once, write once; profile and CSV extract read the written layer."""
    silver = layers.write_layer(to_silver(raw), path, fmt)
    if csv_path:
        layers.write_csv(silver, csv_path)
    return {"silver": silver, "null_profile": quality.null_profile_long(silver)}

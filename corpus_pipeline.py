"""From raw documents to packed training sequences, stage by stage.

Every stage gets the documents its predecessor kept and returns documents again, except the
last, which returns packed pieces. Null or empty texts have no words and go at the first stage.
Empty tables pass through all stages. Documents may have further columns of any name: a row
travels as one struct beside what a stage measures. Ids may be null or stand on several rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import jaccard, mixing, packing, quality, secrets
from orderlens.llm.queries import tokenizer_path
from orderlens.sources import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``row``, all columns as one struct, and some columns beside it."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[F.col(f"`{c}`") for c in columns])


def _fields(docs: DataFrame, **replaced: Column) -> list[Column]:
    """The columns of ``row``, in order, some of them replaced."""
    row = F.col("row")
    return [replaced.get(c, row.getField(c)).alias(c) for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the web policy keeps."""
    entries = quality.ledger(_packed(docs, "text"), keep=["row"])
    return entries.where(quality.kept(quality.STRICT)).select(*_fields(docs))


def _without(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Documents whose id is not in ``ids``, whole numbers, broadcast only if they are few."""
    small = ids.limit(jaccard.BROADCAST_ROWS + 1).count() <= jaccard.BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if small else ids, id_col, "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Ids name rows only if each stands on one row. Where some are null or repeated, all rows are
    numbered and written first, and the numbers stand for the ids; the smallest id still
    stays, the first of equal ones, and one without an id only if its whole group has none.
    Documents without words resemble nothing and stay.
    """
    ids = docs.select(F.col("doc_id"))
    named = ids.groupBy("doc_id").count().where(F.col("doc_id").isNull() | (F.col("count") > 1))
    if scratch.durable(named, "pipeline-repeated-ids").isEmpty():
        linked = scratch.durable(jaccard.join(docs), "pipeline-links")
        return _without(docs, linked.where("component_id <> doc_id").select("doc_id"), "doc_id")
    numbered = scratch.durable(
        _packed(docs, "doc_id", "text").withColumn("number", F.monotonically_increasing_id()),
        "pipeline-numbered",
    )
    groups = jaccard.join(numbered, id_col="number").join(
        numbered.select("number", "doc_id"), "number"
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "number"))
    linked = scratch.durable(groups, "pipeline-links")
    kept = linked.groupBy("component_id").agg(first["number"].alias("kept"))
    copies = (
        linked.join(kept, "component_id").where("number <> kept").select("number")
    )
    return _without(numbered, scratch.durable(copies, "pipeline-copies"), "number").select(
        *_fields(docs)
    )


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and ``n_chars`` counted anew."""
    found = secrets.find_secrets(_packed(docs, "text"), keep=["row", "text"])
    clean = secrets.redact(F.col("text"), secrets.all_spans(F.col("fixed"), F.col("random")))
    found = found.select("row", clean.alias("text"))
    n_chars = F.length("text").cast("long")
    return found.select(*_fields(docs, text=F.col("text"), n_chars=n_chars))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, ordered so that the sources alternate by their target weights.

    Rows come by id and text, so that rows without an id are not one group.
    """
    rows = _packed(docs, "doc_id", "source").withColumn("print", F.xxhash64(F.col("row.text")))
    mixed = mixing.mix(rows, order_cols=("doc_id", "print"))
    ordered = mixed.repartitionByRange("mix_position").sortWithinPartitions("mix_position")
    return ordered.select(*_fields(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of all documents, in the order of the mixture within each file."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: Tokenizing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.

    What a stage wrote on its way is deleted once its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch.scratch_path(spark, name)
        with scratch.scope(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Readers and writers of the layered tables (raw, silver, feature, model)."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources import files, fingerprint, scratch

DEFAULT_FORMAT = "parquet"
#: Formats whose layers are written version by version; of these, those that keep values exactly.
VERSIONED_FORMATS = ("parquet", "orc", "json", "csv", "avro")
EXACT_FORMATS = ("parquet", "orc")
KEPT_VERSIONS = 2
_POINTER = "_current"
# an append's folder and the folder of markers
_ATTEMPT, _MARKERS = "attempt__", "_appended"


def read_orders_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Raw orders with every column as text.

    Records are single lines, so large files split. With ``columns`` the header is
    checked against them instead of being read in a job of its own.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", False)
    if columns is not None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


@dataclass
class CheckedRead:
    """``rows``: the records that fit; ``quarantined``: line and reason of all others."""

    rows: DataFrame
    quarantined: DataFrame


def read_orders_checked(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool = True
) -> CheckedRead:
    """Raw orders as text, with lines that do not fit the columns set apart.

    A record with too few or too many fields is no order: the plain reader would fill it with
    nulls or cut it, so that values could stand under the wrong header. Here it keeps its
    whole line and a reason: ``too few fields``, ``too many fields`` or ``open quote``, and its
    number of fields. Good and quarantined rows together are the file's lines, without
    headers and blank lines. The file is parsed once; both tables read what that wrote.
    """
    broken = "line__"
    if broken in columns:
        raise ValueError(f"{broken} is no column of an order")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, broken]])
    parsed = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", broken)
        # a pruned read would not count the fields
        .option("columnPruning", False)
        .csv(path)
    )
    written = scratch.durable(parsed, "parsed-orders")
    line = F.col(broken)
    # a quoted stretch is one value, commas and doubled quotes included
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "q")
    fields = F.size(F.split(bare, ","))
    reason = (
        F.when(F.contains(bare, F.lit('"')), "open quote")
        .when(fields < len(columns), "too few fields")
        .when(fields > len(columns), "too many fields")
        .otherwise("unreadable")
    )
    return CheckedRead(
        written.where(line.isNull()).select(*[F.col(f"`{c}`") for c in columns]),
        written.where(line.isNotNull()).select(
            line.alias("line"), reason.alias("reason"), fields.alias("fields")
        ),
    )


def read_layer(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, version: str | None = None, **options
) -> DataFrame:
    """A layer by path, or with ``fmt="table"`` by catalog name, as ``save_tables`` left it.

    A layer that ``write_layer`` wrote is read in its current version, or in a named one. The
    frame stays with that version: a later overwrite does not change what it reads.
    Formats other than Spark's own (Delta, say) need their package, which is not tested here.
    """
    if fmt == "table":
        return spark.read.options(**options).table(path)
    pointer = _pointer(spark, path)
    if pointer is None:
        if version:
            raise ValueError(f"{path} has no versions")
        return spark.read.format(fmt).options(**options).load(path)
    known = {entry["version"]: entry for entry in pointer}
    entry = known.get(version) if version else pointer[0]
    if entry is None:
        raise ValueError(f"{path} has no version {version}, but {', '.join(known)}")
    schema = T.StructType.fromJson(entry["schema"])
    return (
        spark.read.format(entry["format"])
        .options(**options)
        .schema(schema)
        .load(f"{path}/{entry['version']}")
    )


def _pointer(spark: SparkSession, path: str) -> list[dict] | None:
    """The versions of a layer, the current one first, or None if it has none."""
    text = files.read_text(spark, f"{path}/{_POINTER}")
    return json.loads(text) if text else None


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions that can be read, the current one first."""
    return [entry["version"] for entry in _pointer(spark, path) or []]


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the files of a layer's current version lie; a folder without versions is its own."""
    found = versions(spark, path)
    return f"{path}/{found[0]}" if found else path


def stored_fingerprint(spark: SparkSession, path: str) -> fingerprint.Fingerprint | None:
    """What the current version's rows came to when they were written, if its format tells."""
    pointer = _pointer(spark, path)
    return pointer[0].get("fingerprint") if pointer else None


def write_layer(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    keep: int = KEPT_VERSIONS,
    fingerprinted: bool = True,
    **options,
) -> DataFrame:
    """Replace a layer, schema included, and return the frame that reads it.

    The rows go to a folder of their own, beside those of earlier versions; then one rename of
    a small file makes them the layer. Until then, and if writing fails, the layer is as it
    was, and frames opened before keep reading their version. The last ``keep`` versions
    are kept. Of two writers at once, the last to end wins, with all of its rows. Formats with
    a transaction log of their own (Delta) are overwritten in place.
    The fingerprint of the rows is taken from the files before they become the layer and is
    stored with the version; without ``fingerprinted`` that read is spared.

    Consumers should go on from the returned frame, so the plan behind ``df`` runs once.
    """
    spark = df.sparkSession
    if fmt == "parquet":
        options.setdefault("compression", "zstd")
    if fmt not in VERSIONED_FORMATS:
        if fmt == "delta":
            options.setdefault("overwriteSchema", True)
        writer = df.write.format(fmt).mode("overwrite").options(**options)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
        return read_layer(spark, path, fmt)
    version = f"v-{uuid.uuid4().hex[:16]}"
    target = f"{path}/{version}"
    schema = _read_schema(df, partition_by)
    entry = {"version": version, "format": fmt, "schema": schema.jsonValue()}
    writer = df.write.format(fmt).mode("errorifexists").options(**options)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).save(target)
        if fingerprinted and fmt in EXACT_FORMATS:
            entry["fingerprint"] = fingerprint.of(spark.read.format(fmt).schema(schema).load(target))
    except BaseException:
        files.delete(spark, target)
        raise
    history = [entry, *(_pointer(spark, path) or [])]
    files.replace_text(spark, f"{path}/{_POINTER}", json.dumps(history[:keep]))
    for old in history[keep:]:
        files.delete(spark, f"{path}/{old['version']}")
    return read_layer(spark, path, fmt)


def _read_schema(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """The schema as files give it back: all nullable, partition columns last."""
    last = set(partition_by)
    ordered = [f for f in df.schema.fields if f.name not in last]
    ordered += [df.schema[name] for name in partition_by]
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in ordered])


def append_rows(
    df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, run_id: str | None = None
) -> DataFrame:
    """Append to a log and return all of it; columns new in ``df`` are null in older rows."""
    commit_rows(df, path, fmt, run_id)
    return read_log(df.sparkSession, path, fmt)


def commit_rows(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    run_id: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Append to a log.

    Every append writes a folder of its own and then a marker that names it, so appenders
    at the same time do not meet, and rows of an append that died before its marker are never
    read. ``run_id`` names what is logged: of several appends with the same one, such as
    a retry, only the first that ended counts. Without it every append counts.
    """
    spark = df.sparkSession
    attempt = f"a-{uuid.uuid4().hex}"
    folder = f"{path}/{_ATTEMPT}={attempt}"
    try:
        writer = df.write.format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(folder)
    except BaseException:
        files.delete(spark, folder)
        raise
    marker = {
        "run_id": attempt if run_id is None else run_id,
        "attempt": attempt,
        "ended_at": time.time_ns(),
    }
    files.replace_text(spark, f"{path}/{_MARKERS}/{attempt}.json", json.dumps(marker))


def _counted(spark: SparkSession, path: str) -> DataFrame:
    """Folders that count: of each run, the first attempt that ended."""
    markers = spark.read.schema("run_id string, attempt string, ended_at long").json(
        f"{path}/{_MARKERS}"
    )
    first = F.min(F.struct("ended_at", "attempt")).alias("first")
    return markers.groupBy("run_id").agg(first).select("run_id", F.col("first.attempt").alias(_ATTEMPT))


def logged_runs(spark: SparkSession, path: str) -> DataFrame:
    """``run_id`` of every run whose rows count, none if nothing was appended."""
    if not files.children(spark, f"{path}/{_MARKERS}"):
        return spark.range(0).select(F.col("id").cast("string").alias("run_id"))
    return _counted(spark, path).select("run_id")


def read_log(
    spark: SparkSession,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    runs: DataFrame | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """All rows that ``append_rows`` committed, each run's once, or those of some ``run_id``.

    A folder without markers, as other writers leave it, is read as it is. With a ``schema``
    no file is opened to learn its columns.
    """
    merge = {"mergeSchema": True} if fmt in ("parquet", "orc", "delta") and not schema else {}
    if not files.children(spark, f"{path}/{_MARKERS}"):
        return read_layer(spark, path, fmt, **merge)
    reader = spark.read.format(fmt).options(**merge)
    if schema:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(_ATTEMPT, T.StringType())]))
    counted = _counted(spark, path)
    if runs is not None:
        counted = counted.join(runs, "run_id", "left_semi")
    return reader.load(path).join(counted.select(_ATTEMPT), _ATTEMPT, "left_semi").drop(_ATTEMPT)


def forget_uncounted(spark: SparkSession, path: str) -> list[str]:
    """Delete folders that lost to an earlier attempt of their run; returns their names.

    Folders without a marker stay, since their append may not have ended. Frames that were
    opened before may name deleted files, so this belongs where no one reads.
    """
    counted = {row[_ATTEMPT] for row in _counted(spark, path).collect()}
    ended = {name.removesuffix(".json") for name in files.children(spark, f"{path}/{_MARKERS}")}
    lost = sorted(ended - counted)
    for attempt in lost:
        files.delete(spark, f"{path}/{_MARKERS}/{attempt}.json")
        files.delete(spark, f"{path}/{_ATTEMPT}={attempt}")
    return lost


def exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def write_csv(
    df: DataFrame, path: str, compression: str | None = None, rows_per_file: int | None = None
) -> None:
    """CSV with header, one file per task; text keeps its outer spaces.

    A compressed file is read by one task, so large tables need ``rows_per_file`` with it.
    """
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (
        writer
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_csv_single(df: DataFrame, path: str) -> None:
    """CSV extract in one file, whatever its size: one task writes it, because one file was asked.

    The rows are computed in parallel and kept in a scratch table; only their copy into
    the extract is a single task. ``write_csv`` is the way without one.
    """
    write_csv(scratch.durable(df, "extract").repartition(1), path)


def save_tables(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, DataFrame],
    location: str | None = None,
) -> None:
    """Save tables in a database, without changing the current database.

    Each is a versioned layer in the database's folder, and a view names its current version.
    Replacing the view is one change of the catalog, schema included: a reader gets all old or
    all new rows. A table of that name that was not saved here gives way to the view.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    folder = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    for name, df in tables.items():
        path = f"{folder}/{name}_versions"
        write_layer(df, path)
        current = files.qualified(spark, f"{path}/{versions(spark, path)[0]}")
        full = f"{database}.`{name}`"
        if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
            spark.sql(f"DROP TABLE {full}")
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT * FROM {DEFAULT_FORMAT}.`{current}`")


def rows_to_table(spark: SparkSession, rows: Sequence, schema: str | T.StructType) -> DataFrame:
    """A small list of driver rows as a table with declared types."""
    return spark.createDataFrame(list(rows), schema)


def preview(df: DataFrame, n: int, order: Sequence | None = None) -> DataFrame:
    """First ``n`` rows; only an order makes the choice repeatable."""
    return (df.orderBy(*order) if order else df).limit(n)


def layer_counts(
    layers: Mapping[str, DataFrame],
    stored: Mapping[str, fingerprint.Fingerprint | None] | None = None,
) -> DataFrame:
    """Read-back check: one row per layer with its row and column count, and whether it is sound.

    ``stored``: fingerprints taken when the layers were written. A layer is ``ok`` if its rows
    are still those, none changed, lost or doubled; null if there is nothing to compare with.
    """
    return _stack(
        [
            _measured(df, name, (stored or {}).get(name))
            .withColumn("columns", F.lit(len(df.columns)))
            .select("layer", "rows", "columns", F.col("sound").alias("ok"))
            for name, df in layers.items()
        ]
    )


def artifact_check(
    layers: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]] | None = None,
    stored: Mapping[str, fingerprint.Fingerprint | None] | None = None,
) -> DataFrame:
    """One row per final output: is it there, with rows, its required columns and, where a
    fingerprint was stored, exactly the rows that were written?"""
    parts = []
    for name, df in layers.items():
        missing = sorted(set((required or {}).get(name, ())) - set(df.columns))
        sound = F.coalesce("sound", F.lit(True))
        parts.append(
            _measured(df, name, (stored or {}).get(name)).select(
                "layer",
                "rows",
                F.lit(", ".join(missing)).alias("missing_columns"),
                (F.lit(not missing) & (F.col("rows") > 0) & sound).alias("ok"),
            )
        )
    return _stack(parts)


def _measured(df: DataFrame, name: str, stored: fingerprint.Fingerprint | None) -> DataFrame:
    """layer, rows and sound: null without a fingerprint, whose aggregate is spared then."""
    if stored is None:
        counted, sound = df.agg(F.count("*").alias("rows")), F.lit(None).cast("boolean")
    else:
        counted, sound = df.agg(*fingerprint.aggregates(df)), fingerprint.equals(stored)
    return counted.select(
        F.lit(name).alias("layer"), F.col("rows").cast("long").alias("rows"), sound.alias("sound")
    )


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result

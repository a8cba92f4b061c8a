"""Run registry: experiments, runs, tags, metrics and params as tables.

The tables can be layers or, where a database holds them, JDBC reads; every lookup
is a join or an aggregate over DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FINISHED = "FINISHED"

# newest finished run of each experiment that carries a tag
LATEST_RUN_SQL = """
SELECT e.name AS experiment_name,
       max_by(r.run_uuid, struct(r.start_time, r.run_uuid)) AS run_id,
       max(r.start_time) AS start_time
FROM {experiments} e
JOIN {runs} r ON r.experiment_id = e.experiment_id
JOIN {tags} t ON t.run_uuid = r.run_uuid
WHERE t.key = :tag_key AND t.value = :tag_value AND r.status = :status
GROUP BY e.name
"""


def read_registry_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A registry table that lives in a database; filters and columns are pushed to it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def latest_runs_sql(
    spark: SparkSession,
    experiments: DataFrame,
    runs: DataFrame,
    tags: DataFrame,
    tag_key: str,
    tag_value: str,
    status: str = FINISHED,
) -> DataFrame:
    """Per experiment name, the newest run with the tag and status, looked up in SQL."""
    return spark.sql(
        LATEST_RUN_SQL,
        args={"tag_key": tag_key, "tag_value": tag_value, "status": status},
        experiments=experiments,
        runs=runs,
        tags=tags,
    )


def latest_finished_runs(
    runs: DataFrame,
    tags: DataFrame,
    tag_key: str,
    tag_value: str,
    experiment_id=None,
    status: str = FINISHED,
) -> DataFrame:
    """The newest run per experiment (or of one) that carries a tag and has the status.

    An aggregate rather than a ranking window: it combines before the shuffle, so an
    experiment with most of the runs is no hot group.
    """
    wanted = runs.filter(F.col("status") == status)
    if experiment_id is not None:
        wanted = wanted.filter(F.col("experiment_id") == experiment_id)
    tagged = tags.filter((F.col("key") == tag_key) & (F.col("value") == tag_value))
    newest = F.max(F.struct("start_time", "run_uuid")).alias("newest")
    return (
        wanted.join(tagged.select("run_uuid"), on="run_uuid")
        .groupBy("experiment_id")
        .agg(newest)
        .select(
            "experiment_id",
            F.col("newest.run_uuid").alias("run_id"),
            F.col("newest.start_time").alias("start_time"),
        )
    )


def key_values_wide(
    pairs: DataFrame, run: str, key: str, value: str, keys: Sequence[str]
) -> DataFrame:
    """Key/value rows of each run as one wide row with the named keys."""
    return pairs.groupBy(run).pivot(key, list(keys)).agg(F.max(value))


def missing_keys(wide: DataFrame, run: str, keys: Sequence[str]) -> DataFrame:
    """Runs that lack one of the keys, with the names they lack."""
    absent = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]))
    return wide.select(run, absent.alias("missing")).filter(F.size("missing") > 0)


def run_log_row(
    spark: SparkSession, run_id: str, experiment: str, values: Mapping[str, object], logged_at
) -> DataFrame:
    """One run-log row with declared types, ready to be appended."""
    return spark.createDataFrame(
        [
            (
                run_id, experiment, values["test_auc"], values["test_accuracy"],
                values["test_f1"], values["train_rows"], values["test_rows"],
                values["num_trees"], values["max_depth"], logged_at,
            )
        ],
        "run_id string, experiment_name string, test_auc double, test_accuracy double, "
        "test_f1 double, train_rows bigint, test_rows bigint, num_trees bigint, "
        "max_depth bigint, logged_at_utc timestamp_ntz",
    )


def latest_run(log: DataFrame) -> DataFrame:
    """Newest row of the run log."""
    return log.orderBy(F.desc("logged_at_utc"), F.asc("run_id")).limit(1)

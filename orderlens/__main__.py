"""Jobs for ``spark-submit``: ``python -m orderlens <job> --help``.

Master, memory and shared folders come from the session's own configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderlens import fields
from orderlens.operators import forest
from orderlens.plans import features, scoring, silver, training
from orderlens.sources import layers, scratch
from orderlens.streaming import scoring as streaming


def run_silver(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = layers.read_orders_csv(spark, args.input)
    written = silver.job_silver(raw, args.output, args.format, args.csv)
    written["null_profile"].show(200, truncate=False)


def run_features(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = layers.read_layer(spark, args.input, args.format)
    written = features.job_features(lines, args.output, args.format, args.csv, args.database)
    layers.layer_counts(written).show(truncate=False)


def _settings(args: argparse.Namespace) -> training.ForestSettings:
    options = {"hash_features": args.hash_features} if args.hash_features else {}
    return training.ForestSettings(
        args.trees, args.depth, args.balanced_trees, args.balanced_depth, options
    )


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = layers.read_layer(spark, args.input, args.format)
    written = training.job_train_tune_compare(
        lines, args.output, _settings(args), fmt=args.format,
        validation_percent=args.validation_percent,
    )
    written["rf_model_comparison"].show(truncate=False)


def run_prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = layers.read_layer(spark, args.input, args.format)
    training.write_splits(
        lines, args.output, fmt=args.format, validation_percent=args.validation_percent
    )


def run_stage(spark: SparkSession, args: argparse.Namespace) -> None:
    """One training stage over the layers below ``--output``."""
    if args.job == "tune":
        training.job_tune(spark, args.output, args.format)
    elif args.job == "compare":
        training.job_compare(spark, args.output, args.format)
    else:
        stage = {"fit": training.job_train, "balance": training.job_balance}[args.job]
        stage(spark, args.output, _settings(args), args.format)


def _defaults(spark: SparkSession, args: argparse.Namespace) -> dict[str, float] | None:
    if not args.defaults:
        return None
    return scoring.read_defaults(layers.read_layer(spark, args.defaults, args.format))


def run_score(spark: SparkSession, args: argparse.Namespace) -> None:
    records = layers.read_layer(spark, args.input, args.format)
    model = forest.load_model(args.model)
    scored = scoring.score_batch(model, records, args.threshold, args.keep, _defaults(spark, args))
    layers.write_layer(scored, args.output, args.format)


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    given = args.schema_from and layers.read_layer(spark, args.schema_from, args.format).schema
    records = streaming.read_records(
        spark, layers.current_folder(spark, args.input), given or scoring.RECORD_SCHEMA, args.format
    )
    streaming.stream_score(
        forest.load_model(args.model), records, args.output, args.checkpoint, args.threshold,
        args.keep, args.interval, args.format, _defaults(spark, args),
    ).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="orderlens")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, about: str, reads: bool = True) -> argparse.ArgumentParser:
        command = jobs.add_parser(name, help=about)
        if reads:
            command.add_argument("--input", required=True)
        command.add_argument("--output", required=True)
        command.add_argument("--format", default=layers.DEFAULT_FORMAT)
        command.set_defaults(run=run)
        return command

    command = job("silver", run_silver, "clean raw order CSV files")
    command.add_argument("--csv", help="folder for a CSV extract")
    command = job("features", run_features, "customer and product features of a silver layer")
    command.add_argument("--csv", help="folder for CSV extracts")
    command.add_argument("--database", help="catalog database to save the tables in")
    for name, run, about, reads in (
        ("train", run_train, "train, tune and compare both models on a silver layer", True),
        ("prepare", run_prepare, "feature layer, splits and scoring defaults", True),
        ("fit", run_stage, "plain forest on the prepared splits", False),
        ("balance", run_stage, "forest with balanced classes on the prepared splits", False),
        ("tune", run_stage, "threshold of the plain forest", False),
        ("compare", run_stage, "comparison of both models, and a check of all outputs", False),
    ):
        command = job(name, run, about, reads)
        if name in ("train", "prepare"):
            command.add_argument("--validation-percent", type=int, default=0)
        if name in ("train", "fit", "balance"):
            command.add_argument("--trees", type=int, default=fields.FOREST_TREES)
            command.add_argument("--depth", type=int, default=fields.FOREST_DEPTH)
            command.add_argument("--balanced-trees", type=int, default=fields.BALANCED_TREES)
            command.add_argument("--balanced-depth", type=int, default=fields.BALANCED_DEPTH)
            command.add_argument("--hash-features", type=int, help="hash categories to this width")
    for name, run, about in (
        ("score", run_score, "score a table of transaction records"),
        ("stream", run_stream, "score transaction files as they arrive"),
    ):
        command = job(name, run, about)
        command.add_argument("--model", required=True)
        command.add_argument("--threshold", type=float, default=fields.SERVING_THRESHOLD)
        command.add_argument("--keep", nargs="*", default=[], help="columns to carry along")
        command.add_argument("--defaults", help="layer of scoring defaults, such as rf_defaults")
        if name == "stream":
            command.add_argument("--checkpoint", required=True)
            command.add_argument("--interval", help="such as '1 minute'; else run once")
            command.add_argument("--schema-from", help="layer whose schema the files have")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"orderlens-{args.job}").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        scratch.drop_scratch(spark)


if __name__ == "__main__":
    main()

"""Jobs for spark-submit: bootstrap, build, train, cycle, score, score-stream, attribute-stream,
compact-masks, labels, evaluate, calibrate, importance, check.

    python -m feedloom build --tables /data/tables --out /data/training --start 2024-03-01
    python -m feedloom score --data /data/items --runs /data/training_runs --keep id --out /data/scored
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from feedloom.operators.summary import dataset_rates
from feedloom.plans import cycle, dataset, evaluation, scoring, training
from feedloom.sources import bootstrap, datasets, masks, tables
from feedloom.streaming import attribution
from feedloom.streaming.scoring import score_stream


def time(text: str) -> datetime:
    """An ISO time; UTC where it names no zone."""
    found = datetime.fromisoformat(text)
    return found if found.tzinfo else found.replace(tzinfo=timezone.utc)


def pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def jdbc_range(text: str) -> tuple[str, tuple]:
    """table:column:low:high:parts."""
    table, column, low, high, parts = text.split(":")
    return table, (column, low, high, int(parts))


def load(spark: SparkSession, args) -> dict:
    if args.jdbc:
        return tables.from_jdbc(spark, pairs(args.jdbc), dict(map(jdbc_range, args.jdbc_range)))
    if args.tables:
        return tables.from_parquet(spark, args.tables)
    return tables.from_catalog(spark, args.database)


def build(spark, args):
    """The dataset of all impressions, of a time range, whose rows replace those of the range in
    ``--out`` and leave the others, or of the newest, which replace all that is there."""
    kept = masks.kept_masks(spark, args.masks_table) if args.masks_table else None
    frame = dataset.build_dataset(
        load(spark, args), start=args.start, end=args.end, limit=args.limit, kept=kept)
    if args.limit is None:
        datasets.write_range(frame, args.out, args.start, args.end)
    else:
        datasets.write_dataset(frame, args.out, whole=True)
    dataset_rates(datasets.read_dataset(spark, args.out)).show()


def train(spark, args):
    task = {"engagement": training.ENGAGEMENT, "commerce": training.COMMERCE}[args.task]
    print(training.train(spark, task, args.data, args.out)[1])


def run_cycle(spark, args):
    config = cycle.CycleConfig(dataset_limit=args.limit, check_tables=args.check_tables)
    print(cycle.run_cycle(
        spark, load(spark, args), args.out, args.synthetic, config, args.force, args.trigger))


def score(spark, args):
    """Score stored requests with the active models."""
    models = scoring.active_models(spark, args.runs) if args.runs else (None, None)
    scoring.score(spark.read.parquet(args.data[0]), models, args.keep).write.parquet(args.out)


def stream_of(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def run_score_stream(spark, args):
    score_stream(
        stream_of(spark, args.data[0]), args.runs, args.out, args.checkpoint, args.keep,
        trigger(args)).awaitTermination()


def attribute_stream(spark, args):
    """Masks of the logs in the folder of tables, as they arrive."""
    found = attribution.attribute_stream(
        stream_of(spark, f"{args.tables}/scroll_impressions"),
        stream_of(spark, f"{args.tables}/scroll_interactions"), salts=args.salts)
    found.writeStream.format("parquet").option("checkpointLocation", args.checkpoint).trigger(
        **trigger(args)).start(args.out).awaitTermination()


def trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": "10 seconds"}


def compact_masks(spark, args):
    """Merge the masks that a stream has written into the kept table, which ``build`` can join."""
    masks.compact_masks(spark.read.parquet(args.data[0]), args.masks_table, args.buckets, args.id_type)


def labels(spark, args):
    """Labels of all impressions by the masks that a stream has written."""
    shown = load(spark, args)["scroll_impressions"]
    attribution.stream_labels(shown, spark.read.parquet(args.data[0])).write.parquet(args.out)


def evaluate(spark, args):
    for report in evaluation.shadow_report(datasets.read_dataset(spark, args.data[0])):
        report.show(truncate=False)


def calibrate(spark, args):
    for report in evaluation.calibration_report(datasets.read_dataset(spark, args.data[0])):
        report.show(truncate=False)


def check(spark, args):
    """Missing tables and columns, columns of wrong types, keys that are null, and keys of the item
    and user tables that occur twice."""
    if not args.jdbc and not args.tables:
        missing = tables.missing_tables(spark, database=args.database)
        print("missing tables:", missing)
        if missing:
            return
    found = load(spark, args)
    print("missing columns:", tables.missing_columns(found))
    print("wrong types:", tables.wrong_types(found))
    print("null keys:", tables.null_keys(found))
    print("repeated keys:", tables.repeated_keys(found))


JOBS = {
    "bootstrap": lambda spark, args: bootstrap.bootstrap(spark, args.rows).write.parquet(args.out),
    "build": build,
    "train": train,
    "cycle": run_cycle,
    "score": score,
    "score-stream": run_score_stream,
    "attribute-stream": attribute_stream,
    "compact-masks": compact_masks,
    "labels": labels,
    "evaluate": evaluate,
    "calibrate": calibrate,
    "importance": lambda spark, args: training.feature_importance(
        PipelineModel.load(args.model)).show(50, truncate=False),
    "check": check,
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="feedloom")
    parser.add_argument("job", choices=list(JOBS))
    parser.add_argument("--tables", help="folder of Parquet tables; default: the catalog")
    parser.add_argument("--database")
    parser.add_argument("--jdbc", nargs="+", default=[], metavar="OPTION=VALUE",
                        help="read the tables from a database: url=..., user=..., driver=...")
    parser.add_argument("--jdbc-range", nargs="+", default=[], metavar="TABLE:COLUMN:LOW:HIGH:PARTS",
                        help="read a table by parallel range queries")
    parser.add_argument("--start", type=time, help="first time of the impressions to build")
    parser.add_argument("--end", type=time, help="time before which they lie")
    parser.add_argument("--data", nargs="+", help="input paths in order of preference")
    parser.add_argument("--runs", help="ledger of training runs; its active models score")
    parser.add_argument("--keep", nargs="+", help="id columns to carry along")
    parser.add_argument("--checkpoint", help="checkpoint folder of a stream")
    parser.add_argument("--once", action="store_true", help="stop a stream when its input is read")
    parser.add_argument("--masks-table", help="catalog table of kept label masks, see compact-masks")
    parser.add_argument("--buckets", type=int, default=256, help="buckets of a new masks table")
    parser.add_argument("--id-type", default="bigint", help="type of the impressions' ids")
    parser.add_argument("--salts", type=int, default=1)
    parser.add_argument("--synthetic", help="synthetic dataset for the cycle's fallback")
    parser.add_argument("--task", choices=["engagement", "commerce"], default="engagement")
    parser.add_argument("--model")
    parser.add_argument("--out")
    parser.add_argument("--rows", type=int, default=10_000)
    parser.add_argument("--limit", type=int, help="keep only the newest impressions")
    parser.add_argument("--trigger", default="manual")
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--check-tables", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    JOBS[args.job](SparkSession.builder.appName(f"feedloom {args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()

"""Ledger of training runs: one appended row per state change, never rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.tables import path_exists

MODEL = (
    "task string, dataset_path string, used_fallback_dataset boolean, target string, "
    "auc_roc double, row_count bigint, positive_count bigint, negative_count bigint, "
    "model_path string"
)
SUMMARY = (
    "rows bigint, click_positives bigint, purchase_positives bigint, "
    "checkout_start_positives bigint, add_to_cart_positives bigint, "
    "product_click_positives bigint, product_view_positives bigint, commerce_positives bigint, "
    "click_rate double, commerce_rate double"
)
CONFIG = (
    "dataset_limit int, "
    "min_rows int, min_click_positives int, min_commerce_positives int, "
    "allow_synthetic_fallback_promotion boolean, retain_artifact_runs int, check_tables boolean"
)
LEDGER_SCHEMA = (
    "run_id string, trigger string, state string, started_at timestamp, completed_at timestamp, "
    f"recorded_at timestamp, config struct<{CONFIG}>, dataset_summary struct<{SUMMARY}>, "
    f"engagement struct<{MODEL}>, commerce struct<{MODEL}>, "
    "promotion_allowed boolean, promotion_reasons array<string>, promoted boolean, error string"
)


def append(spark: SparkSession, path: str, entry: dict) -> None:
    """Add one row; fields not in ``entry`` are null."""
    names = [f.name for f in spark.createDataFrame([], LEDGER_SCHEMA).schema]
    row = tuple(entry.get(name) for name in names)
    spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def newest_of(entries: DataFrame) -> DataFrame:
    """The entry recorded last; no row if there is none."""
    latest = entries.agg(F.max_by(F.struct(*entries.columns), "recorded_at").alias("entry"))
    return latest.where("entry is not null").select("entry.*")


def promoted(entries: DataFrame) -> DataFrame:
    return entries.where("state = 'completed' and promoted")


def newest_entry(entries: DataFrame) -> Row | None:
    return newest_of(entries).head()


def latest(spark: SparkSession, path: str) -> Row | None:
    """The most recent row, whatever its state."""
    return newest_entry(read(spark, path))


def active(spark: SparkSession, path: str) -> Row | None:
    """The most recently promoted run; its model paths are the active ones."""
    return newest_entry(promoted(read(spark, path)))


def completed_runs(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path).where("state = 'completed'")

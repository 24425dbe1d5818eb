"""Writing and reading training datasets."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contracts import DATASET_COLUMNS
from feedloom.operators.frames import training_frame
from feedloom.sources.files import delete_folder, file_names, set_checkpoint_dir
from feedloom.sources.tables import path_exists

#: A dataset's partition column.
DATE = "event_date"


def event_date(time: str = "impressed_at") -> Column:
    """The UTC date of a row."""
    return F.to_date(F.to_utc_timestamp(time, F.current_timezone()))


def write_dataset(df: DataFrame, path: str, whole: bool = False) -> None:
    """Write the training frame as Parquet, partitioned by event date (UTC date of impressed_at).

    The dates that ``df`` holds replace themselves and all other dates stay; with ``whole`` the frame
    replaces the dataset. Rows are rebalanced by date first: each date gets few large files, and a
    date that is much larger than the others is split over several tasks.
    """
    dated = df.withColumn(DATE, event_date())
    dated.hint("rebalance", DATE).write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if whole else "dynamic").partitionBy(DATE).parquet(path)


def write_range(df: DataFrame, path: str, start: datetime | None = None, end: datetime | None = None) -> None:
    """Make ``df`` the dataset's rows of [start, end); rows outside the range stay.

    Whole dates in the range replace themselves. Of the dates at its edges the rows outside the range
    are kept: they are stored first and written with the new ones. A date in the range that has no
    row any more goes last, so a job that fails leaves old or new dates, never a gap, and can be
    repeated. Without bounds the dataset is replaced. Rows without a time belong to no range.
    """
    if start is None and end is None:
        return write_dataset(df, path, whole=True)
    spark = df.sparkSession
    before = {}
    if path_exists(spark, path):
        before = {day: file_names(spark, date_folder(path, day))
                  for day in stored_dates(spark, path) if in_range(day, start, end)}
        set_checkpoint_dir(spark)
        edges = edge_dates(start, end)
        outside = F.lit(False)
        if start is not None:
            outside = outside | (F.col("impressed_at") < F.lit(start))
        if end is not None:
            outside = outside | (F.col("impressed_at") >= F.lit(end))
        kept = training_frame(dated_rows(spark, path).where(F.col(DATE).isin(edges) & outside))
        df = df.unionByName(kept.checkpoint())
    write_dataset(df, path)
    for day, files in before.items():
        # A write names its files anew, so a date that still has one of its files was not written.
        if files & file_names(spark, date_folder(path, day)):
            delete_folder(spark, date_folder(path, day))


def date_folder(path: str, day: date) -> str:
    return f"{path}/{DATE}={day}"


def utc(moment: datetime) -> datetime:
    return moment.astimezone(timezone.utc)


def edge_dates(start: datetime | None, end: datetime | None) -> list[date]:
    """The dates that the range covers in part."""
    return [utc(bound).date() for bound in (start, end)
            if bound is not None and utc(bound).time() != datetime.min.time()]


def in_range(day: date, start: datetime | None, end: datetime | None) -> bool:
    """Whether a date has a moment in [start, end)."""
    begin = datetime.combine(day, datetime.min.time(), timezone.utc)
    return (start is None or begin + timedelta(days=1) > start) and (end is None or begin < end)


def dated_rows(spark: SparkSession, path: str) -> DataFrame:
    """A dataset as it is stored. Dates may hold different columns; absent ones are null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def stored_dates(spark: SparkSession, path: str) -> set[date]:
    """The dates of a dataset; answered from its folders' names."""
    return {r[0] for r in spark.read.parquet(path).select(DATE).distinct().collect() if r[0] is not None}


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A written training frame in the contract of today, whenever its dates were written: columns
    that a date lacks get their defaults, types are cast, columns that the contract doesn't know are
    left out. Null scores stay null. Datasets without impressions come back as they are."""
    df = dated_rows(spark, path)
    if "impression_id" not in df.columns:
        return df
    return training_frame(df).select(*DATASET_COLUMNS)


def load_with_fallback(
    spark: SparkSession, paths: list[str], usable: Callable[[DataFrame], object]
) -> tuple[DataFrame, str, bool, object]:
    """The first dataset that exists and for which ``usable`` returns a true value.

    Returns the frame, its path, whether it was not the first choice, and what ``usable`` said.
    """
    for i, path in enumerate(paths):
        if not path_exists(spark, path):
            continue
        df = read_dataset(spark, path)
        verdict = usable(df)
        if verdict:
            return df, path, i > 0, verdict
    raise RuntimeError(f"no usable dataset among {paths}")

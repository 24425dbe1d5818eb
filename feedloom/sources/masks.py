"""A kept table of label masks: one row per impression, bucketed and sorted by its id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.attribution import merged_masks


def compact_masks(masks: DataFrame, table: str, buckets: int = 256, id_type: str = "bigint") -> None:
    """Merge ``masks`` (impression_id, mask; any number of rows per impression), such as the output of the
    attribution stream, into the catalog's ``table``.

    Only the new rows are shuffled: the table's rows stay in their buckets, as both the join and the
    next table use them. Merging a row again changes nothing, so a job that failed is repeated. The
    next table is written whole and takes the name at the end. ``buckets`` holds for a new table and
    should be at least spark.sql.shuffle.partitions; ``id_type`` is the type of the impressions' ids.
    """
    spark = masks.sparkSession
    new = merged_masks(masks.select(F.col("impression_id").cast(id_type).alias("impression_id"), "mask"))
    following = f"{table}_next"
    spark.sql(f"drop table if exists {following}")
    exists = spark.catalog.tableExists(table)
    if exists:
        buckets = bucket_count(spark, table)
        old = spark.table(table).withColumnRenamed("mask", "old_mask")
        new = old.join(new, "impression_id", "full_outer").selectExpr(
            "impression_id", "coalesce(old_mask, 0) | coalesce(mask, 0) as mask")
    else:
        new = new.repartition(buckets, "impression_id")
    new.where("impression_id is not null").write.format("parquet").bucketBy(buckets, "impression_id").sortBy(
        "impression_id").saveAsTable(following)
    if exists:
        spark.sql(f"drop table {table}")
    spark.sql(f"alter table {following} rename to {table}")


def bucket_count(spark: SparkSession, table: str) -> int:
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended {table}").collect()}
    return int(found["Num Buckets"])


def kept_masks(spark: SparkSession, table: str) -> DataFrame:
    """The kept masks; joined by impression_id they need no exchange."""
    return spark.table(table)

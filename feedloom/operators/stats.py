"""Rebuilding statistics tables from the logs. These definitions are this library's own: the
tables are inputs of the dataset build and may also come from elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.contracts import EVENT_TYPES, ITEM_TYPES


def events(name: str) -> Column:
    return F.count_if(F.col("event_type") == EVENT_TYPES[name])


def with_impressions(shown: DataFrame, acted: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of both logs per key. Both sides are one row per key before they meet."""
    return shown.join(acted, keys, "full").fillna(0)


def scroll_stats(impressions: DataFrame, interactions: DataFrame) -> DataFrame:
    shown = impressions.filter("scroll_id is not null").groupBy("scroll_id").agg(
        F.count("*").alias("impressions"))
    acted = interactions.filter("scroll_id is not null").groupBy("scroll_id").agg(
        events("COMPLETE").alias("completions"),
        events("QUALIFIED_VIEW").alias("qualified_views"),
        events("PURCHASE").alias("purchases"),
    )
    return with_impressions(shown, acted, ["scroll_id"])


def product_stats(impressions: DataFrame, interactions: DataFrame) -> DataFrame:
    """item_global_stats rows of type PRODUCT."""
    shown = impressions.filter("product_id is not null").groupBy(
        F.col("product_id").alias("item_id")).agg(F.count("*").alias("impressions"))
    acted = interactions.filter("product_id is not null").groupBy(
        F.col("product_id").alias("item_id")).agg(
        events("PRODUCT_CLICK").alias("clicks"),
        events("PRODUCT_VIEW").alias("product_views"),
        events("ADD_TO_CART").alias("carts"),
        events("PURCHASE").alias("purchases"),
    )
    both = with_impressions(shown, acted, ["item_id"])
    return both.withColumn("item_type", F.lit(ITEM_TYPES["PRODUCT"]))


def position_baseline(dataset: DataFrame) -> DataFrame:
    """Observed click rate per feed position."""
    return dataset.groupBy("position_index").agg(F.avg("is_click").alias("expected_ctr"))

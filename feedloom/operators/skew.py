"""Left joins that keep an even load when a key, or the missing key, holds a large share of rows."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.columns import any_of

NULL_SALTS = 1024
#: Sketches of so many groups of partitions are merged first.
SKETCH_GROUPS = 64

# Per column, the frequent values and into how many groups each should be split.
Hot = dict[str, dict[object, int]]


def frequent_values(df: DataFrame, columns: list[str], support: float = 0.001) -> Hot:
    """Values that hold at least ``support`` of the rows, per column.

    One scan with a fixed-size sketch per column and no shuffle of rows. Sketches are merged in two
    levels, so no task takes in more than a part of them. At most 1/support values come back per
    column, whatever the table's size. A value gets a power of four as its number of groups, enough
    to bring each group below ``support`` of the rows.
    """
    k = math.ceil(1 / support)
    size = min(10 * k, 1_000_000)
    parts = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))).agg(
        F.count("*").alias("_rows"),
        *[F.expr(f"approx_top_k_accumulate({c}, {size})").alias(c) for c in columns],
        *[F.count(c).alias(f"_known_{c}") for c in columns])
    # Grouped by a constant, as combining fails on partitions without rows otherwise.
    merged = parts.groupBy(F.lit(0).alias("_all")).agg(
        F.sum("_rows").alias("_rows"),
        *[F.expr(f"approx_top_k_combine({c}, {size})").alias(c) for c in columns],
        *[F.sum(f"_known_{c}").alias(f"_known_{c}") for c in columns])
    # A column of nulls has no sketch to read.
    found = merged.selectExpr("_rows", *[
        f"if(_known_{c} > 0, approx_top_k_estimate({c}, {k}), array()) as {c}" for c in columns]).head()
    if found is None:
        return {c: {} for c in columns}
    least = support * found["_rows"]
    return {
        c: {
            top["item"]: 4 ** math.ceil(math.log(2 * top["count"] / least, 4))
            for top in found[c] if top["item"] is not None and top["count"] >= least
        }
        for c in columns
    }


def group_count(on: list[str], hot: Hot) -> Column:
    """Into how many groups the rows of a key are split: 1 unless a key column is hot."""
    out = F.lit(1)
    for key in on:
        values = hot.get(key, {})
        for groups in sorted(set(values.values())):
            members = [value for value, n in values.items() if n == groups]
            out = F.greatest(out, F.when(F.col(key).isin(members), groups).otherwise(1))
    return out


def spread_left_join(
    left: DataFrame, rights: list[DataFrame], on: list[str], row_id: str, hot: Hot | None = None
) -> DataFrame:
    """Left equi-join of ``left`` with one or more tables that are unique on the same keys.

    Rows with a null key match nothing and rows with a hot key match one row, so both get a salt
    from their row id and spread over many groups; of the right side only the rows with a hot key
    are repeated, in proportion to the key's share (4/support copies per unit of share at most, so
    a few thousand rows where the hot column is the whole key). All rights share the salted key,
    so the left side is shuffled once for all of them. Whether a right side is small enough to
    broadcast is left to Spark, which compares the size of its files with
    spark.sql.autoBroadcastJoinThreshold, unless the right bears a hint (``unless_small``).
    """
    groups = group_count(on, hot or {})
    no_key = any_of([F.col(k).isNull() for k in on])
    split = F.when(no_key, NULL_SALTS).otherwise(groups)
    out = left.withColumn("_salt", F.pmod(F.xxhash64(row_id), split).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), groups - 1))
    for right in rights:
        out = out.join(right.withColumn("_salt", copies), [*on, "_salt"], "left")
    return out.drop("_salt")


def slot_width(user: str, hot_users: Iterable | None, wide: int, narrow: int) -> Column:
    """Width of a user's time slots: ``narrow`` for users with a large share of the rows, so that
    their rows make many small groups; ``wide`` for all others, so that few rows sit near an edge
    and have to be copied into the neighbouring slot."""
    if not hot_users:
        return F.lit(wide)
    return F.when(F.col(user).isin(list(hot_users)), narrow).otherwise(wide)


def unless_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """``df`` with a merge join hint if it has more than ``max_rows`` rows, whatever its files' size:
    a million rows of few values take a few megabytes of Parquet, but hundreds in the driver that
    would broadcast them. With fewer rows the choice stays Spark's."""
    return df if broadcast_if_small(df, max_rows)[1] else df.hint("merge")


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, and whether it has.

    The check reads no more than ``max_rows`` + 1 rows of the first column to the driver.
    """
    small = len(df.select(df.columns[0]).take(max_rows + 1)) <= max_rows
    return (F.broadcast(df) if small else df), small

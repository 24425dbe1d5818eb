"""Reproducible train/test split, stratified by class."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.columns import any_of, hash32
from feedloom.operators.selection import MOST_ROWS, edges, within

#: Bits of the 32-bit hash that are left out in each round of counting.
HASH_SHIFTS = [20, 8, 0]


def split_hash(row_id: str, seed: int = 42) -> Column:
    """A number in [0, 2^32) that depends on the seed and the row's id only."""
    return F.expr(f"cast({hash32(str(seed), row_id)} as bigint)")


def test_cuts(
    df: DataFrame, label: str, row_id: str, fraction: float = 0.2, seed: int = 42, most: int = MOST_ROWS
) -> list[tuple]:
    """(class, hash, id) of the last test row of each class.

    A class's test rows are the exact share with the smallest (hash, id): ``fraction`` of its rows,
    rounded, and at least one of two. Rows are counted by ever more bits of the hash, until the keys
    that hold a class's boundary have at most ``most`` rows, and only these are ordered. One row per
    class comes back. ``df`` is read once for the classes, and once or twice for the boundaries, so
    one that is costly to compute should be stored.
    """
    rows = df.select(F.col(label).alias("grp"), F.col(row_id).alias("id"), split_hash(row_id, seed).alias("key"))
    totals = {r[0]: r[1] for r in rows.groupBy("grp").count().collect()}
    wanted = {g: max(math.floor(n * fraction + 0.5), min(n - 1, 1)) for g, n in totals.items()}
    found = edges(rows, wanted, HASH_SHIFTS, most)
    if not found:
        return []
    place = F.lit(None).cast("bigint")
    for g, edge in found.items():
        place = F.when(F.col("grp").eqNullSafe(F.lit(g)), wanted[g] - edge.before).otherwise(place)
    mine = any_of([F.col("grp").eqNullSafe(F.lit(g)) & within(F.col("key"), e) for g, e in found.items()])
    upto = F.sum("n").over(Window.partitionBy("grp").orderBy("key", "id"))
    last = (
        rows.where(mine).groupBy("grp", "key", "id").agg(F.count("*").alias("n"))
        .withColumns({"upto": upto, "place": place}).where("upto >= place and upto - n < place"))
    return [tuple(r) for r in last.select("grp", "key", "id").collect()]


def is_test(label: str, row_id: str, cuts: list[tuple], seed: int = 42) -> Column:
    """Whether a row lies at or below its class's cut."""
    value = split_hash(row_id, seed)
    out = F.lit(False)
    for name, hash_, id_ in cuts:
        inside = (value < hash_) | ((value == hash_) & (F.col(row_id) <= F.lit(id_)))
        out = F.when(F.col(label).eqNullSafe(F.lit(name)), inside).otherwise(out)
    return out


def train_test_split(
    df: DataFrame, label: str, row_id: str = "impression_id", fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. A re-run or a lost task gives the same rows, and both sides get rows of
    every class that has two."""
    test = is_test(label, row_id, test_cuts(df, label, row_id, fraction, seed), seed)
    return df.filter(~test), df.filter(test)


def split_balance(
    df: DataFrame, label: str, row_id: str = "impression_id", fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Rows, test rows and test share per class."""
    test = is_test(label, row_id, test_cuts(df, label, row_id, fraction, seed), seed)
    return df.groupBy(label).agg(
        F.count("*").alias("rows"),
        F.count_if(test).alias("test_rows"),
        (F.count_if(test) / F.count("*")).alias("test_share"),
    )

"""Selection by recursive counting: where the n-th row in an order lies, without ordering the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.columns import any_of

#: Rows that one task may order at the end.
MOST_ROWS = 100_000


@dataclass(frozen=True)
class Edge:
    """The keys in [low, high) hold the row that was asked for; ``before`` rows come before them, and
    ``rows`` have such a key."""

    low: int
    high: int
    before: int
    rows: int


def edges(
    rows: DataFrame, wanted: dict[object, int], shifts: list[int], most: int = MOST_ROWS, descending: bool = False,
) -> dict[object, Edge]:
    """Per group of ``rows`` (grp, key; key a non-null bigint) the keys that hold its row number
    ``wanted`` (from 1) in the order of the key.

    Rows are counted by the key without its last ``shifts[0]`` bits; of the group of keys that holds the
    row the same is done with fewer bits, until it has at most ``most`` rows or is one key. Each
    round is a small aggregate over narrow rows. Groups with fewer rows than wanted are left out.
    """
    found: dict[object, Edge] = {}
    left = {g: n for g, n in wanted.items() if n > 0}
    for shift in shifts:
        if not left:
            break
        inside, need = [], F.lit(None).cast("bigint")
        for g, n in left.items():
            mine = F.col("grp").eqNullSafe(F.lit(g))
            if g in found:
                mine = mine & (F.col("key") >= found[g].low) & (F.col("key") < found[g].high)
            inside.append(mine)
            need = F.when(F.col("grp").eqNullSafe(F.lit(g)), n - (found[g].before if g in found else 0)).otherwise(need)
        bucket = F.shiftright("key", shift)
        order = Window.partitionBy("grp").orderBy(F.desc("bucket") if descending else F.asc("bucket"))
        holding = (
            rows.where(any_of(inside)).groupBy("grp", bucket.alias("bucket")).agg(F.count("*").alias("n"))
            .withColumns({"upto": F.sum("n").over(order), "need": need})
            .where("upto >= need and upto - n < need").collect())
        reached = {r["grp"]: r for r in holding}
        for g in list(left):
            if g not in reached:
                # Only in the first round: fewer rows than wanted.
                left.pop(g)
                continue
            r = reached[g]
            before = (found[g].before if g in found else 0) + r["upto"] - r["n"]
            found[g] = Edge(r["bucket"] << shift, (r["bucket"] + 1) << shift, before, r["n"])
            if r["n"] <= most:
                left.pop(g)
    return found


def beyond(key: Column, edge: Edge, descending: bool = False) -> Column:
    """Whether a row comes before the keys of ``edge``."""
    return key >= edge.high if descending else key < edge.low


def within(key: Column, edge: Edge) -> Column:
    return (key >= edge.low) & (key < edge.high)

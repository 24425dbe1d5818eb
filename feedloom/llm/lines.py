"""Removal of boilerplate lines by distinct-site spread.

A line is boilerplate if it occurs on at least so many different sites, however often it occurs on
one of them. A HyperLogLog sketch of the sites per line hash is merged by aggregation, so a line on
a hot site or on all sites costs one small sketch per task. Lines whose estimate is near the
threshold get their sites counted exactly before a decision.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import SPACES, hidden, or_empty, pinned, restored, stored, with_row_key
from feedloom.operators.skew import broadcast_if_small

#: Registers of a sketch, as a power of two, and the standard errors that count as near.
REGISTERS, NEAR = 8, 4
BROADCAST_ROWS = 200_000


def line_hash(line: Column) -> Column:
    """128 bits of a line without the white space around it; null for a blank line."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(bare != "", F.struct(
        F.xxhash64(bare).alias("h"), F.xxhash64(F.lit(1), bare).alias("k")))


def site_lines(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the hash (``h``, ``k``) of every distinct line of a text that is not blank. Lines are
    made distinct as strings, which goes by hashing, unlike structures; those that differ in white
    space only may repeat."""
    hashes = F.transform(F.array_distinct(F.split(or_empty(F.col(text)), "\n")), line_hash)
    return docs.select(*keep, F.inline_outer(hashes)).where("h is not null")


def boilerplate(lines: DataFrame, site: str, least_sites: int) -> DataFrame:
    """``h``, ``k`` of the lines that occur on at least ``least_sites`` sites; null is one site."""
    name = F.coalesce(F.col(site).cast("string"), F.lit("\x00"))
    lines = lines.select("h", "k", name.alias("site"))
    error = 1.04 / math.sqrt(1 << REGISTERS)
    band = max(1.0, NEAR * error * least_sites)
    spread = lines.groupBy("h", "k").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", REGISTERS)).alias("sites"))
    wide = stored(spread.where(F.col("sites") >= least_sites - band))
    sure = wide.where(F.col("sites") > least_sites + band).select("h", "k")
    near = wide.where(F.col("sites") <= least_sites + band).select("h", "k")
    near, _ = broadcast_if_small(near, BROADCAST_ROWS)
    exact = (
        lines.join(near, ["h", "k"], "left_semi").groupBy("h", "k")
        .agg(F.countDistinct("site").alias("sites")).where(F.col("sites") >= least_sites))
    return sure.unionByName(exact.select("h", "k"))


def remove_boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", least_sites: int = 10
) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``, with ``n_lines`` and ``n_removed``.

    Lines end at a line feed and are compared without the white space around them; blank lines stay
    and the lines that are left stand as they were, in order. A null text stays null and has no
    lines; an empty one has one blank line. Rows may repeat, columns of the two names are replaced,
    all others are kept. An empty table gives an empty one.
    """
    docs, at, names = hidden(docs, "n_lines", "n_removed")
    text, site = at[text], at[site]
    found = stored(boilerplate(site_lines(docs, text, [site]), site, least_sites))
    found, _ = broadcast_if_small(found, BROADCAST_ROWS)
    keyed = with_row_key(docs, "_row")
    # The places of the lines to take out of each row, as many as it has lines at most; rows equal in
    # all columns share them.
    hashes = F.transform(F.split(or_empty(F.col(text)), "\n"), line_hash)
    placed = keyed.select("_row", F.posexplode(hashes).alias("_place", "_hash")).where(
        "_hash is not null").select("_row", "_place", "_hash.*")
    out = placed.join(found, ["h", "k"], "left_semi").groupBy("_row").agg(
        F.collect_set("_place").alias("_out"))
    rows = pinned(keyed.join(out, "_row", "left"), _lines=F.split(text, "\n"))
    # Set difference of integers, linear in the lines.
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_out")
    kept = F.transform(places, lambda i: F.get("_lines", i))
    rows = pinned(rows, _kept=F.when(F.col("_out").isNull(), F.col("_lines")).otherwise(kept))
    rows = rows.withColumn(text, F.array_join("_kept", "\n"))
    return restored(
        rows, names,
        F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)).cast("bigint").alias("n_removed"))

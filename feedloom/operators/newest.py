"""Time ranges and newest rows of a log, and retention of runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from feedloom.functions.columns import micros
from feedloom.operators.selection import MOST_ROWS, beyond, edges, within

#: Bits of a time in microseconds that are left out in each round of counting: about 18 minutes,
#: a quarter of a second, one microsecond; and those of a whole number.
TIME_SHIFTS, TIE_SHIFTS = [30, 18, 0], [48, 34, 20, 8, 0]


def between(df: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows created in [start, end). The bounds are literals and reach the Parquet scan."""
    if start is not None:
        df = df.filter(F.col("created_at") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("created_at") < F.lit(end))
    return df


def newest(df: DataFrame, n: int, time: str = "created_at", tie: str = "id") -> DataFrame:
    """The rows of ``newest_rows``, newest first."""
    return newest_first(newest_rows(df, n, time, tie), time, tie)


def newest_rows(
    df: DataFrame, n: int, time: str = "created_at", tie: str = "id", most: int = MOST_ROWS
) -> DataFrame:
    """The ``n`` newest rows, in no order; rows without a time count as newest, equal times go by
    descending ``tie``.

    Rows are counted by time, ever finer down to the microsecond, which tells the time that holds the
    last row to keep. Newer rows are kept whole, and only the rows of that time are ordered: at most
    ``most``, unless more have one and the same microsecond. Those are counted by ``tie`` in the same way
    if it is a whole number, otherwise ordered.
    """
    if n <= 0:
        return df.limit(0)
    none, us = F.col(time).isNull(), F.expr(micros(time))
    # Rows without a time, as a group of their own.
    unknown = df.where(none).count()
    if unknown >= n:
        return last_by_tie(df.where(none), n, unknown, tie, most)
    known = df.where(~none)
    edge = edges(
        known.select(F.lit(0).alias("grp"), us.alias("key")), {0: n - unknown}, TIME_SHIFTS, most, descending=True).get(0)
    if edge is None:
        return df
    newer = df.where(none | beyond(us, edge, descending=True))
    last, missing = known.where(within(us, edge)), n - unknown - edge.before
    if edge.rows > most:
        return newer.unionByName(last_by_tie(last, missing, edge.rows, tie, most))
    return newer.unionByName(last.orderBy(F.desc(time), F.desc(tie)).limit(missing))


def last_by_tie(df: DataFrame, n: int, rows: int, tie: str, most: int) -> DataFrame:
    """The ``n`` of ``rows`` rows with the largest ``tie``, nulls last."""
    if rows <= most or not isinstance(df.schema[tie].dataType, IntegralType):
        return df.orderBy(F.desc(tie)).limit(n)
    key = F.coalesce(F.col(tie).cast("bigint"), F.lit(-(1 << 63)))
    edge = edges(df.select(F.lit(0).alias("grp"), key.alias("key")), {0: n}, TIE_SHIFTS, most, descending=True)[0]
    # Rows with the same tie are interchangeable, so any of them do.
    return df.where(beyond(key, edge, descending=True)).unionByName(
        df.where(within(key, edge)).orderBy(F.desc(tie)).limit(n - edge.before))


def newest_first(
    df: DataFrame, time: str = "impressed_at", tie: str = "impression_id"
) -> DataFrame:
    """Whole frame in descending time. A range-partitioned sort; not needed before writing."""
    return df.orderBy(F.col(time).desc_nulls_first(), F.desc(tie))


def expired_runs(runs: DataFrame, keep: int, active: str | None = None) -> DataFrame:
    """Runs older than the ``keep`` newest run ids, but for the ``active`` one, whose models serve;
    none if ``keep`` is not positive. An ordered limit finds the oldest id that stays."""
    if keep <= 0:
        return runs.filter(F.lit(False))
    kept = [r["run_id"] for r in runs.select("run_id").orderBy(F.desc("run_id")).limit(keep).collect()]
    old = runs.filter(F.col("run_id") < F.lit(min(kept, default="")))
    return old.filter(F.col("run_id") != F.lit(active)) if active is not None else old

"""Session context of an impression: recent scroll speed and time since the session began."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.columns import MINUTE, SECOND, floor_to, micros, slots
from feedloom.operators.newest import between
from feedloom.operators.skew import slot_width

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Rows of each slot with what they look back to. Placeholders: rows, firsts, slot, reach, since,
# live, until.
POINTS_SQL = """
select if(slot = {slot} and {since}, impression_id, null) as impression_id, user_id, session_id,
  us, slot, 1 as weight
from (select *, explode({reach}) as slot from {{rows}})
union all
select null, user_id, session_id, us, slot, 0
from (
  select user_id, session_id, slot, width, min(first_us) over (
      partition by user_id, session_id order by slot
      rows between unbounded preceding and {until}) as us
  from (select user_id, session_id, width, {slot} as slot, min(us) as first_us from {{firsts}}
        where session_id is not null group by user_id, session_id, width, {slot}))
where us is not null and {live}
"""

# Peers up to now and, of these, before the last minutes; the time and the earliest peer's.
# Placeholders: points, velocity, idle.
CONTEXT_SQL = """
select impression_id, if(session_id is null, user_recent, session_recent) as now_count, 0L as then_count, us,
  if(session_id is null, user_first, session_first) as first_us
from (
  select impression_id, session_id, us,
    sum(weight) over user_past - coalesce(sum(weight) over user_before, 0) as user_recent,
    coalesce(max(next_us) over user_idle, min(us) over user_past) as user_first,
    sum(weight) over session_past - coalesce(sum(weight) over session_before, 0) as session_recent,
    min(us) over session_past as session_first
  from (
    select *, lead(us) over (partition by user_id, slot order by us) as next_us from {{points}})
  window
    user_past as (partition by user_id, slot order by us
      range between unbounded preceding and current row),
    user_before as (partition by user_id, slot order by us
      range between unbounded preceding and {velocity} preceding),
    user_idle as (partition by user_id, slot order by us
      range between unbounded preceding and {idle} preceding),
    session_past as (partition by user_id, slot, session_id order by us
      range between unbounded preceding and current row),
    session_before as (partition by user_id, slot, session_id order by us
      range between unbounded preceding and {velocity} preceding))
where impression_id is not null
"""


def slot_points(
    impressions: DataFrame,
    velocity_minutes: int = 5,
    idle_minutes: int = 30,
    slot_minutes: int = 240,
    hot_users: Iterable | None = None,
    since: datetime | None = None,
) -> DataFrame:
    """The log cut into time slots per user, see ``session_context``: its rows, copies of those a
    later slot looks back to (without id), and session starts (without id and weight)."""
    wide = slot_minutes * MINUTE
    back = max(velocity_minutes, idle_minutes) * MINUTE
    width = slot_width("user_id", hot_users, wide, min(wide, back))
    known = timed_rows(impressions)
    edge = since and since - timedelta(microseconds=back)
    rows = between(known, edge, None).withColumn("width", width)
    firsts = rows.select("user_id", "session_id", "width", "us")
    if since:
        firsts = firsts.unionByName(session_starts(
            between(known, None, edge), between(known, since, None)).withColumn("width", width))
    start = since and (since.astimezone(timezone.utc) - EPOCH) // timedelta(microseconds=1)
    text = POINTS_SQL.format(
        slot=floor_to("us", "width"), reach=slots("us", f"(us + {back}L)", "width"),
        since=f"us >= {start}L" if since else "true",
        live=f"slot + width > {start - back}L" if since else "true",
        until="current row" if since else "1 preceding",
    )
    return impressions.sparkSession.sql(text, rows=rows.drop("created_at"), firsts=firsts)


def session_starts(history: DataFrame, live: DataFrame) -> DataFrame:
    """The start (``us``) of each session of ``history`` that goes on in ``live``: one row per
    session, merged before the shuffle and not cut into slots."""
    key = ["user_id", "session_id"]
    first = history.where("session_id is not null").groupBy(*key).agg({"us": "min"}).toDF(*key, "us")
    return first.join(live.select(*key).distinct(), key, "left_semi")


def timed_rows(impressions: DataFrame) -> DataFrame:
    return impressions.where("user_id is not null and created_at is not null").selectExpr(
        "id as impression_id", "user_id", "session_id", "created_at", f"{micros('created_at')} as us")


# The streams a row belongs to: its user's and, if it has one, its session's. Each impression asks in
# one of them, in the session's if it can: how many rows there are up to now (1), how many were there
# before the last minutes (2) and, without a session, which row is the first after the idle cut (3).
# Placeholders: rows, firsts, velocity, idle, since, block.
BLOCK_POINTS_SQL = """
select *, us - pmod(us, {block}L) as block from (
  select user_id, stream, impression_id, inline(array(
    named_struct('us', us, 'weight', 1, 'row_us', us, 'question', if(asks, 1, 0)),
    named_struct('us', if(asks, us - {velocity}L, null), 'weight', 0, 'row_us', null, 'question', 2),
    named_struct('us', if(asks and stream is null, us - {idle}L, null), 'weight', 0, 'row_us', null, 'question', 3)))
  from (
    select user_id, us, stream, impression_id,
      stream <=> session_id and {since} as asks
    from (select *, explode(if(session_id is null, array(session_id), array(null, session_id))) as stream from {{rows}}))
  union all
  select user_id, session_id, null, us, 0, us, 0 from {{firsts}} where session_id is not null)
where us is not null
"""

# Running numbers inside blocks. Placeholders: points.
IN_BLOCK_SQL = """
select *, sum(weight) over (partition by user_id, stream, block order by us
    range between unbounded preceding and current row) as counted,
  min(row_us) over (partition by user_id, stream, block order by us desc
    range between unbounded preceding and current row) as following
from {points} where question > 0 or weight > 0
"""

# Totals of blocks and what lies before and after each: a row per block. Placeholders: points.
BLOCKS_SQL = """
select *, (sum(n) over earlier) - n as counted_before, (min(first_us) over earlier) as stream_first,
  min(first_us) over (partition by user_id, stream order by block desc
    rows between unbounded preceding and 1 preceding) as next_first
from (select user_id, stream, block, sum(weight) as n, min(row_us) as first_us
  from {points} group by user_id, stream, block)
window earlier as (partition by user_id, stream order by block rows between unbounded preceding and current row)
"""

# The answer to each question, in the columns of the context. Placeholders: inside, blocks.
ANSWERS_SQL = """
select impression_id, if(question = 1, total, null) as now_count, if(question = 2, total, null) as then_count,
  if(question = 1, us, null) as us,
  case when stream is null and question = 3 then coalesce(following, next_first)
    when stream is not null and question = 1 then stream_first end as first_us
from (
  select i.*, i.counted + b.counted_before as total, b.next_first, b.stream_first
  from {inside} i join {blocks} b
  on i.user_id = b.user_id and i.stream <=> b.stream and i.block = b.block
  where i.question > 0)
"""


def finished(rows: DataFrame, velocity_minutes: int) -> DataFrame:
    return rows.selectExpr(
        "impression_id", f"(now_count - then_count) / {velocity_minutes}D as session_velocity",
        f"(us - first_us) / {SECOND}D as session_dwell_time")


def put_together(answers: DataFrame) -> DataFrame:
    """One row per impression."""
    columns = ["now_count", "then_count", "us", "first_us"]
    return answers.groupBy("impression_id").agg(*[F.max(c).alias(c) for c in columns])


def hot_answers(
    impressions: DataFrame,
    velocity_minutes: int = 5,
    idle_minutes: int = 30,
    since: datetime | None = None,
    block: int = SECOND,
) -> DataFrame:
    """What ``session_context`` needs of users with very many rows at a time, in two levels: up to three
    rows an impression.

    A stream (a user or a session) is cut into blocks of ``block`` microseconds. Counts and next rows
    are running numbers inside a block, put together with the totals of the blocks before and after
    it. What an impression asks about an earlier time is a row of the block of that time. So a group
    holds the rows of one block, and one per block of a stream on the upper level, however many rows a
    user has within a time slot.
    """
    back = max(velocity_minutes, idle_minutes) * MINUTE
    edge = since and since - timedelta(microseconds=back)
    known = timed_rows(impressions)
    rows = between(known, edge, None)
    # Starts of sessions that began out of reach.
    firsts = session_starts(between(known, None, edge), between(known, since, None)) if since else rows.limit(0)
    start = since and (since.astimezone(timezone.utc) - EPOCH) // timedelta(microseconds=1)
    spark = impressions.sparkSession
    points = spark.sql(
        BLOCK_POINTS_SQL.format(
            velocity=velocity_minutes * MINUTE + 1, idle=idle_minutes * MINUTE, block=block,
            since=f"us >= {start}L" if since else "true"),
        rows=rows.drop("created_at"), firsts=firsts.select("user_id", "session_id", "us"))
    inside, blocks = spark.sql(IN_BLOCK_SQL, points=points), spark.sql(BLOCKS_SQL, points=points)
    # Blocks grow with the log and are never broadcast.
    return spark.sql(ANSWERS_SQL, inside=inside, blocks=blocks.hint("merge"))


def session_context(
    impressions: DataFrame,
    velocity_minutes: int = 5,
    idle_minutes: int = 30,
    slot_minutes: int = 240,
    hot_users: Iterable | None = None,
    since: datetime | None = None,
) -> DataFrame:
    """One row per impression with a user and a time: impression_id, session_velocity,
    session_dwell_time. Impressions left out have 0 for both.

    Peers are the user's impressions up to this instant: those of the same session, or, without a
    session, those of any session in the last ``idle_minutes``. Velocity is the number of peers of
    the last ``velocity_minutes`` per minute; dwell is the seconds since the earliest peer.

    The log is cut into time slots, so a user or session of any length spreads over many tasks;
    ``hot_users`` go through ``hot_answers``, whose groups are blocks of a second. A slot also holds
    what its rows look back to: copies of the
    rows just before it, and for each session running into it one weightless row at the session's
    start. Every frame starts at the slot's beginning, so the work per slot is linear in its rows:
    a count over the last minutes is the difference of two growing counts, and the earliest peer
    after an idle cut is what follows the last row before the cut. One shuffle by user and slot
    serves all five frames.

    With ``since`` only impressions from then on are returned. Rows out of their reach merely
    contribute one start per session that goes on, merged before any shuffle; only the rest is cut
    into slots. The first slot may then lack its oldest rows, so a session's start also counts the
    slot it is in.
    """
    hot = F.col("user_id").isin(list(hot_users or []))
    others = impressions.where(~hot) if hot_users else impressions
    points = slot_points(others, velocity_minutes, idle_minutes, slot_minutes, None, since)
    text = CONTEXT_SQL.format(
        velocity=f"{velocity_minutes * MINUTE + 1}L", idle=f"{idle_minutes * MINUTE + 1}L")
    rows = impressions.sparkSession.sql(text, points=points)
    if hot_users:
        # Put together with the others' rows, so that the shuffle by impression serves the next join.
        rows = put_together(rows.unionByName(
            hot_answers(impressions.where(hot), velocity_minutes, idle_minutes, since)))
    return finished(rows, velocity_minutes)


def with_session_context(base: DataFrame, context: DataFrame) -> DataFrame:
    """Attach the context; impressions without user or time get 0 for both. The context has a row
    per impression and is never broadcast."""
    return base.join(context.hint("merge"), "impression_id", "left").selectExpr(
        "* except (session_velocity, session_dwell_time)",
        "coalesce(session_velocity, 0D) as session_velocity",
        "coalesce(session_dwell_time, 0D) as session_dwell_time",
    )

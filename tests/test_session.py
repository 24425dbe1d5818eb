"""Session context against hand-written cases and a brute-force count."""
import random

import pytest
from conftest import at

from feedloom.operators.session import (
    BLOCK_POINTS_SQL,
    finished,
    hot_answers,
    put_together,
    session_context,
    with_session_context,
)


def context(table, rows, **options):
    df = table("scroll_impressions", *rows)
    ids = df.selectExpr("id as impression_id")
    out = with_session_context(ids, session_context(df, **options)).collect()
    return {r.impression_id: (round(r.session_velocity, 6), r.session_dwell_time) for r in out}


def test_no_user_no_time(table):
    got = context(table, [
        {"id": 1, "session_id": "a", "created_at": at()},
        {"id": 2, "user_id": 1, "session_id": "a"},
    ])
    assert got == {1: (0.0, 0.0), 2: (0.0, 0.0)}


def test_first_and_ties(table):
    row = {"user_id": 1, "session_id": "a"}
    got = context(table, [
        {"id": 1, **row, "created_at": at()},
        {"id": 2, "user_id": 2, "session_id": "b", "created_at": at()},
        {"id": 3, "user_id": 2, "session_id": "b", "created_at": at()},
    ])
    assert got == {1: (0.2, 0.0), 2: (0.4, 0.0), 3: (0.4, 0.0)}


def test_velocity_edge(table):
    row = {"session_id": "a"}
    got = context(table, [
        {"id": 1, "user_id": 1, **row, "created_at": at()},
        {"id": 2, "user_id": 1, **row, "created_at": at(300)},
        {"id": 3, "user_id": 2, **row, "created_at": at()},
        {"id": 4, "user_id": 2, **row, "created_at": at(300, microseconds=1)},
    ])
    assert got[2] == (0.4, 300.0)
    assert got[4] == (0.2, 300.000001)


def test_without_session(table):
    got = context(table, [
        {"id": 1, "user_id": 1, "session_id": "x", "created_at": at()},
        {"id": 2, "user_id": 1, "created_at": at(600)},
        {"id": 3, "user_id": 2, "created_at": at()},
        {"id": 4, "user_id": 2, "created_at": at(1800)},
        {"id": 5, "user_id": 3, "created_at": at()},
        {"id": 6, "user_id": 3, "created_at": at(1800, microseconds=1)},
    ])
    assert got[2] == (0.2, 600.0)
    assert got[4] == (0.2, 1800.0)
    assert got[6] == (0.2, 0.0)


def brute_force(rows):
    out = {}
    for b in rows:
        if b.get("user_id") is None:
            out[b["id"]] = (0.0, 0.0)
            continue
        peers = [
            p["created_at"] for p in rows
            if p.get("user_id") == b["user_id"] and p["created_at"] <= b["created_at"]
            and ((b["session_id"] is not None and p["session_id"] == b["session_id"])
                 or (b["session_id"] is None
                     and (b["created_at"] - p["created_at"]).total_seconds() <= 1800))
        ]
        recent = sum((b["created_at"] - t).total_seconds() <= 300 for t in peers)
        dwell = (b["created_at"] - min(peers)).total_seconds()
        out[b["id"]] = (round(recent / 5, 6), dwell)
    return out


@pytest.mark.parametrize("slot_minutes", [7, 45, 240])
def test_sessions_across_slots(table, slot_minutes):
    """One user and one session hold a third of the rows, over many slots."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        rows.append({
            "id": i,
            "user_id": 1 if hot else rng.choice([None, 2, 3, 4]),
            "session_id": "h" if hot else rng.choice([None, "a", "b"]),
            "created_at": at(rng.randrange(0, 6 * 3600, 20)),
        })
    expected = brute_force(rows)
    assert context(table, rows, slot_minutes=slot_minutes) == expected
    assert context(table, rows, slot_minutes=slot_minutes, hot_users=[1, 3]) == expected
    since = at(3 * 3600)
    df = table("scroll_impressions", *rows)
    late = session_context(df, slot_minutes=slot_minutes, since=since).collect()
    got = {r.impression_id: (round(r.session_velocity, 6), r.session_dwell_time) for r in late}
    assert got == {
        r["id"]: expected[r["id"]] for r in rows
        if r["user_id"] is not None and r["created_at"] >= since}
    hot_late = session_context(df, slot_minutes=slot_minutes, since=since, hot_users=[1, 2, 3, 4]).collect()
    assert {r.impression_id: (round(r.session_velocity, 6), r.session_dwell_time) for r in hot_late} == got


@pytest.mark.parametrize("block", [1_000_000, 70_000_000, 10**12])
def test_a_hot_user_in_two_levels(table, block):
    """Rows in bursts of microseconds, at the edges of blocks, of the last minutes and of the idle cut."""
    rng = random.Random(7)
    steps = [0, 1, 2, 299_999_999, 300_000_000, 300_000_001, 999_999, 1_000_000, 1_800_000_000, 1_800_000_001]
    rows = [{"id": i, "user_id": 1 + i % 2, "session_id": rng.choice([None, "a", "b"]),
             "created_at": at(microseconds=sum(rng.sample(steps, 3)))} for i in range(400)]
    df = table("scroll_impressions", *rows)
    found = finished(put_together(hot_answers(df, block=block)), 5)
    out = with_session_context(df.selectExpr("id as impression_id"), found).collect()
    assert {r.impression_id: (round(r.session_velocity, 6), r.session_dwell_time) for r in out} == brute_force(rows)


def test_no_group_holds_a_slot(spark, table):
    """All 40,000 rows of a user within half an hour: groups of a second, whatever the slot holds."""
    n = 40_000
    shown = spark.range(n).selectExpr(
        "id", "1L as user_id", "if(id % 2 = 0, 's', null) as session_id",
        "timestamp_micros(1709294400000000 + id * 45000) as created_at")
    points = spark.sql(BLOCK_POINTS_SQL.format(velocity=300_000_001, idle=1_800_000_000, block=1_000_000, since="true"),
                       rows=shown.selectExpr("id as impression_id", "user_id", "session_id", "unix_micros(created_at) as us"),
                       firsts=shown.selectExpr("user_id", "session_id", "0L as us").limit(0))
    largest = points.groupBy("user_id", "stream", "block").count().agg({"count": "max"}).head()[0]
    assert largest <= 3 * 23
    got = session_context(shown, hot_users=[1])
    plain = session_context(shown)
    assert got.count() == n and got.exceptAll(plain).count() == 0

"""Attribution against hand-written cases and a brute-force match."""
import random
from datetime import timedelta

import pytest
from conftest import at

from feedloom.contracts import EVENT_LABELS, EVENT_TYPES
from feedloom.operators.attribution import label_masks, nearby_masks, with_labels
from feedloom.operators.items import resolve_items

CLICK, BUY, SKIP = (EVENT_TYPES[n] for n in ("PRODUCT_CLICK", "PURCHASE", "SKIP"))


def labels(table, shown, acted, **options):
    base = resolve_items(table("scroll_impressions", *shown))
    masks = label_masks(base, table("scroll_interactions", *acted), **options)
    rows = with_labels(base, masks).collect()
    return {
        r.impression_id: {n for n in [*EVENT_LABELS, "is_click"] if r[n] == 1} for r in rows
    }


def test_direct_has_no_time_bound_and_no_user_check(table):
    got = labels(
        table,
        [{"id": 1, "user_id": 1, "scroll_id": 5, "created_at": at()},
         {"id": 2, "user_id": 1, "item_type": 3, "scroll_id": 5, "created_at": at()}],
        [{"impression_id": 1, "user_id": 9, "event_type": CLICK, "created_at": at(-86400)},
         {"impression_id": 2, "event_type": SKIP}],
    )
    assert got == {1: {"is_product_click", "is_click"}, 2: {"is_skip"}}


def test_fallback_window(table):
    acted = [
        {"user_id": user, "scroll_id": 5, "event_type": BUY, "created_at": at(when)}
        for user, when in ((1, 0), (2, 3600 - 1e-6), (3, 3600), (4, -1e-6))
    ]
    shown = [{"id": u, "user_id": u, "scroll_id": 5, "created_at": at()} for u in (1, 2, 3, 4)]
    got = labels(table, shown, acted)
    bought = {"is_purchase", "is_click"}
    assert got == {1: bought, 2: bought, 3: set(), 4: set()}


def test_one_event_labels_several_impressions(table):
    got = labels(
        table,
        [{"id": i, "user_id": 1, "product_id": 5, "created_at": at(i)} for i in (1, 2)],
        [{"user_id": 1, "product_id": 5, "event_type": CLICK, "created_at": at(60)}],
    )
    assert all("is_product_click" in flags for flags in got.values())


def test_item_type_decides_the_id(table):
    shown = [
        {"id": 1, "user_id": 1, "item_type": 1, "scroll_id": 5, "product_id": 6,
         "created_at": at()},
        {"id": 2, "user_id": 1, "item_type": 3, "scroll_id": 5, "created_at": at()},
        {"id": 3, "user_id": 1, "item_type": 2, "scroll_id": 5, "created_at": at()},
    ]
    acted = [{"user_id": 1, "scroll_id": 5, "product_id": 7, "event_type": CLICK,
              "created_at": at(1)}]
    got = labels(table, shown, acted)
    assert got == {1: {"is_product_click", "is_click"}, 2: set(), 3: set()}


def test_sessions(table):
    shown = [
        {"id": 1, "user_id": 1, "scroll_id": 5, "session_id": "a", "created_at": at()},
        {"id": 2, "user_id": 1, "scroll_id": 5, "created_at": at()},
        {"id": 3, "user_id": 2, "scroll_id": 5, "session_id": "a", "created_at": at()},
    ]
    acted = [
        {"user_id": 1, "scroll_id": 5, "event_type": SKIP, "created_at": at(1)},
        {"user_id": 2, "scroll_id": 5, "session_id": "a", "event_type": SKIP,
         "created_at": at(1)},
    ]
    assert labels(table, shown, acted) == {1: set(), 2: {"is_skip"}, 3: {"is_skip"}}


def test_events_without_label(table):
    got = labels(
        table, [{"id": 1, "user_id": 1, "scroll_id": 5, "created_at": at()}],
        [{"impression_id": 1, "event_type": e} for e in (10, 11, 12)],
    )
    assert got == {1: set()}


def brute_force(shown, acted):
    names = {EVENT_TYPES[e]: label for label, e in EVENT_LABELS.items()}
    out = {}
    for b in shown:
        kind = b["item_type"] or (2 if b["product_id"] is not None else 1)
        hit = set()
        for n in acted:
            if n["impression_id"] is not None:
                match = n["impression_id"] == b["id"]
            else:
                column = {1: "scroll_id", 2: "product_id"}.get(kind)
                match = (
                    column and b["user_id"] is not None and n["user_id"] == b["user_id"]
                    and b[column] is not None and n[column] == b[column]
                    and b["session_id"] in (None, n["session_id"])
                    and b["created_at"] <= n["created_at"] < b["created_at"] + timedelta(hours=1)
                )
            if match and n["event_type"] in names:
                hit.add(names[n["event_type"]])
        if b["scroll_id"] is not None or b["product_id"] is not None:
            out[b["id"]] = hit
    return out


@pytest.mark.parametrize("slot_minutes", [11, 60, 240])
def test_hot_pair_across_slots(table, slot_minutes):
    """A third of both logs is one user on one item."""
    rng = random.Random(3)

    def row(i):
        hot = i % 3 == 0
        return {
            "id": i, "user_id": 1 if hot else rng.choice([None, 2, 3]),
            "scroll_id": 5 if hot else rng.choice([None, 5, 6]),
            "product_id": None if hot else rng.choice([None, 5, 7]),
            "session_id": rng.choice([None, "a", "b"]),
            "created_at": at(rng.randrange(0, 8 * 3600, 30)),
        }

    shown = [row(i) | {"item_type": rng.choice([None, None, 1, 2, 3])} for i in range(300)]
    acted = [
        row(i) | {"event_type": rng.randrange(1, 16),
                  "impression_id": rng.choice([None, None, rng.randrange(400)])}
        for i in range(300)
    ]
    expected = brute_force(shown, acted)
    for hot_users in (None, [1, 2]):
        got = labels(table, shown, acted, slot_minutes=slot_minutes, hot_users=hot_users)
        assert {k: v - {"is_click"} for k, v in got.items()} == expected
    start, end = at(2 * 3600), at(5 * 3600)
    some = [row for row in shown if start <= row["created_at"] < end]
    got = labels(table, some, acted, slot_minutes=slot_minutes, start=start, end=end)
    assert {k: v - {"is_click"} for k, v in got.items()} == brute_force(some, acted)


def test_plan_builds_no_pairs(table):
    base = resolve_items(table("scroll_impressions"))
    plan = nearby_masks(base, table("scroll_interactions"))
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "Join" not in text and "CartesianProduct" not in text
    assert "Window" in text

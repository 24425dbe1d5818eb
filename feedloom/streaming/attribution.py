"""Attribution over two live logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.contracts import ITEM_TYPES
from feedloom.functions.columns import MINUTE, micros
from feedloom.operators.attribution import (
    CODES,
    SETS_LABEL,
    direct_masks,
    merged_masks,
    with_labels,
)
from feedloom.operators.items import resolve_items

KEYS = ["owner", "item_type", "item_id", "salt"]


def direct_stream(interactions: DataFrame) -> DataFrame:
    """impression_id and mask of each event that names its impression, as it arrives. Needs no
    state, so such an event counts however late it is."""
    return direct_masks(interactions).selectExpr(
        "cast(impression_id as string) as impression_id", "mask")


def minutes_of_events(interactions: DataFrame, lateness: str) -> DataFrame:
    """Events that name no impression, one row per user, item, session and minute: the first and the
    last time of each kind (``first``, ``last``, arrays in the order of CODES) and ``acted_at``, the
    minute's end. An event with a session counts twice, in the stream of that session and in the one
    of any session, where ``acted_session`` is null.

    A minute is emitted once the watermark has passed its end, so the state holds the minutes of the
    lateness and a minute with ten thousand events is one row.
    """
    scroll, product = ITEM_TYPES["SCROLL"], ITEM_TYPES["PRODUCT"]
    items = ", ".join(
        f"named_struct('acted_item_type', {kind}, 'acted_item_id', {column})"
        for kind, column in ((scroll, "scroll_id"), (product, "product_id")))
    sessions = "if(session_id is null, array(cast(null as string)), array(null, cast(session_id as string)))"
    events = (
        interactions.withColumnRenamed("created_at", "acted_at").withWatermark("acted_at", lateness)
        .where(f"{SETS_LABEL} and impression_id is null and user_id is not null")
        .selectExpr("acted_at", "user_id as acted_owner", "event_type", f"{micros('acted_at')} as us",
                    f"explode({sessions}) as acted_session", "scroll_id", "product_id")
        .selectExpr("acted_at", "acted_owner", "event_type", "us", "acted_session", f"inline(array({items}))")
        .where("acted_item_id is not null"))
    ends = [F.expr(f"{f}(if(event_type = {c}, us, null))").alias(f"{f}_{c}") for f in ("min", "max") for c in CODES]
    minutes = events.groupBy(
        F.window("acted_at", "1 minute"), "acted_owner", "acted_item_type", "acted_item_id", "acted_session").agg(*ends)
    return minutes.select(
        F.window_time("window").alias("acted_at"), "acted_owner", "acted_item_type", "acted_item_id", "acted_session",
        F.array(*[f"min_{c}" for c in CODES]).alias("first"), F.array(*[f"max_{c}" for c in CODES]).alias("last"))


def nearby_stream(
    impressions: DataFrame,
    interactions: DataFrame,
    horizon_minutes: int = 60,
    lateness: str = "10 minutes",
    salts: int = 1,
) -> DataFrame:
    """impression_id and mask of each impression met by an event of the same user on the same item
    (and session) within the horizon, for events that name no impression.

    Events are merged per minute first and meet the impressions in one inner join, whose state ends
    with the horizon plus the lateness. An impression joins each minute of its horizon once at most,
    so however many events a user and item have, the output is at most ``horizon_minutes`` + 1 rows an
    impression. A minute inside the horizon counts with all its kinds; in the impression's own minute a
    kind counts if its last event is not before the impression, in the horizon's last one if its first
    is before the horizon's end: the same labels as event by event. An event labels once the watermark
    has passed its minute. ``salts`` above 1 spreads the keys of a hot user and item: impressions take
    one salt, minutes are repeated for each.
    """
    scroll, product = ITEM_TYPES["SCROLL"], ITEM_TYPES["PRODUCT"]
    horizon = horizon_minutes * MINUTE
    shown = (
        impressions.withWatermark("created_at", lateness).transform(resolve_items)
        .selectExpr(
            "cast(impression_id as string) as impression_id", "impressed_at", "impressed_us",
            "cast(session_id as string) as shown_session", "user_id as owner", "item_type",
            f"case item_type when {scroll} then scroll_id when {product} then product_id end as item_id",
            f"cast(pmod(xxhash64(impression_id), {salts}) as int) as salt")
        .where("owner is not null and item_id is not null")
    )
    acted = minutes_of_events(interactions, lateness).withColumn(
        "acted_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same_key = " and ".join(f"{k} = acted_{k}" for k in KEYS)
    # A minute ends up to a minute after its events, and with the last microsecond before the next.
    matches = f"""{same_key} and shown_session <=> acted_session
      and acted_at >= impressed_at and acted_at < impressed_at + interval {horizon_minutes + 1} minutes"""
    met = " + ".join(
        f"if((first[{i}] >= impressed_us and first[{i}] < impressed_us + {horizon}L)"
        f" or (last[{i}] >= impressed_us and last[{i}] < impressed_us + {horizon}L), {1 << c}, 0)"
        for i, c in enumerate(CODES))
    return shown.join(acted, F.expr(matches)).selectExpr("impression_id", f"{met} as mask").where("mask <> 0")


def attribute_stream(impressions: DataFrame, interactions: DataFrame, **options) -> DataFrame:
    """The masks of both kinds in append mode: a row per event that names its impression, and one per
    impression and minute with events near it.

    Write them to a table; ``stream_labels`` merges what is there. An impression may get several
    rows, and one that is read twice changes nothing, as bits are merged. ``options`` are those of
    ``nearby_stream``.
    """
    return direct_stream(interactions).unionByName(
        nearby_stream(impressions, interactions, **options))


def stream_labels(impressions: DataFrame, masks: DataFrame) -> DataFrame:
    """The impressions with all labels that ``masks``, the stream's output so far, holds: the same
    as in batch once the horizon has passed. Impressions without a time or an event are there too."""
    base = resolve_items(impressions)
    kind = base.schema["impression_id"].dataType
    merged = merged_masks(masks.withColumn("impression_id", F.col("impression_id").cast(kind)))
    return with_labels(base, merged)

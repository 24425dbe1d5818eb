"""Attribution of interactions to impressions: twelve behaviour flags per impression."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.contracts import CLICK_LABELS, EVENT_LABELS, EVENT_TYPES, ITEM_TYPES
from feedloom.functions.columns import MINUTE, floor_to, micros, slots
from feedloom.operators.newest import between
from feedloom.operators.skew import slot_width

LABEL_CODES = {label: EVENT_TYPES[event] for label, event in EVENT_LABELS.items()}
CODES = sorted(LABEL_CODES.values())
#: Groups of a slot over which a hot user's impressions spread.
HOT_SALTS = 16
CLICK_MASK = sum(1 << LABEL_CODES[label] for label in CLICK_LABELS)
SETS_LABEL = f"event_type in ({', '.join(map(str, CODES))})"

# Placeholders: shown, scroll, product, slot.
TARGETS_SQL = """
select impression_id, user_id, item_type, item_id, any_session, session_id, {slot} as slot, us,
  cast(null as int) as event_type, cast(pmod(xxhash64(impression_id), salts) as int) as salt
from (
  select impression_id, user_id, item_type, session_id is null as any_session, session_id,
    case item_type when {scroll} then scroll_id when {product} then product_id end as item_id,
    impressed_us as us, width, salts
  from {{shown}}
  where user_id is not null and impressed_us is not null and item_type in ({scroll}, {product}))
where item_id is not null
"""

# Placeholders: acted, scroll, product, slots.
SIGNALS_SQL = """
select null as impression_id, user_id, item.item_type, item.item_id, any_session,
  if(any_session, null, session_id) as session_id, explode({slots}) as slot, us, event_type, salt
from (
  select *, explode(if(session_id is null, array(true), array(true, false))) as any_session
  from (
    select *, explode(array(
      struct({scroll} as item_type, scroll_id as item_id),
      struct({product} as item_type, product_id as item_id))) as item
    from {{acted}})
  where item.item_id is not null)
"""

# Placeholders: stream, next_events, mask.
NEARBY_SQL = """
select * from (
  select impression_id, {mask} as mask
  from (
    select impression_id, us, {next_events} from {{stream}}
    window ahead as (
      partition by user_id, item_type, item_id, any_session, session_id, slot, salt order by us desc
      range between unbounded preceding and current row))
  where impression_id is not null)
where mask <> 0
"""


def event_bit(event_type: str) -> str:
    """The mask with the bit of an event code set."""
    return f"shiftleft(1, cast({event_type} as int))"


def direct_masks(interactions: DataFrame) -> DataFrame:
    """impression_id and event bit of interactions that name their impression, at any time."""
    return interactions.where(f"{SETS_LABEL} and impression_id is not null").selectExpr(
        "impression_id", f"{event_bit('event_type')} as mask"
    )


def nearby_masks(
    base: DataFrame,
    interactions: DataFrame,
    horizon_minutes: int = 60,
    slot_minutes: int = 240,
    hot_users: Iterable | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """impression_id and mask of events by the same user on the same item within the horizon.

    Applies to interactions that name no impression. ``base`` is the output of ``resolve_items``.
    Scrolls match on scroll_id, products on product_id, other item types never. An impression with
    a session accepts only events of that session, one without accepts all.

    No pair of impression and event is ever built. Both go into one stream per (user, item,
    session), ordered by time, in which each impression asks for the next event of each kind: a
    running minimum over descending time, linear in the stream's length. Events are repeated for
    the "any session" stream. Streams are cut into time slots, so a hot (user, item) spreads over
    many tasks. Events also go to the earlier slot whose impressions may still reach them.
    ``hot_users`` get shorter slots; of their events only the first and the last of each kind and
    minute are kept, which tell the same for a horizon of whole minutes, so their impressions can be
    spread over HOT_SALTS groups of a slot with these few events repeated in each. If the impressions
    lie in [start, end), events out of their reach are not read.
    """
    wide, horizon = slot_minutes * MINUTE, horizon_minutes * MINUTE
    hot_users = list(hot_users or [])
    salts = F.when(F.col("user_id").isin(hot_users), HOT_SALTS).otherwise(1) if hot_users else F.lit(1)
    width = slot_width("user_id", hot_users, wide, min(wide, horizon))
    reach = between(interactions, start, end and end + timedelta(minutes=horizon_minutes))
    acted = reach.where(
        f"{SETS_LABEL} and impression_id is null and user_id is not null and created_at is not null"
    ).selectExpr(
        "user_id", "session_id", "scroll_id", "product_id", "cast(event_type as int) as event_type",
        f"{micros('created_at')} as us",
    )
    if hot_users:
        acted = thinned(acted, hot_users)
    acted = acted.withColumn("width", width).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    kinds = {"scroll": ITEM_TYPES["SCROLL"], "product": ITEM_TYPES["PRODUCT"]}
    targets = TARGETS_SQL.format(**kinds, slot=floor_to("us", "width"))
    signals = SIGNALS_SQL.format(**kinds, slots=slots(f"(us - {horizon - 1}L)", "us", "width"))
    nearby = NEARBY_SQL.format(
        next_events=", ".join(
            f"min(if(event_type = {c}, us, null)) over ahead as next_{c}" for c in CODES),
        mask=" + ".join(f"if(next_{c} < us + {horizon}L, {1 << c}, 0)" for c in CODES),
    )
    spark = base.sparkSession
    asking = spark.sql(targets, shown=base.withColumns({"width": width, "salts": salts}))
    stream = asking.unionByName(spark.sql(signals, acted=acted))
    return spark.sql(nearby, stream=stream)


def thinned(acted: DataFrame, hot_users: list) -> DataFrame:
    """The events with only the first and last per key, kind and minute of the hot users."""
    hot = F.col("user_id").isin(hot_users)
    key = ["user_id", "session_id", "scroll_id", "product_id", "event_type"]
    ends = acted.where(hot).groupBy(*key, F.floor(F.col("us") / MINUTE).alias("minute")).agg(
        F.min("us").alias("first"), F.max("us").alias("last"))
    few = ends.select(*key, F.explode(F.array_distinct(F.array("first", "last"))).alias("us"))
    return acted.where(~hot).unionByName(few)


def label_masks(
    base: DataFrame, interactions: DataFrame, direct: DataFrame | None = None, **options
) -> DataFrame:
    """Direct and nearby masks merged (``options`` are those of ``nearby_masks``): one row per
    labelled impression_id. Bits are merged before the shuffle, so an impression with a very large
    number of interactions costs one row per map task. ``direct`` is a kept table of direct masks,
    such as the output of the attribution stream; without it all interactions are read for them."""
    return merged_masks(
        (direct_masks(interactions) if direct is None else direct.select("impression_id", "mask"))
        .unionByName(nearby_masks(base, interactions, **options)))


def with_kept_labels(base: DataFrame, nearby: DataFrame, kept: DataFrame) -> DataFrame:
    """Attach the thirteen labels by two sets of masks: those of events near the impressions and a
    ``kept`` table with one row per impression. The table is joined as it lies, so that a table bucketed
    by impression_id is not shuffled."""
    joined = base.join(merged_masks(nearby), "impression_id", "left").join(
        kept.select("impression_id", F.col("mask").alias("kept_mask")), "impression_id", "left")
    return joined.selectExpr(
        "* except (mask, kept_mask)", *label_columns("(coalesce(mask, 0) | coalesce(kept_mask, 0))"))


def merged_masks(masks: DataFrame) -> DataFrame:
    """One mask per impression_id."""
    return masks.groupBy("impression_id").agg({"mask": "bit_or"}).toDF("impression_id", "mask")


def label_columns(mask: str) -> list[str]:
    """The twelve 0/1 labels held by a mask, and the click label: any engaged behaviour. Skip,
    rewatch, share and pause make no click."""
    labels = [f"cast(getbit({mask}, {c}) as int) as {label}" for label, c in LABEL_CODES.items()]
    return [*labels, f"if({mask} & {CLICK_MASK} <> 0, 1, 0) as is_click"]


def with_labels(base: DataFrame, masks: DataFrame) -> DataFrame:
    """Attach the thirteen labels; impressions without a mask get zeros. Masks grow with the log and
    are never broadcast."""
    joined = base.join(masks.hint("merge"), "impression_id", "left")
    return joined.selectExpr("* except (mask)", *label_columns("coalesce(mask, 0)"))

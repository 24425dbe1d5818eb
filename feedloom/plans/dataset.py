"""The training dataset: one row per impression, 53 columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from feedloom.operators.affinity import (
    join_category_affinity,
    join_creator_affinity,
    join_position_bias,
)
from feedloom.operators.attribution import label_masks, nearby_masks, with_kept_labels, with_labels
from feedloom.operators.frames import training_frame
from feedloom.operators.items import PRODUCT_KEY, item_features, join_items, resolve_items
from feedloom.operators.newest import between, newest_rows
from feedloom.operators.session import session_context, with_session_context
from feedloom.operators.skew import Hot, frequent_values
from feedloom.sources.files import set_checkpoint_dir

Tables = dict[str, DataFrame]


def hot_keys(base: DataFrame, support: float | None) -> Hot:
    """Frequent join keys of the log, found in one scan of the key columns; none if switched off."""
    if support is None:
        return {}
    keys = base.selectExpr("scroll_id", f"{PRODUCT_KEY} as product_key", "user_id")
    return frequent_values(keys, keys.columns, support)


def labelled_impressions(tables: Tables, hot_support: float | None = 0.001) -> DataFrame:
    """Impressions that name an item, with all behaviour labels."""
    base = resolve_items(tables["scroll_impressions"])
    hot = frequent_values(base, ["user_id"], hot_support) if hot_support else {}
    masks = label_masks(base, tables["scroll_interactions"], hot_users=hot.get("user_id"))
    return with_labels(base, masks)


def build_dataset(
    tables: Tables,
    start: datetime | None = None,
    end: datetime | None = None,
    limit: int | None = None,
    fill_scores: bool = False,
    hot_support: float | None = 0.001,
    direct: DataFrame | None = None,
    kept: DataFrame | None = None,
) -> DataFrame:
    """The training frame of the impressions created in [start, end), or of the ``limit`` newest.

    Of impressions before the range, session context reads one start per session that goes on. The
    newest rows are chosen once and stored, and their oldest time bounds what else is read.
    ``direct`` is a kept table of the masks of events that name their impression. ``kept`` is one with a row
    per impression, bucketed by its id (``sources.masks``): then the log is only read around the range
    and the history of masks is joined without an exchange. Labels and context are
    computed on the few columns they need and meet the wide rows in one shuffle by impression id;
    the remaining joins bring in the item, affinity and position tables.
    """
    impressions = tables["scroll_impressions"]
    chosen = between(impressions, start, end).where(
        "scroll_id is not null or product_id is not null")
    if limit is not None:
        set_checkpoint_dir(chosen.sparkSession)
        chosen = newest_rows(chosen, limit).checkpoint()
        oldest = chosen.agg({"created_at": "min"}).head()[0]
        start = oldest and oldest.astimezone(timezone.utc)
    base = resolve_items(chosen)
    hot = hot_keys(base, hot_support)

    users = hot.get("user_id")
    reach = {"hot_users": users, "start": start, "end": end}
    if kept is None:
        labelled = with_labels(base, label_masks(base, tables["scroll_interactions"], direct, **reach))
    else:
        labelled = with_kept_labels(base, nearby_masks(base, tables["scroll_interactions"], **reach), kept)
    context = session_context(between(impressions, None, end), hot_users=users, since=start)
    rows = with_session_context(labelled, context)
    rows = join_items(
        rows, tables["scrolls"], tables["products"], tables["scroll_stats"],
        tables["item_global_stats"], hot,
    )
    rows = item_features(rows)
    rows = join_category_affinity(rows, tables["user_category_affinity"], hot)
    rows = join_creator_affinity(rows, tables["user_creator_affinity"], hot)
    rows = join_position_bias(rows, tables["position_bias_baseline"])
    return training_frame(rows, fill_scores=fill_scores)

"""User affinities and position bias of an impression."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.operators.skew import Hot, broadcast_if_small, frequent_values, spread_left_join


def join_category_affinity(
    base: DataFrame, affinity: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """user_category_score by (user_id, content_category); null where there is none. Affinities
    grow with the users and are never broadcast."""
    scores = affinity.selectExpr(
        "user_id", "category_id as content_category", "cast(score as double) as user_category_score"
    )
    return spread_left_join(
        base, [scores.hint("merge")], ["user_id", "content_category"], "impression_id", hot)


def join_creator_affinity(
    base: DataFrame, affinity: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """creator_affinity_score by (user_id, creator_id); null where there is none."""
    scores = affinity.selectExpr(
        "user_id", "creator_id", "cast(score as double) as creator_affinity_score"
    )
    return spread_left_join(
        base, [scores.hint("merge")], ["user_id", "creator_id"], "impression_id", hot)


def join_position_bias(
    base: DataFrame, baseline: DataFrame, max_rows: int = 10_000
) -> DataFrame:
    """expected_ctr_at_position by position_index; null where there is none.

    A feed has few positions and each holds a large share of the log, so the baseline is broadcast
    after a check of its row count; beyond that every frequent position is salted.
    """
    expected, small = broadcast_if_small(
        baseline.selectExpr(
            "position_index", "cast(expected_ctr as double) as expected_ctr_at_position"),
        max_rows,
    )
    if small:
        return base.join(expected, "position_index", "left")
    hot = frequent_values(base, ["position_index"])
    return spread_left_join(base, [expected], ["position_index"], "impression_id", hot)

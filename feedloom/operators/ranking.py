"""From two model probabilities to a final rank score."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.functions.columns import clamp01

# Version text and weights of the blends.
RANKER_VERSION = "phase7-auto-train-hybrid-v1"
MISSING_MODEL_SCORE = 0.5
COMPLETION = {"engagement_score": 0.65, "completion_rate": 0.35}
SAVE = {"engagement_score": 0.55, "commerce_score": 0.45}
KEPT_WATCHING = {"engagement_score": 0.7, "completion_rate": 0.3}
FINAL = {
    "_view": 0.35,
    "completion_score": 0.20,
    "save_score": 0.15,
    "product_click_score": 0.15,
    "_hint": 0.10,
    "fast_skip_score": -0.20,
}


def blend(weights: dict[str, float]) -> str:
    return " + ".join(f"{weight}D * {name}" for name, weight in weights.items())


def with_missing_scores(df: DataFrame, columns=("engagement_score", "commerce_score")) -> DataFrame:
    """Add each score column that no model produced with the neutral value."""
    missing = [f"{MISSING_MODEL_SCORE}D as {c}" for c in columns if c not in df.columns]
    return df.selectExpr("*", *missing)


def rank_scores(df: DataFrame, version: str = RANKER_VERSION) -> DataFrame:
    """Add the derived scores and final_rank_score, row by row and without a shuffle.

    Needs completion_rate and expected_ctr_at_position; engagement_score and commerce_score count
    as 0.5 where no model gave them.
    """
    scored = with_missing_scores(df).selectExpr(
        "*",
        "cast(engagement_score as double) as qualified_view_score",
        f"{clamp01(blend(COMPLETION))} as completion_score",
        f"{clamp01(blend(SAVE))} as save_score",
        f"{clamp01('commerce_score')} as product_click_score",
        f"{clamp01(f'1D - ({blend(KEPT_WATCHING)})')} as fast_skip_score",
        f"{clamp01('engagement_score')} as _view",
        f"{clamp01('expected_ctr_at_position')} as _hint",
    )
    return scored.selectExpr(
        "* except (_view, _hint)",
        f"{clamp01(blend(FINAL))} as final_rank_score",
        f"'{version}' as ranker_version",
    )

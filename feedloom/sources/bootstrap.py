"""Synthetic training rows with a known click rule, for starting without real data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.functions.columns import uniform

# Ranges of the features and weights of the hidden click rule.
POSITIONS, HOURS, WITH_PRODUCTS = 15, 24, 0.7
RANGES = {
    "user_category_score": (0.0, 5.0),
    "video_quality": (0.0, 1.0),
    "completion_rate": (0.0, 1.0),
    "expected_ctr_at_position": (0.01, 0.15),
    "session_velocity": (0.5, 3.0),
    "session_dwell_time": (0.0, 600.0),
}
WEIGHTS = {
    "user_category_score": 0.4,
    "video_quality": 0.3,
    "has_products": 0.2,
    "position_index": -0.05,
    "expected_ctr_at_position": 2.0,
    "session_velocity": -0.1,
}
NOISE, CLICK_ABOVE, BUY_ABOVE = 0.1, 1.5, 0.7


def bootstrap_rows(ids: DataFrame, seed: int = 42) -> DataFrame:
    """One synthetic row per sample_id in ``ids``: nine core features and two labels.

    Every number is a hash of seed, id and column name, so a row is the same however the ids are
    partitioned and whichever task computes it.
    """
    def u(name: str) -> str:
        return uniform(str(seed), "sample_id", f"'{name}'")

    features = [
        f"cast(floor({u('position_index')} * {POSITIONS}) as int) as position_index",
        f"cast(floor({u('hour_of_day')} * {HOURS}) as int) as hour_of_day",
        f"if({u('has_products')} < {WITH_PRODUCTS}D, 1, 0) as has_products",
    ] + [
        f"{low}D + {u(name)} * {high - low}D as {name}" for name, (low, high) in RANGES.items()
    ]
    normal = f"sqrt(-2D * ln({u('radius')})) * cos(2D * pi() * {u('angle')})"
    latent = " + ".join(f"{weight}D * {name}" for name, weight in WEIGHTS.items())
    clicked = f"({latent} + {NOISE}D * {normal} > {CLICK_ABOVE}D)"
    return ids.selectExpr("sample_id", *features).selectExpr(
        "sample_id", "position_index", "user_category_score", "video_quality", "has_products",
        "hour_of_day", "completion_rate", "expected_ctr_at_position", "session_velocity",
        "session_dwell_time",
        f"if({clicked}, 1, 0) as is_click",
        f"if({clicked} and {u('purchase')} > {BUY_ABOVE}D, 1, 0) as is_purchase",
    )


def bootstrap(spark: SparkSession, n: int = 10_000, seed: int = 42) -> DataFrame:
    return bootstrap_rows(spark.range(n).withColumnRenamed("id", "sample_id"), seed)

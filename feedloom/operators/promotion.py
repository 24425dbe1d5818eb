"""Rules that decide whether freshly trained models become the active ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shortfall(text: str, count: str, unit: str, minimum: int) -> Column:
    found = F.format_string(f"{text} (%d{unit} < {minimum})", F.col(count).cast("bigint"))
    return F.when(F.col(count) < minimum, found)


def promotion_gate(
    runs: DataFrame,
    min_rows: int = 250,
    min_click_positives: int = 12,
    min_commerce_positives: int = 12,
    allow_fallback: bool = False,
    force: bool = False,
) -> DataFrame:
    """Add promotion_reasons (what speaks against a run) and promotion_allowed.

    ``runs`` has the summary's rows, click_positives and commerce_positives, and the booleans
    active_models_exist, engagement_used_fallback and commerce_used_fallback. Without active models
    any run is promoted, reasons or not; so is a forced one.
    """
    guarded = F.col("active_models_exist") & F.lit(not force and not allow_fallback)
    # The texts of the reasons.
    reasons = F.array_compact(F.array(
        shortfall("dataset too small", "rows", " rows", min_rows),
        shortfall("not enough real click positives", "click_positives", "", min_click_positives),
        shortfall(
            "not enough real commerce positives", "commerce_positives", "", min_commerce_positives),
        F.when(guarded & F.col("engagement_used_fallback"),
               "engagement training used synthetic fallback"),
        F.when(guarded & F.col("commerce_used_fallback"),
               "commerce training used synthetic fallback"),
    ))
    allowed = ~F.col("active_models_exist") | F.lit(force) | (F.size("promotion_reasons") == 0)
    return runs.withColumn("promotion_reasons", reasons).withColumn("promotion_allowed", allowed)

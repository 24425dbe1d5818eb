"""Model reports over a dataset with scores and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.operators import evaluation
from feedloom.operators.frames import available_scores
from feedloom.operators.summary import scored

REQUIRED = ["ml_shadow_score", "heuristic_score"]


def shadow_report(df: DataFrame, label: str = "is_click") -> tuple[DataFrame, DataFrame]:
    """AUC per available score and the lift of the model over the heuristic, over the rows that
    carry both scores (neither null nor NaN). All are null unless both classes are among them."""
    scores = available_scores(df)
    missing = [c for c in REQUIRED if c not in scores]
    if missing:
        raise ValueError(f"score columns missing: {missing}")
    aucs = evaluation.auc(scored(df, REQUIRED), label, scores)
    return aucs, evaluation.lift(aucs)


def calibration_report(
    df: DataFrame, label: str = "is_click", score: str = "ml_shadow_score"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Brier score, calibration curve and calibration error of the scored rows; ``usable`` tells
    whether both classes are among them, else the metrics are null."""
    curve = evaluation.calibration_curve(df, label, score)
    return evaluation.brier(df, label, score), curve, evaluation.calibration_error(curve)

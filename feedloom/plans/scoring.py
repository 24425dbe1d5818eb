"""Batch scoring: contract, model probabilities, rank scores."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession

from feedloom.contracts import SCORING_DEFAULTS, SCORING_REQUIRED
from feedloom.operators.frames import feature_frame
from feedloom.operators.ranking import rank_scores
from feedloom.plans.training import probability
from feedloom.sources import ledger

Models = tuple[PipelineModel | None, PipelineModel | None]


def load_models(entry: Row | None) -> Models:
    """Engagement and commerce model of a ledger entry, None each without one."""
    if entry is None:
        return None, None
    return (
        PipelineModel.load(entry["engagement"]["model_path"]),
        PipelineModel.load(entry["commerce"]["model_path"]),
    )


def active_models(spark: SparkSession, ledger_path: str) -> Models:
    """The models of the active run, None each if nothing was promoted."""
    return load_models(ledger.active(spark, ledger_path))


def score(
    items: DataFrame,
    models: Models = (None, None),
    keep: list[str] | None = None,
    defaults: dict[str, float] | None = None,
) -> DataFrame:
    """One scored row per row of ``items``; ``keep`` names the id columns. Without a model its
    probability is 0.5. Works on batch and streaming frames.

    The six required columns have to be there; other absent columns, and nulls in any, get the
    defaults of a scoring request, which ``defaults`` overrides.
    """
    missing = [c for c in SCORING_REQUIRED if c not in items.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    rows = feature_frame(items, keep, {**SCORING_DEFAULTS, **(defaults or {})})
    for model, column in zip(models, ("engagement_score", "commerce_score")):
        if model is not None:
            rows = probability(model, rows, column)
    return rank_scores(rows)

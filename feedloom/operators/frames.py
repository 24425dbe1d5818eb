"""Bringing any frame into the column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.contracts import (
    DATASET_COLUMNS,
    FEATURE_COLUMNS,
    FEATURES,
    LABEL_COLUMNS,
    LABELS,
    METADATA,
    SCORE_COLUMNS,
    SCORES,
)

NUMERIC = {**FEATURES, **SCORES, **LABELS}


def conform(
    df: DataFrame,
    columns: list[str],
    fill_scores: bool = True,
    defaults: dict[str, float] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Exactly ``columns`` in order: types cast, nulls and missing columns set to the default.

    Metadata has no default. With ``fill_scores=False`` the three scores keep their nulls, so that
    unscored rows stay apart from rows scored 0. ``defaults`` overrides single defaults, ``keep``
    names columns to carry along in front (such as a request id).
    """
    present = set(df.columns)
    out = list(keep or [])
    for name in columns:
        kind, default = (METADATA[name], None) if name in METADATA else NUMERIC[name]
        default = (defaults or {}).get(name, default)
        value = f"cast({name if name in present else 'null'} as {kind})"
        if default is not None and (fill_scores or name not in SCORES):
            value = f"coalesce({value}, cast({default} as {kind}))"
        out.append(f"{value} as {name}")
    return df.selectExpr(*out)


def training_frame(df: DataFrame, fill_scores: bool = False) -> DataFrame:
    """The 53 dataset columns. Ids become strings; a missing id stays null."""
    return conform(df, DATASET_COLUMNS, fill_scores=fill_scores)


def feature_frame(
    df: DataFrame, keep: list[str] | None = None, defaults: dict[str, float] | None = None
) -> DataFrame:
    """The 24 features, with ``keep`` in front."""
    return conform(df, FEATURE_COLUMNS, defaults=defaults, keep=keep)


def available_scores(df: DataFrame) -> list[str]:
    return [c for c in SCORE_COLUMNS if c in df.columns]


def available_labels(df: DataFrame) -> list[str]:
    return [c for c in LABEL_COLUMNS if c in df.columns]


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if two rows share a key. The dataset joins take one row per key for granted."""
    repeated = df.groupBy(*keys).count().where("count > 1").take(1)
    if repeated:
        raise ValueError(f"more than one row for {repeated[0].asDict()} in keys {keys}")

"""Counts and rates of a dataset, target candidates and the choice of a commerce target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.contracts import COMMERCE_LABELS

MIN_EXAMPLES = 12

# Targets in order of preference.
COMMERCE_TARGETS = [
    "is_purchase",
    "commerce_intent",
    "is_checkout_start",
    "is_add_to_cart",
    "is_product_click",
    "is_product_view",
]


def binary(df: DataFrame, column: str) -> Column:
    """A label as int with nulls as 0; a missing column is 0 everywhere."""
    if column not in df.columns:
        return F.lit(0)
    return F.coalesce(F.col(column).cast("int"), F.lit(0))


def commerce_intent(df: DataFrame) -> Column:
    """1 if any commerce label is 1."""
    return F.greatest(*[(binary(df, c) == 1).cast("int") for c in COMMERCE_LABELS])


def target(df: DataFrame, name: str) -> Column:
    return commerce_intent(df) if name == "commerce_intent" else binary(df, name)


def positives(value: Column) -> Column:
    return F.count_if(value == 1)


def dataset_rates(df: DataFrame) -> DataFrame:
    """One row: row count, whether it is empty, and three mean label rates (null if empty)."""
    return df.agg(
        F.count("*").alias("rows"),
        (F.count("*") == 0).alias("is_empty"),
        F.avg("is_click").alias("click_rate"),
        F.avg("is_purchase").alias("purchase_rate"),
        F.avg("is_qualified_view").alias("qualified_view_rate"),
    )


def dataset_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, positives per label and two rates (0 if empty), over all or per group."""
    intent, click = commerce_intent(df), binary(df, "is_click")
    # The names of the record's fields.
    counts = {
        "rows": F.count("*"),
        "click_positives": positives(click),
        "purchase_positives": positives(binary(df, "is_purchase")),
        "checkout_start_positives": positives(binary(df, "is_checkout_start")),
        "add_to_cart_positives": positives(binary(df, "is_add_to_cart")),
        "product_click_positives": positives(binary(df, "is_product_click")),
        "product_view_positives": positives(binary(df, "is_product_view")),
        "commerce_positives": positives(intent),
        "click_rate": F.coalesce(F.avg(click), F.lit(0.0)),
        "commerce_rate": F.coalesce(F.avg(intent), F.lit(0.0)),
    }
    columns = [value.alias(name) for name, value in counts.items()]
    return df.groupBy(*(by or [])).agg(*columns)


def target_candidates(df: DataFrame, names: list[str] = COMMERCE_TARGETS) -> DataFrame:
    """One row per target: name, priority, rows, positives, negatives, positive_rate. One pass.

    Positives are values 1 and negatives values 0; any other value counts as neither.
    """
    counts = [F.count("*").alias("rows")]
    for i, name in enumerate(names):
        value = target(df, name)
        counts += [F.count_if(value == 1).alias(f"p{i}"), F.count_if(value == 0).alias(f"n{i}")]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("target"), F.lit(i).alias("priority"), F.col("rows").alias("rows"),
            F.col(f"p{i}").alias("positives"), F.col(f"n{i}").alias("negatives"),
            (F.col(f"p{i}") / F.greatest("rows", F.lit(1))).alias("positive_rate"),
        )
        for i, name in enumerate(names)
    ])
    return df.agg(*counts).select(F.inline(rows))


def choose_target(candidates: DataFrame, min_examples: int = MIN_EXAMPLES) -> DataFrame:
    """One row: the first usable target with its counts (null if none is), and how many are."""
    usable = (F.col("positives") >= min_examples) & (F.col("negatives") >= min_examples)
    first = F.min_by(
        F.struct("target", "rows", "positives", "negatives"), F.when(usable, F.col("priority")))
    return candidates.agg(first.alias("first"), F.count_if(usable).alias("usable_targets")).select(
        "first.*", "usable_targets")


def scored(df: DataFrame, scores: list[str]) -> DataFrame:
    """Rows with all the given scores."""
    return df.dropna(how="any", subset=scores)


def label_distribution(df: DataFrame, label: str = "is_click") -> DataFrame:
    """Rows per label value."""
    return df.groupBy(label).agg(F.count("*").alias("rows"))


def has_both_classes(df: DataFrame, label: str = "is_click") -> DataFrame:
    """One row: number of distinct label values and whether metrics can be computed."""
    distinct = F.count_distinct(label)
    return df.agg(distinct.alias("classes"), (distinct >= 2).alias("usable"))

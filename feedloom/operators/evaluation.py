"""Model quality: AUC, lift, Brier score and calibration."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.contracts import SCORE_COLUMNS
from feedloom.operators.summary import scored

#: Distinct scores that one window group of ``auc`` should hold about, and sketches merged at first.
ROWS_PER_RANGE, SKETCH_GROUPS = 1_000_000, 64
MIN_RANGES, MAX_RANGES = 16, 8192
#: Items of a quantile sketch: a range is off by less than a thousandth of the rows.
SKETCH_SIZE = 8192


def score_edges(df: DataFrame, scores: list[str]) -> dict[str, list[float]]:
    """Per score the values that cut its rows into ranges of about equal size; the number of ranges
    follows the number of rows.

    They only balance the work of ``auc``; its result is the same for any edges. One scan in one job,
    no shuffle of rows: rows are counted beside quantile sketches, which are merged in two levels, so
    no task takes in more than a part of them. The driver gets one sketch of fixed size and then at
    most MAX_RANGES numbers per score.
    """
    wide = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in scores])
    names = [f"s{i}" for i in range(len(scores))]
    parts = wide.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))).agg(F.count("*").alias("rows"), *[
        f(c).alias(prefix + n) for c, n in zip(scores, names) for prefix, f in (
            ("known_", F.count), ("sketch_", lambda c: F.expr(f"kll_sketch_agg_double(`{c}`, {SKETCH_SIZE})")))])
    found = parts.agg(F.sum("rows").alias("rows"), *[F.sum(f"known_{n}").alias(f"known_{n}") for n in names], *[
        F.expr(f"kll_merge_agg_double(sketch_{n})").alias(f"sketch_{n}") for n in names]).head()
    filled = [n for n in names if found[f"known_{n}"]]
    if not filled:
        return {c: [] for c in scores}
    ranges = min(MAX_RANGES, max(MIN_RANGES, -(-found["rows"] // ROWS_PER_RANGE)))
    ranks = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    sketches = df.sparkSession.createDataFrame(
        [tuple(found[f"sketch_{n}"] for n in filled)], ", ".join(f"{n} binary" for n in filled))
    cuts = sketches.selectExpr(*[
        f"kll_sketch_get_quantile_double({n}, array({ranks})) as {n}" for n in filled]).head()
    return {c: sorted(set(cuts[n])) if n in filled else [] for c, n in zip(scores, names)}


def auc(
    df: DataFrame,
    label: str = "is_click",
    scores: list[str] = SCORE_COLUMNS,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Exact area under the ROC curve with ties counted half: one row per score.

    Null if a class is missing. Rows are first merged per distinct score, then cut at the score's
    ``edges`` into ranges. Pairs inside a range are counted by a window in that range, pairs across
    ranges from the ranges' totals, so no task sees the whole order. Rows without the score (null
    or NaN) are skipped.
    """
    edges = score_edges(df, scores) if edges is None else edges
    wide = df.select(F.col(label).alias("_label"), *[
        F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"_s{i}") for i, c in enumerate(scores)])
    cut = Bucketizer(
        splitsArray=[[float("-inf"), *(edges.get(c) or [0.0]), float("inf")] for c in scores],
        inputCols=[f"_s{i}" for i in range(len(scores))],
        outputCols=[f"_r{i}" for i in range(len(scores))], handleInvalid="keep").transform(wide)
    pairs = ", ".join(f"'{c}', _s{i}, _r{i}" for i, c in enumerate(scores))
    cut = (
        cut.selectExpr("_label", f"stack({len(scores)}, {pairs}) as (score_name, score, range)")
        .filter("score is not null")
        .groupBy("score_name", "range", "score")
        .agg(
            F.count_if(F.col("_label") == 1).cast("double").alias("pos"),
            F.count_if(F.col("_label") == 0).cast("double").alias("neg"),
        )
    )
    lower = Window.partitionBy("score_name", "range").orderBy("score")
    ranges = (
        cut.withColumn("beaten", F.sum("neg").over(lower) - F.col("neg") / 2)
        .groupBy("score_name", "range")
        .agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
            F.sum(F.col("pos") * F.col("beaten")).alias("wins"),
        )
    )
    # One row per range and score from here on.
    below = Window.partitionBy("score_name").orderBy("range")
    wins = F.col("wins") + F.col("pos") * (F.sum("neg").over(below) - F.col("neg"))
    return (
        ranges.withColumn("wins", wins)
        .groupBy("score_name")
        .agg(
            F.try_divide(F.sum("wins"), F.sum("pos") * F.sum("neg")).alias("auc"),
            F.sum("pos").cast("bigint").alias("positives"),
            F.sum("neg").cast("bigint").alias("negatives"),
        )
    )


def lift(
    aucs: DataFrame, model: str = "ml_shadow_score", baseline: str = "heuristic_score"
) -> DataFrame:
    """One row: both AUCs, relative lift (0 if the baseline's AUC is 0) and which one is ahead."""
    sides = aucs.agg(
        F.max(F.when(F.col("score_name") == model, F.col("auc"))).alias("ml_auc"),
        F.max(F.when(F.col("score_name") == baseline, F.col("auc"))).alias("heuristic_auc"),
    )
    ml, heuristic = F.col("ml_auc"), F.col("heuristic_auc")
    relative = F.when(heuristic > 0, (ml - heuristic) / heuristic).when(heuristic == 0, 0.0)
    ahead = F.when(ml > heuristic, "ml").when(ml <= heuristic, "heuristic")
    return sides.withColumns({"lift": relative, "ahead": ahead})


def brier(df: DataFrame, label: str = "is_click", score: str = "ml_shadow_score") -> DataFrame:
    """One row: mean squared distance of score and label over the rows with a score (neither null
    nor NaN), and whether both classes are among them; without both it is null."""
    miss = F.col(score).cast("double") - F.col(label)
    usable = F.count_distinct(label) >= 2
    return scored(df, [score]).agg(
        F.when(usable, F.avg(miss * miss)).alias("brier"), F.count("*").alias("rows"),
        usable.alias("usable"),
    )


def probability_bin(p: Column, bins: int = 10) -> Column:
    """Uniform bin of a probability, upper edges inclusive; raises outside [0, 1]."""
    step = 1.0 / bins
    above = F.lit(0)
    for i in range(1, bins):
        above = above + (p > F.lit(i * step)).cast("int")
    bad = F.raise_error(F.concat(F.lit("probability outside [0, 1]: "), p.cast("string")))
    return F.when((p < 0) | (p > 1), bad.cast("int")).otherwise(above)


def calibration_curve(
    df: DataFrame, label: str = "is_click", score: str = "ml_shadow_score", bins: int = 10
) -> DataFrame:
    """One row per non-empty bin of the rows with a score (neither null nor NaN): mean predicted and
    mean observed rate, and the rows in it."""
    p = F.col(score).cast("double")
    return (
        scored(df, [score])
        .groupBy(probability_bin(p, bins).alias("bin"))
        .agg(
            F.avg(p).alias("predicted"), F.avg(label).alias("observed"), F.count("*").alias("rows")
        )
    )


def calibration_error(curve: DataFrame) -> DataFrame:
    """One row: mean gap over bins, the row-weighted gap, a verdict on the former, and whether both
    classes were observed; without both the others are null."""
    gap = F.abs(F.col("predicted") - F.col("observed"))
    usable = F.coalesce((F.max("observed") > 0) & (F.min("observed") < 1), F.lit(False))
    weighted = F.try_divide(F.sum(gap * F.col("rows")), F.sum("rows"))
    error = F.col("calibration_error")
    # Limits of the verdict.
    verdict = F.when(error < 0.05, "high").when(error < 0.15, "moderate").when(
        error.isNotNull(), "miscalibrated"
    )
    return curve.agg(
        F.when(usable, F.avg(gap)).alias("calibration_error"),
        F.when(usable, weighted).alias("weighted_calibration_error"), usable.alias("usable"),
    ).withColumn("verdict", verdict)

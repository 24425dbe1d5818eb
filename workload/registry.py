"""The registered queries. Each reads whole tables of a scale folder and returns a DataFrame."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contracts import EVENT_LABELS, EVENT_TYPES, SCORE_COLUMNS
from feedloom.functions.columns import HOUR, code_to_name, floor_to, name_to_code
from feedloom.operators import evaluation, items, newest, promotion, split, stats, summary
from feedloom.operators.affinity import (
    join_category_affinity,
    join_creator_affinity,
    join_position_bias,
)
from feedloom.operators.frames import conform
from feedloom.operators.ranking import rank_scores
from feedloom.operators.session import session_context, with_session_context
from feedloom.operators.skew import frequent_values
from feedloom.plans import scoring, training
from feedloom.plans.dataset import build_dataset, hot_keys, labelled_impressions
from feedloom.plans.evaluation import shadow_report
from feedloom.sources import files, ledger
from feedloom.sources import tables as tables_source
from feedloom.sources.bootstrap import bootstrap_rows
from workload.views import load


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to nine places, so that two engines agree on the last bits."""
    return df.selectExpr(*[
        f"round({c}, 9) as {c}" if kind == "double" else c for c, kind in df.dtypes
    ])


def base(spark: SparkSession, sf: str) -> tuple[dict, DataFrame]:
    tables = load(spark, sf)
    return tables, items.resolve_items(tables["scroll_impressions"])


def joined(spark: SparkSession, sf: str) -> tuple[dict, DataFrame, dict]:
    tables, rows = base(spark, sf)
    hot = hot_keys(rows, 0.001)
    return tables, items.join_items(
        rows, tables["scrolls"], tables["products"], tables["scroll_stats"],
        tables["item_global_stats"], hot), hot


def featured(spark: SparkSession, sf: str) -> DataFrame:
    return items.item_features(joined(spark, sf)[1])


def columns_of(*names: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(featured(spark, sf).select("impression_id", *names))

    return run


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_impressions(load(spark, sf))


def shadow(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return shadow_report(stored(labelled(spark, sf).select("is_click", *SCORE_COLUMNS)))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return summary.scored(labelled(spark, sf), ["ml_shadow_score"])


def item_type(spark, sf):
    return base(spark, sf)[1].select("impression_id", "item_type")


def dim_joins(spark, sf):
    rows = joined(spark, sf)[1].selectExpr(
        "impression_id", "s_category", "s_creator",
        "if(product_id is not null, p_category, null) as p_category",
        "if(product_id is not null, p_creator, null) as p_creator",
        "s_completion as scroll_completion",
        "if(item_type = 2, g_conversion, null) as product_conversion",
    )
    return rounded(rows)


def affinity_joins(spark, sf):
    tables, rows, hot = joined(spark, sf)
    rows = items.item_features(rows)
    rows = join_category_affinity(rows, tables["user_category_affinity"], hot)
    rows = join_creator_affinity(rows, tables["user_creator_affinity"], hot)
    names = ["user_category_score", "creator_affinity_score"]
    return rounded(conform(rows, names, keep=["impression_id"]))


def position_bias(spark, sf):
    tables, rows = base(spark, sf)
    rows = join_position_bias(rows, tables["position_bias_baseline"])
    return rounded(conform(rows, ["expected_ctr_at_position"], keep=["impression_id"]))


def attribution(spark, sf):
    return labelled(spark, sf).select("impression_id", *EVENT_LABELS)


def composite_click(spark, sf):
    return labelled(spark, sf).select("impression_id", "is_click")


def session(spark, sf):
    impressions = load(spark, sf)["scroll_impressions"]
    ids = impressions.selectExpr("id as impression_id")
    hot = frequent_values(impressions, ["user_id"])["user_id"]
    return rounded(with_session_context(ids, session_context(impressions, hot_users=hot)))


def newest_impressions(spark, sf):
    shown = load(spark, sf)["scroll_impressions"].where(
        "scroll_id is not null or product_id is not null")
    return newest.newest(shown, 1000).select("id", "created_us", "user_id")


def training_frame(spark, sf):
    rows = build_dataset(load(spark, sf))
    return rounded(rows.selectExpr(
        "* except (impressed_at)", "unix_micros(impressed_at) as impressed_us"))


def target_choice(spark, sf):
    chosen = summary.choose_target(summary.target_candidates(labelled(spark, sf)))
    return chosen.select("target", "usable_targets")


def calibration_error(spark, sf):
    error = evaluation.calibration_error(evaluation.calibration_curve(scored(spark, sf)))
    return rounded(error.drop("usable"))


def event_names(spark, sf):
    name = code_to_name("event_type", EVENT_TYPES)
    return load(spark, sf)["scroll_interactions"].selectExpr(
        "id", f"{name} as event_name", f"{name_to_code(name, EVENT_TYPES)} as event_code")


def stored(df: DataFrame) -> DataFrame:
    """Computed once, for operators that read their input more than once."""
    files.set_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def split_rows(spark, sf):
    rows = stored(labelled(spark, sf).select("impression_id", "is_click"))
    cuts = split.test_cuts(rows, "is_click", "impression_id")
    return rows.select(
        "impression_id", split.split_hash("impression_id").alias("hash"),
        split.is_test("is_click", "impression_id", cuts).alias("is_test"))


def rank_inputs(spark, sf) -> DataFrame:
    tables, rows, _ = joined(spark, sf)
    rows = join_position_bias(items.item_features(rows), tables["position_bias_baseline"])
    return rows.fillna(0.05, ["expected_ctr_at_position"])


RANK_COLUMNS = [
    "impression_id", "qualified_view_score", "completion_score", "save_score",
    "product_click_score", "fast_skip_score", "final_rank_score", "ranker_version",
]


def ranks(spark, sf):
    rows = rank_inputs(spark, sf).selectExpr(
        "*", "coalesce(ml_shadow_score, 0.5D) as engagement_score",
        "coalesce(ml_commerce_score, 0.5D) as commerce_score")
    return rounded(rank_scores(rows).select(*RANK_COLUMNS))


def ranks_without_models(spark, sf):
    """A scoring request: without the position's hint, which then counts as 0."""
    tables, _, hot = joined(spark, sf)
    rows = rank_inputs(spark, sf).drop("expected_ctr_at_position")
    rows = join_category_affinity(rows, tables["user_category_affinity"], hot)
    return rounded(scoring.score(rows, keep=["impression_id"]).select(*RANK_COLUMNS))


def promotion_gate(spark, sf):
    runs = summary.dataset_summary(
        labelled(spark, sf), ["recommendation_run_id", "ranking_version"])
    facts = runs.selectExpr(
        "*", "recommendation_run_id > 'run-1' as active_models_exist",
        "click_positives % 2 = 1 as engagement_used_fallback",
        "commerce_positives % 3 = 0 as commerce_used_fallback")
    return promotion.promotion_gate(facts, 250, 80, 70).selectExpr(
        "recommendation_run_id", "ranking_version",
        "array_join(promotion_reasons, '; ') as reasons", "promotion_allowed")


def retention(spark, sf):
    hour = f"cast({floor_to('created_us', HOUR)} / {HOUR} as bigint)"
    runs = load(spark, sf)["scroll_impressions"].selectExpr(
        f"concat(recommendation_run_id, '-', cast({hour} as string)) as run_id")
    runs = runs.groupBy("run_id").count().withColumnRenamed("count", "rows")
    active = runs.agg({"run_id": "min"}).head()[0]
    return newest.expired_runs(runs, 10, active)


def bootstrap(spark, sf):
    ids = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id as sample_id")
    return rounded(bootstrap_rows(ids))


def batch_probability(spark, sf):
    """Both models, trained in full on the whole dataset, score every row of it. Returned is what
    does not depend on the trees: the rows, and how many break the contract of a score."""
    files.set_checkpoint_dir(spark)
    rows = build_dataset(load(spark, sf)).checkpoint()
    commerce = summary.choose_target(summary.target_candidates(rows)).head()["target"]
    models = tuple(model for model, _ in training.side_by_side(spark, [
        partial(training.fit, task, rows, name)
        for task, name in ((training.ENGAGEMENT, "is_click"), (training.COMMERCE, commerce))], rows.count()))
    again = rank_scores(scoring.score(rows, models, keep=["impression_id"]).selectExpr(
        "impression_id", "engagement_score", "commerce_score", "completion_rate",
        "expected_ctr_at_position", "final_rank_score as given"))
    bad = "count_if(coalesce({0} is null or isnan({0}) or {0} < 0 or {0} > 1, true))"
    return again.selectExpr(
        "count(*) as rows", "count(distinct impression_id) as impressions",
        f"{bad.format('engagement_score')} as bad_engagement",
        f"{bad.format('commerce_score')} as bad_commerce",
        "count_if((abs(final_rank_score - given) < 1e-12) is not true) as rank_differs")


def feature_importance(spark, sf):
    """Both tasks, trained in full by the job's own path on rows with a known click rule, one for
    each event; the first dataset asked for is missing. Returned is the metadata that is kept of a
    run and what holds of its importances whatever the trees are."""
    folder = files.scratch_folder(spark, "training")
    ids = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id as sample_id")
    count = ids.count()
    bootstrap_rows(training.spread_evenly(ids, count)).write.parquet(f"{folder}/rows")
    tasks, out = (training.ENGAGEMENT, training.COMMERCE), None
    trained = training.side_by_side(spark, [
        partial(training.train, spark, task, [f"{folder}/missing", f"{folder}/rows"], f"{folder}/{task.name}")
        for task in tasks], count)
    files.delete_folder(spark, folder)
    for model, facts in trained:
        rows = training.feature_importance(model).selectExpr(
            "count(*) as features", "round(sum(importance), 9) as total",
            "count_if(importance < 0) as negative")
        names = ("task", "target", "used_fallback_dataset", "row_count", "positive_count", "negative_count")
        rows = rows.withColumns({name: F.lit(facts[name]) for name in names}).withColumn(
            "above_floor", F.lit(facts["auc_roc"] > 0.8))
        out = rows if out is None else out.unionByName(rows)
    return out


def run_ledger(spark, sf):
    """The newest and the active one of runs that the impressions name, one entry per hour."""
    hour = f"cast({floor_to('created_us', HOUR)} / {HOUR} as bigint)"
    entries = load(spark, sf)["scroll_impressions"].groupBy(F.expr(
        f"concat(recommendation_run_id, '-', cast({hour} as string))").alias("run_id")).agg(
        F.expr("timestamp_micros(max(created_us * 100 + id % 100))").alias("recorded_at"),
        F.expr("if(count(*) % 4 = 0, 'failed', 'completed')").alias("state"),
        F.expr("count(*) % 3 = 0").alias("promoted"))
    return ledger.newest_of(entries).selectExpr("'latest' as kind", "run_id", "state").unionByName(
        ledger.newest_of(ledger.promoted(entries)).selectExpr("'active' as kind", "run_id", "state"))


def key_uniqueness(spark, sf):
    """Keys of each input table that occur more than once."""
    return tables_source.repeated_key_counts(load(spark, sf))


def scroll_stats(spark, sf):
    tables = load(spark, sf)
    return stats.scroll_stats(tables["scroll_impressions"], tables["scroll_interactions"])


def product_stats(spark, sf):
    tables = load(spark, sf)
    return stats.product_stats(tables["scroll_impressions"], tables["scroll_interactions"])


QUERIES = {
    "item_type": item_type,
    "category_resolution": columns_of("category", "content_category", "creator_id"),
    "item_quality": columns_of("video_quality", "has_products"),
    "popularity": columns_of(
        "completion_rate", "global_ctr", "global_conversion_rate", "social_proof_score"),
    "freshness": columns_of(
        "hour_of_day", "is_product", "content_created_us", "content_freshness"),
    "semantic_flags": columns_of(
        "retrieval_score", "semantic_score", "has_semantic_candidate",
        "semantic_profile_strength"),
    "dim_joins": dim_joins,
    "affinity_joins": affinity_joins,
    "position_bias": position_bias,
    "attribution": attribution,
    "composite_click": composite_click,
    "session_context": session,
    "newest_impressions": newest_impressions,
    "training_frame": training_frame,
    "dataset_rates": lambda spark, sf: rounded(summary.dataset_rates(labelled(spark, sf))),
    "dataset_summary": lambda spark, sf: rounded(summary.dataset_summary(labelled(spark, sf))),
    "target_candidates": lambda spark, sf: rounded(summary.target_candidates(labelled(spark, sf))),
    "target_choice": target_choice,
    "label_distribution": lambda spark, sf: summary.label_distribution(scored(spark, sf)),
    "class_guard": lambda spark, sf: summary.has_both_classes(scored(spark, sf)),
    "brier": lambda spark, sf: rounded(evaluation.brier(scored(spark, sf)).drop("usable")),
    "calibration_curve": lambda spark, sf: rounded(evaluation.calibration_curve(scored(spark, sf))),
    "calibration_error": calibration_error,
    "auc": lambda spark, sf: rounded(shadow(spark, sf)[0]),
    "lift": lambda spark, sf: rounded(shadow(spark, sf)[1]),
    "event_names": event_names,
    "split": split_rows,
    "split_balance": lambda spark, sf: rounded(
        split.split_balance(stored(labelled(spark, sf).select("impression_id", "is_click")), "is_click")),
    "rank_scores": ranks,
    "rank_scores_without_models": ranks_without_models,
    "promotion_gate": promotion_gate,
    "retention": retention,
    "bootstrap": bootstrap,
    "batch_probability": batch_probability,
    "feature_importance": feature_importance,
    "run_ledger": run_ledger,
    "key_uniqueness": key_uniqueness,
    "scroll_stats_from_logs": scroll_stats,
    "product_stats_from_logs": product_stats,
    "position_baseline_from_logs": lambda spark, sf: rounded(
        stats.position_baseline(labelled(spark, sf))),
}

"""Sources, training, scoring and the cycle on synthetic rows."""
import threading
import time
from dataclasses import replace

import pytest
from conftest import at
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from feedloom.contracts import FEATURE_COLUMNS, REQUIRED_TABLES, SOURCE_COLUMNS
from feedloom.functions.columns import code_to_name, name_to_code
from feedloom.operators.stats import product_stats, scroll_stats
from feedloom.plans import cycle, training
from feedloom.plans.scoring import active_models, score
from feedloom.sources import bootstrap, datasets, ledger, tables as sources

SMALL = (replace(training.ENGAGEMENT, max_iter=4), replace(training.COMMERCE, max_iter=4))


@pytest.fixture(scope="module")
def synthetic(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("synthetic") / "rows")
    bootstrap.bootstrap(spark, 4000).write.parquet(path)
    return path


def test_bootstrap(spark):
    rows = bootstrap.bootstrap(spark, 4000)
    stats = rows.agg(
        F.avg("is_click").alias("click"), F.avg("has_products").alias("products"),
        F.min("position_index").alias("low"), F.max("position_index").alias("high"),
        F.max("hour_of_day").alias("hour"), F.avg("video_quality").alias("quality"),
        F.count_if(F.expr(
            "is_purchase = 1 and is_click = 0")).alias("odd"),
    ).head()
    assert 0.2 < stats.click < 0.5 and stats.products == pytest.approx(0.7, abs=0.03)
    assert (stats.low, stats.high, stats.hour, stats.odd) == (0, 14, 23, 0)
    assert stats.quality == pytest.approx(0.5, abs=0.02)
    other = bootstrap.bootstrap_rows(spark.range(4000).toDF("sample_id").repartition(7))
    assert rows.exceptAll(other).count() == 0


def test_train_engagement(spark, synthetic, tmp_path):
    path = str(tmp_path / "model")
    model, facts = training.train(
        spark, SMALL[0], [str(tmp_path / "none"), synthetic], path)
    assert facts["used_fallback_dataset"] and facts["dataset_path"] == synthetic
    assert facts["auc_roc"] > 0.8
    assert facts["row_count"] == facts["positive_count"] + facts["negative_count"] == 4000
    importance = training.feature_importance(model).collect()
    assert importance[0].feature == "user_category_score"
    assert sum(r.importance for r in importance) == pytest.approx(1)
    assert training.model_features(model) == FEATURE_COLUMNS
    rows = spark.read.parquet(synthetic)
    loaded = PipelineModel.load(path)
    first = score(rows, (model, None), ["sample_id"])
    second = score(rows, (loaded, None), ["sample_id"])
    assert first.exceptAll(second).count() == 0
    assert first.where("final_rank_score not between 0 and 1").count() == 0


def test_train_commerce_picks_a_target(spark, synthetic, tmp_path):
    _, facts = training.train(spark, SMALL[1], [synthetic], str(tmp_path / "model"))
    assert (facts["target"], facts["used_fallback_dataset"]) == ("is_purchase", False)
    assert facts["auc_roc"] > 0.7


def test_no_usable_dataset(spark, tmp_path):
    path = str(tmp_path / "few")
    bootstrap.bootstrap(spark, 5).write.parquet(path)
    with pytest.raises(RuntimeError):
        training.train(spark, SMALL[0], [path], str(tmp_path / "model"))


def test_cycle(spark, tables, synthetic, tmp_path):
    root = str(tmp_path)
    log = f"{root}/training_runs"
    assert active_models(spark, log) == (None, None)
    data = tables(
        scroll_impressions=[
            {"id": i, "user_id": i % 5, "scroll_id": i % 7, "position_index": i % 3,
             "created_at": at(i * 4000)} for i in range(60)],
        scroll_interactions=[
            {"impression_id": i, "event_type": 6, "created_at": at()} for i in range(0, 60, 3)])
    first = cycle.run_cycle(spark, data, root, synthetic, tasks=SMALL)
    assert first["state"] == "completed", first.get("error")
    # Nothing was active yet, so the run is promoted despite the reason.
    assert first["promoted"] and first["promotion_reasons"] == [
        "dataset too small (60 rows < 250)"]
    models = active_models(spark, log)
    assert all(isinstance(m, PipelineModel) for m in models)
    written = datasets.read_dataset(spark, f"{root}/datasets/{first['run_id']}")
    assert written.count() == 60 and len(written.columns) == 53
    facts = ledger.active(spark, log)
    assert facts["engagement"]["dataset_path"].endswith(first["run_id"])
    assert facts["config"]["min_rows"] == 250

    summary = {"rows": 60, "click_positives": 20, "commerce_positives": 20}
    used = {"used_fallback_dataset": True}
    config = cycle.CycleConfig(min_rows=10)
    allowed, reasons = cycle.decide(spark, summary, used, used, True, config)
    assert not allowed and len(reasons) == 2
    assert cycle.decide(spark, summary, used, used, True, config, force=True)[0]


def test_failed_cycle(spark, tables, synthetic, tmp_path):
    got = cycle.run_cycle(spark, tables(), str(tmp_path), synthetic, tasks=SMALL)
    assert got["state"] == "failed" and "no rows" in got["error"]
    last = ledger.latest(spark, f"{tmp_path}/training_runs")
    assert last["state"] == "failed" and ledger.active(spark, f"{tmp_path}/training_runs") is None


def test_tables(spark, tables, tmp_path):
    data = tables(scroll_impressions=[{"id": 1, "scroll_id": 1}])
    for name, df in data.items():
        df.write.parquet(f"{tmp_path}/{name}")
        df.createOrReplaceTempView(name)
    loaded = sources.from_parquet(spark, str(tmp_path))
    assert loaded["scroll_impressions"].count() == 1
    assert sources.from_catalog(spark)["scroll_impressions"].count() == 1
    assert sources.missing_tables(spark) == []
    assert sources.missing_tables(spark, ["nowhere"]) == ["nowhere"]
    assert sources.missing_columns(data) == {}
    assert sources.missing_columns({**data, "scroll_stats": spark.range(1)})["scroll_stats"]
    for name in REQUIRED_TABLES + list(SOURCE_COLUMNS):
        spark.catalog.dropTempView(name)
    assert sources.missing_tables(spark) == REQUIRED_TABLES


def test_jdbc_options(spark):
    assert sources.jdbc_split(("id", 0, 100, 8)) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}
    assert sources.jdbc_split(None) == {}


def test_event_names(spark):
    codes = {"A": 1, "B": 2}
    row = spark.range(1).selectExpr(
        f"{code_to_name('2', codes)} as n", f"{code_to_name('9', codes)} as none",
        f"{name_to_code(chr(39) + 'A' + chr(39), codes)} as c").head()
    assert (row.n, row.none, row.c) == ("B", None, 1)


def test_rebuilt_stats(table):
    shown = table("scroll_impressions", {"id": 1, "scroll_id": 5}, {"id": 2, "product_id": 6})
    acted = table(
        "scroll_interactions", {"scroll_id": 5, "event_type": 2}, {"product_id": 6, "event_type": 8},
        {"product_id": 7, "event_type": 6})
    assert scroll_stats(shown, acted).head().asDict() == {
        "scroll_id": 5, "impressions": 1, "completions": 1, "qualified_views": 0, "purchases": 0}
    got = {r.item_id: r for r in product_stats(shown, acted).collect()}
    assert (got[6].impressions, got[6].purchases, got[7].impressions, got[7].clicks) == (1, 1, 0, 1)


def test_boosting_gets_even_partitions(spark, synthetic, monkeypatch):
    """Rows in one partition of nine, a third without an id and a third twice: every core gets its share."""
    rows = bootstrap.bootstrap(spark, 3000).coalesce(1).unionByName(
        spark.read.parquet(synthetic).where("false").repartition(8)).withColumn(
        "sample_id", F.expr("case sample_id % 3 when 0 then null when 1 then 1 else sample_id end"))
    seen, fit = [], training.GBTClassifier.fit
    def watched(self, df):
        seen.append([r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()])
        return fit(self, df)
    monkeypatch.setattr(training.GBTClassifier, "fit", watched)
    training.fit(replace(SMALL[0], max_iter=1), rows, "is_click")
    assert len(seen[0]) == spark.sparkContext.defaultParallelism
    assert max(seen[0]) < 1.5 * sum(seen[0]) / len(seen[0])
    many = training.spread_evenly(rows, 3000, most=100)
    assert many.rdd.getNumPartitions() >= 30 and many.exceptAll(rows).count() == 0 and many.count() == 3000


def test_large_models_train_one_after_the_other(spark):
    """Two at once would keep both models' rows in the executors."""
    running, most, lock = [0], [0], threading.Lock()
    def step():
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.3)
        with lock:
            running[0] -= 1
        return most[0]
    assert max(training.side_by_side(spark, [step, step], 1000)) == 2
    most[0] = 0
    bound = training.ROWS_PER_TASK * spark.sparkContext.defaultParallelism
    assert training.side_by_side(spark, [step, step], bound + 1) == [1, 1]


def test_garbage_is_collected_while_models_train(spark, monkeypatch):
    """The driver's heap is collected in full again and again while a model trains, and not only when it is full."""
    monkeypatch.setattr(training, "RELEASE_SECONDS", 0.2, raising=False)
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    def full():
        return sum(bean.getCollectionCount() for bean in beans if "Young" not in bean.getName())
    def step():
        before, until = full(), time.time() + 10
        while full() < before + 3 and time.time() < until:
            time.sleep(0.1)
        return full() - before
    assert training.side_by_side(spark, [step])[0] >= 3
    def broken():
        raise ValueError("no rows")
    with pytest.raises(ValueError):
        training.side_by_side(spark, [broken, lambda: time.sleep(0.5)])

"""Streaming attribution and scoring against the batch operators."""
from dataclasses import replace
from datetime import timedelta

import pytest
from conftest import SCHEMAS, at

from feedloom.operators.attribution import LABEL_CODES, label_masks, with_labels
from feedloom.operators.items import resolve_items
from feedloom.plans import training
from feedloom.plans.scoring import score
from feedloom.sources import bootstrap, ledger
from feedloom.streaming.attribution import attribute_stream, nearby_stream, stream_labels
from feedloom.streaming.scoring import score_stream

NAMES = [*LABEL_CODES, "is_click"]
#: Rows of state after each batch, by the stream's checkpoint.
STATES: dict[str, list[int]] = {}


#: A row of each log long after all others, of a user of its own, with which the watermark passes them.
LATER = {"user_id": 99, "scroll_id": 99, "created_at": at(30 * 86400)}


def streamed(spark, tmp_path, table, shown, acted, **options):
    """Labels by the stream's masks, once the watermark has passed all rows."""
    paths = {}
    shown, acted = [*shown, LATER | {"id": -1}], [*acted, LATER | {"event_type": 3}]
    for name, rows in (("scroll_impressions", shown), ("scroll_interactions", acted)):
        paths[name] = str(tmp_path / name)
        for part in [rows[:len(rows) // 2], rows[len(rows) // 2:]]:
            table(name, *part).coalesce(1).write.mode("append").parquet(paths[name])
    streams = {
        name: spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", 1).parquet(path)
        for name, path in paths.items()
    }
    out = str(tmp_path / "out")
    query = (
        attribute_stream(streams["scroll_impressions"], streams["scroll_interactions"], **options)
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination(180)
    assert query.exception() is None
    STATES[str(tmp_path / "checkpoint")] = [
        sum(op.numRowsTotal for op in progress.stateOperators) for progress in query.recentProgress]
    rows = stream_labels(
        spark.read.parquet(paths["scroll_impressions"]), spark.read.parquet(out)).collect()
    got = {r.impression_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(got) == len(rows)
    del got[-1]
    return got


def batched(table, shown, acted):
    base = resolve_items(table("scroll_impressions", *shown))
    rows = with_labels(base, label_masks(base, table("scroll_interactions", *acted))).collect()
    return {r.impression_id: tuple(r[n] for n in NAMES) for r in rows}


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_equals_batch(spark, tmp_path, table, salts):
    shown = [
        {"id": i, "user_id": [None, 1, 2][i % 3], "scroll_id": i % 4,
         "product_id": i % 3 if i % 5 == 0 else None, "session_id": [None, "a"][i % 2],
         "item_type": 3 if i == 7 else None, "created_at": at(i * 60)} for i in range(24)]
    acted = [
        {"user_id": 1 + i % 2, "scroll_id": i % 4, "product_id": i % 3, "event_type": 1 + i % 15,
         "session_id": [None, "a"][i % 2], "impression_id": i if i % 4 == 0 else None,
         "created_at": at(i * 90)} for i in range(24)]
    acted += [
        {"user_id": 1, "scroll_id": 1, "event_type": 8, "created_at": at(60)},
        {"user_id": 1, "scroll_id": 1, "event_type": 9, "created_at": at(60 + 3600)}]
    got = streamed(spark, tmp_path, table, shown, acted, salts=salts)
    expected = batched(table, shown, acted)
    assert got == expected
    assert any(sum(flags) for flags in got.values())
    assert any(not sum(flags) for flags in got.values())


def test_events_that_name_their_impression_count_at_any_time(spark, tmp_path, table):
    """Two days later, before the impression, and for an impression without a time."""
    shown = [{"id": 1, "user_id": 1, "scroll_id": 1, "created_at": at(0)},
             {"id": 2, "user_id": 1, "scroll_id": 2, "created_at": at(60)},
             {"id": 3, "user_id": 2, "scroll_id": 3, "created_at": None},
             {"id": 4, "user_id": 2, "scroll_id": 3, "created_at": None}]
    acted = [{"impression_id": 1, "event_type": 8, "created_at": at(2 * 86400)},
             {"impression_id": 2, "event_type": 9, "created_at": at(-3600)},
             {"impression_id": 3, "event_type": 2, "created_at": at(5)},
             {"impression_id": 3, "event_type": 8, "created_at": None},
             {"user_id": 1, "scroll_id": 1, "event_type": 7, "created_at": at(30)}]
    got = streamed(spark, tmp_path, table, shown, acted)
    assert got == batched(table, shown, acted) and set(got) == {1, 2, 3, 4}
    purchase = NAMES.index("is_purchase")
    assert got[1][purchase] == got[3][purchase] == 1 and not any(got[4])


def test_a_hot_user_and_item_with_salts(spark, tmp_path, table):
    shown = [{"id": i, "user_id": 1, "scroll_id": 1, "created_at": at(i)} for i in range(60)]
    acted = [{"user_id": 1, "scroll_id": 1, "event_type": 1 + i % 15, "created_at": at(3 * i)}
             for i in range(20)]
    assert streamed(spark, tmp_path, table, shown, acted, salts=8) == batched(table, shown, acted)


def test_nearby_state_ends_with_the_horizon(spark, tmp_path, table):
    table("scroll_impressions").write.parquet(str(tmp_path / "a"))
    table("scroll_interactions").write.parquet(str(tmp_path / "b"))
    stream = nearby_stream(
        spark.readStream.schema(SCHEMAS["scroll_impressions"]).parquet(str(tmp_path / "a")),
        spark.readStream.schema(SCHEMAS["scroll_interactions"]).parquet(str(tmp_path / "b")))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "INTERVAL '61' MINUTE" in plan and "INTERVAL '1440'" not in plan


def test_output_and_state_in_proportion_to_the_impressions(spark, tmp_path, table):
    """10,000 impressions and 10,000 events of one user and item within an hour: 10^8 pairs, and no
    more rows than minutes an impression; the state is gone when the horizon has passed."""
    n = 10_000
    shown = [{"id": i, "user_id": 1, "scroll_id": 1, "created_at": at(i * 0.36 + 0.01)} for i in range(n)]
    acted = [{"user_id": 1, "scroll_id": 1, "event_type": 1 + i % 15, "created_at": at(i * 0.36)} for i in range(n)]
    got = streamed(spark, tmp_path, table, shown, acted)
    assert got == batched(table, shown, acted)
    masks = spark.read.parquet(str(tmp_path / "out"))
    assert n / 2 < masks.count() <= 61 * n
    state = STATES[str(tmp_path / "checkpoint")]
    assert max(state) <= 3 * n and state[-1] <= 4


def test_minutes_at_the_edges_of_the_horizon(spark, tmp_path, table):
    """Events around an impression and around the end of its hour, microseconds apart, out of order."""
    shown = [{"id": i, "user_id": 1, "scroll_id": 1, "session_id": [None, "a", "b"][i % 3],
              "created_at": at(30.5) + timedelta(microseconds=i // 3)} for i in range(12)]
    acted = [{"user_id": 1, "scroll_id": 1, "event_type": 1 + i, "session_id": [None, "a"][i % 4 // 2],
              "created_at": at(30.5 + 3600 * (i % 2)) + timedelta(microseconds=(i * 4) % 7 - 2)} for i in range(15)]
    got = streamed(spark, tmp_path, table, shown, acted)
    assert got == batched(table, shown, acted) and len(set(got.values())) > 3


def test_scoring_stream_uses_the_active_models(spark, tmp_path):
    items = str(tmp_path / "items")
    bootstrap.bootstrap(spark, 300).write.parquet(items)
    log, model_path = str(tmp_path / "runs"), str(tmp_path / "model")
    task = replace(training.ENGAGEMENT, max_iter=2)
    model, facts = training.train(spark, task, [items], model_path)
    schema = spark.read.parquet(items).schema

    def run(name):
        out = str(tmp_path / name)
        query = score_stream(
            spark.readStream.schema(schema).parquet(items), log, out,
            str(tmp_path / f"{name}-checkpoint"), ["sample_id"], {"availableNow": True})
        query.awaitTermination(180)
        assert query.exception() is None
        return spark.read.parquet(out).drop("batch_id")

    neutral = run("before")
    assert {r.engagement_score for r in neutral.collect()} == {0.5}
    ledger.append(spark, log, {
        "run_id": "r1", "state": "completed", "promoted": True, "recorded_at": at(),
        "engagement": tuple(facts.values()), "commerce": tuple(facts.values())})
    got = run("after")
    expected = score(spark.read.parquet(items), (model, model), ["sample_id"])
    assert got.exceptAll(expected).count() == 0 and got.count() == 300

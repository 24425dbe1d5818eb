"""The jobs, run in the test's session, and cycles that must not harm what serves."""
from dataclasses import replace

import pytest
from conftest import at

from feedloom.__main__ import arguments, main
from feedloom.operators.attribution import label_masks, with_labels
from feedloom.operators.items import resolve_items
from feedloom.plans import cycle, training
from feedloom.plans.scoring import score
from feedloom.sources import bootstrap, ledger
from feedloom.sources import tables as sources

SMALL = tuple(replace(t, max_iter=2) for t in (training.ENGAGEMENT, training.COMMERCE))
MODEL = ("engagement", "d", False, "is_click", 0.5, 1, 1, 1, "m")


@pytest.fixture(scope="module")
def folder(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    data = tables(
        scroll_impressions=[{"id": i, "user_id": i % 3, "scroll_id": i % 4, "created_at": at(i * 600)}
                            for i in range(40)],
        scroll_interactions=[{"user_id": i % 3, "scroll_id": i % 4, "event_type": 6, "created_at": at(i * 900)}
                             for i in range(20)] + [{"impression_id": 3, "event_type": 8, "created_at": at(10**6)}])
    for name, df in data.items():
        df.write.parquet(f"{root}/{name}")
    return root


def test_build_of_a_time_range(spark, folder, tmp_path):
    main(["build", "--tables", folder, "--out", str(tmp_path / "day"),
          "--start", "2024-03-01T12:20:00", "--end", "2024-03-01T14:00:00+00:00"])
    ids = {int(r.impression_id) for r in spark.read.parquet(str(tmp_path / "day")).collect()}
    assert ids == set(range(2, 12))


def test_scoring_job(spark, tmp_path):
    items, out = str(tmp_path / "items"), str(tmp_path / "out")
    bootstrap.bootstrap(spark, 50).drop("expected_ctr_at_position").write.parquet(items)
    main(["score", "--data", items, "--keep", "sample_id", "--out", out])
    got = spark.read.parquet(out)
    assert got.count() == 50 and {r.engagement_score for r in got.collect()} == {0.5}
    assert {r.expected_ctr_at_position for r in got.collect()} == {0.0}
    assert got.exceptAll(score(spark.read.parquet(items), keep=["sample_id"])).count() == 0
    short = str(tmp_path / "short")
    bootstrap.bootstrap(spark, 5).drop("hour_of_day").write.parquet(short)
    with pytest.raises(ValueError, match="hour_of_day"):
        main(["score", "--data", short, "--keep", "sample_id", "--out", str(tmp_path / "none")])


def test_scoring_stream_job(spark, tmp_path):
    items, out = str(tmp_path / "items"), str(tmp_path / "out")
    bootstrap.bootstrap(spark, 30).write.parquet(items)
    main(["score-stream", "--data", items, "--runs", str(tmp_path / "runs"), "--keep", "sample_id",
          "--out", out, "--checkpoint", str(tmp_path / "c"), "--once"])
    assert spark.read.parquet(out).count() == 30


def test_streamed_labels_equal_the_batch(spark, folder, tmp_path):
    masks, out = str(tmp_path / "masks"), str(tmp_path / "labels")
    main(["attribute-stream", "--tables", folder, "--out", masks, "--checkpoint", str(tmp_path / "c"), "--once"])
    main(["labels", "--tables", folder, "--data", masks, "--out", out])
    loaded = sources.from_parquet(spark, folder)
    base = resolve_items(loaded["scroll_impressions"])
    want = with_labels(base, label_masks(base, loaded["scroll_interactions"]))
    got = spark.read.parquet(out)
    assert got.count() == 40 and got.exceptAll(want.select(got.columns)).count() == 0
    assert got.where("impression_id = 3 and is_purchase = 1").count() == 1


def test_check_names_faults(spark, folder, tables, table, capsys):
    main(["check", "--tables", folder])
    assert capsys.readouterr().out == "missing columns: {}\nwrong types: {}\nnull keys: {}\nrepeated keys: {}\n"
    data = tables()
    data["scrolls"] = table("scrolls", {"id": 1}, {"id": 1}, {"id": None}, {"id": None})
    data["products"] = table("products", {"id": None}, {"id": None})
    assert sources.repeated_keys(data) == {"scrolls": {"id": 1}}


def test_jdbc_arguments():
    args = arguments(["build", "--jdbc", "url=jdbc:x:y=z", "driver=d", "--jdbc-range", "scrolls:id:0:9:4"])
    from feedloom.__main__ import jdbc_range, pairs

    assert pairs(args.jdbc) == {"url": "jdbc:x:y=z", "driver": "d"}
    assert dict(map(jdbc_range, args.jdbc_range)) == {"scrolls": ("id", "0", "9", 4)}


@pytest.fixture(scope="module")
def synthetic(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("synthetic") / "rows")
    bootstrap.bootstrap(spark, 300).write.parquet(path)
    return path


def test_a_promoted_run_older_than_the_kept_ones_stays(spark, folder, synthetic, tmp_path):
    root, log = str(tmp_path), f"{tmp_path}/training_runs"
    for i in range(12):
        ledger.append(spark, log, {
            "run_id": f"20200101T0000{i:02}Z", "state": "completed", "promoted": i == 1, "recorded_at": at(i),
            "engagement": MODEL, "commerce": MODEL})
    got = cycle.run_cycle(spark, sources.from_parquet(spark, folder), root, synthetic, tasks=SMALL)
    assert got["state"] == "completed" and not got["promoted"], got.get("error")
    assert sorted(got["expired"]) == ["20200101T000000Z", "20200101T000002Z"]
    assert ledger.active(spark, log)["run_id"] == "20200101T000001Z"


def test_a_cycle_can_refuse_faulty_tables(spark, folder, table, synthetic, tmp_path):
    data = sources.from_parquet(spark, folder) | {"scrolls": table("scrolls", {"id": 1}, {"id": 1})}
    config = cycle.CycleConfig(check_tables=True)
    got = cycle.run_cycle(spark, data, str(tmp_path), synthetic, config, tasks=SMALL)
    assert got["state"] == "failed" and "repeated keys" in got["error"]

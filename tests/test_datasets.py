"""Datasets that are written by day and by range, datasets of any age, checks of the inputs."""
from datetime import datetime, timedelta, timezone

import pytest
from conftest import at
from pyspark.sql import functions as F

from feedloom.__main__ import main
from feedloom.contracts import DATASET_COLUMNS
from feedloom.plans import cycle
from feedloom.plans.dataset import build_dataset
from feedloom.sources import datasets, files
from feedloom.sources import tables as sources

DAY = datetime(2024, 3, 1, tzinfo=timezone.utc)


def day(n: int, hours: int = 0) -> datetime:
    return DAY + timedelta(days=n, hours=hours)


def folder_of(tables, root, ids=range(60), position=0):
    """One impression every two hours from noon of the first day on."""
    data = tables(scroll_impressions=[
        {"id": i, "user_id": i % 3, "scroll_id": i % 4, "position_index": position, "created_at": at(i * 7200)}
        for i in ids])
    for name, df in data.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return str(root)


def ids_of(spark, path):
    return sorted(int(r.impression_id) for r in datasets.read_dataset(spark, path).collect())


def build(folder, out, start=None, end=None):
    bounds = [x for name, t in (("--start", start), ("--end", end)) if t for x in (name, t.isoformat())]
    main(["build", "--tables", folder, "--out", out, *bounds])


def test_daily_builds_into_one_dataset(spark, tables, tmp_path):
    first, out = folder_of(tables, tmp_path / "a"), str(tmp_path / "out")
    build(first, out, day(0), day(1))
    build(first, out, day(1), day(2))
    assert ids_of(spark, out) == list(range(18))
    # A repeated day replaces itself and nothing else.
    again = folder_of(tables, tmp_path / "b", range(6, 12), position=7)
    build(again, out, day(1), day(2))
    assert ids_of(spark, out) == list(range(12))
    rows = {int(r.impression_id): r.position_index for r in datasets.read_dataset(spark, out).collect()}
    assert {rows[i] for i in range(6)} == {0} and {rows[i] for i in range(6, 12)} == {7}
    build(first, out)
    assert ids_of(spark, out) == list(range(60))


def test_a_range_that_cuts_dates_keeps_their_other_rows(spark, tables, tmp_path):
    first, out = folder_of(tables, tmp_path / "a"), str(tmp_path / "out")
    build(first, out)
    changed = folder_of(tables, tmp_path / "b", range(60), position=9)
    build(changed, out, day(1, 3), day(3, 5))
    rows = {int(r.impression_id): r for r in datasets.read_dataset(spark, out).collect()}
    assert sorted(rows) == list(range(60))
    for r in rows.values():
        inside = day(1, 3) <= r.impressed_at.replace(tzinfo=timezone.utc) < day(3, 5)
        assert r.position_index == (9 if inside else 0)


def test_dates_of_the_range_without_rows_go(spark, tables, tmp_path):
    first, out = folder_of(tables, tmp_path / "a"), str(tmp_path / "out")
    build(first, out)
    gone = folder_of(tables, tmp_path / "b", [0, 1, 59])
    build(gone, out, day(1), day(3))
    assert not {r for r in ids_of(spark, out) if 6 <= r < 30} and len(ids_of(spark, out)) == 36
    build(gone, out, None, day(4))
    assert ids_of(spark, out) == [0, 1, *range(42, 60)]
    build(gone, out, day(5, 1), None)
    assert ids_of(spark, out) == [0, 1, *range(42, 55), 59]


def test_dates_with_fewer_columns_read_in_the_contract(spark, tables, tmp_path):
    folder, out = folder_of(tables, tmp_path / "a"), str(tmp_path / "out")
    frame = build_dataset(sources.from_parquet(spark, folder))
    datasets.write_dataset(frame.where(F.col("impression_id") < 30), out)
    old = frame.where(F.to_date("impressed_at") >= "2024-03-04").drop("session_velocity", "is_pause", "ml_shadow_score")
    old = old.drop("position_index").withColumn("unknown", F.lit(1))
    datasets.write_dataset(old, out)
    got = datasets.read_dataset(spark, out)
    assert got.columns == DATASET_COLUMNS and dict(got.dtypes)["session_velocity"] == "double"
    late = got.where("impressed_at >= '2024-03-04'")
    row = late.select("session_velocity", "is_pause", "position_index", "ml_shadow_score").distinct().collect()
    assert [tuple(r) for r in row] == [(1.0, 0, 0, None)]


def test_wrong_types_and_null_keys_are_named(spark, table, tables, tmp_path, capsys):
    data = tables(scrolls=[{"id": 1}, {"id": None}])
    data["products"] = data["products"].withColumn("created_at", F.col("created_at").cast("string"))
    data["scroll_stats"] = data["scroll_stats"].withColumn("impressions", F.lit("7"))
    wrong = {"products": {"created_at": "string"}, "scroll_stats": {"impressions": "string"}}
    assert sources.wrong_types(data) == wrong and sources.wrong_types(tables()) == {}
    assert sources.null_keys(data) == {"scrolls": {"id": 1}}
    assert sources.faults(data) == {"wrong types": wrong}
    assert sources.faults(tables() | {"scrolls": data["scrolls"]}) == {"null keys": {"scrolls": {"id": 1}}}
    assert sources.faults(tables()) == {}
    config = cycle.CycleConfig(check_tables=True)
    got = cycle.run_cycle(spark, data, str(tmp_path), str(tmp_path / "none"), config)
    assert got["state"] == "failed" and "'created_at': 'string'" in got["error"]


def test_cycles_of_one_second_get_ids_of_their_own(spark, tmp_path):
    root, second = str(tmp_path), datetime(2024, 3, 1, 12, 0, 59, 999, tzinfo=timezone.utc)
    ids = [cycle.claimed_run_id(spark, root, second) for _ in range(3)]
    assert ids == ["20240301T120059Z", "20240301T120100Z", "20240301T120101Z"]


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    """A session whose settings name no folder, with the warehouse on each machine's own disk."""
    class Settings:
        def get(self, name, default=None):
            return {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}.get(name, default)

    class Session:
        conf, _jvm, _jsc = Settings(), spark._jvm, spark._jsc

    monkeypatch.setattr(files, "is_local", lambda session: False)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.shared_folder(Session())
    monkeypatch.setattr(files, "is_local", lambda session: True)
    assert files.shared_folder(Session()) == "file:/tmp/warehouse/_checkpoints"

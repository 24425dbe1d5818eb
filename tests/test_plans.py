"""Physical plans and even load of the dataset build."""
import re
from datetime import timedelta

import pytest
from conftest import T0
from pyspark.sql import functions as F

from feedloom.contracts import EVENT_LABELS
from feedloom.operators.attribution import label_masks, thinned, with_labels
from feedloom.operators.items import resolve_items
from feedloom.operators.session import session_context, slot_points
from feedloom.operators.skew import frequent_values
from feedloom.plans.dataset import build_dataset
from feedloom.sources.tables import from_parquet
from workload import views


def plan_of(df) -> str:
    jvm = df._sc._jvm.PythonSQLUtils
    return re.sub(r"#\d+L?", "", jvm.explainString(df._jdf.queryExecution(), "formatted"))


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """Tables in Parquet; a third of both logs is one user, session and item."""
    root = str(tmp_path_factory.mktemp("tables"))
    for name, df in tables().items():
        columns = df.columns
        values = {c: "null" for c in columns}
        if name in ("scroll_impressions", "scroll_interactions"):
            hot = "id % 3 = 0"
            values |= {
                "id": "id",
                "user_id": f"if({hot}, 1L, id % 40)",
                "scroll_id": f"if({hot}, 7, cast(id % 11 as int))",
                "session_id": f"if({hot}, 'bot', if(id % 5 = 0, null, concat('s', id % 3)))",
                "created_at": "timestamp_micros(1709294400000000 + id * 36 * 1000000)",
                "event_type": "cast(1 + id % 15 as int)",
                "position_index": "cast(id % 15 as int)",
            }
        rows = spark.range(2400 if values.get("id") == "id" else 0).selectExpr(
            *[f"cast({values[c]} as {df.schema[c].dataType.simpleString()}) as {c}"
              for c in columns])
        rows.write.parquet(f"{root}/{name}")
    return from_parquet(spark, root)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_joins_and_shuffles(stored, no_broadcast):
    plan = plan_of(build_dataset(stored))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SinglePartition" not in plan.replace("Exchange SinglePartition, EXECUTOR_BROADCAST", "")
    # The log and two item tables each; the second table of a key joins in place.
    arguments = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)
    assert sum(a.startswith("scroll_id, _salt") for a in arguments) == 3
    assert sum(a.startswith("product_key, _salt") for a in arguments) == 3
    # The log, its labels and its session context.
    assert sum(a.startswith("impression_id") for a in arguments) == 3


def test_scans_are_pruned(stored):
    start = T0 + timedelta(hours=2)
    plan = plan_of(build_dataset(stored, start=start, end=start + timedelta(hours=1)))
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    assert sum("GreaterThanOrEqual(created_at" in p for p in pushed) >= 3
    reads = re.findall(r"ReadSchema: struct<([^\n]*)>", plan)
    labels = [r for r in reads if r == "impression_id:bigint,event_type:int"]
    assert labels, reads


def test_time_range_equals_a_cut_of_the_whole(stored):
    start = T0 + timedelta(hours=5, minutes=10)
    end = start + timedelta(hours=3)
    some = build_dataset(stored, start=start, end=end)
    cut = build_dataset(stored).where(
        (F.col("impressed_at") >= F.lit(start)) & (F.col("impressed_at") < F.lit(end)))
    assert some.count() == cut.count() == 300
    assert some.exceptAll(cut).count() == 0


def test_history_before_a_range_is_not_cut_into_slots(stored, no_broadcast):
    """Rows before the range, less the look-back, meet no exchange by slot."""
    since = T0 + timedelta(hours=6)
    plan = plan_of(session_context(stored["scroll_impressions"], since=since))
    scans = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    whole = [p for p in scans if "GreaterThanOrEqual(created_at" not in p]
    # The one scan of the history groups by user and session alone.
    assert len(whole) == 1 and "LessThan(created_at" in whole[0]
    arguments = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)
    assert sum(a.startswith("user_id, session_id, ") and "width" not in a and "slot" not in a
               for a in arguments) >= 2


def test_newest_rows_bound_what_is_read(stored):
    some = build_dataset(stored, limit=150)
    plan = plan_of(some)
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    assert sum("GreaterThanOrEqual(created_at" in p for p in pushed) >= 2
    newest = build_dataset(stored).orderBy(F.desc("impressed_at"), F.desc(F.col("impression_id").cast("long"))).limit(150)
    assert some.count() == 150 and some.exceptAll(newest).count() == 0


@pytest.mark.parametrize("hot_users", [[1], [1, 2, 3], list(range(40))])
def test_labels_of_hot_users_are_the_same(stored, hot_users):
    base = resolve_items(stored["scroll_impressions"])
    acted = stored["scroll_interactions"].withColumn(
        "created_at", F.expr("created_at + make_interval(0, 0, 0, 0, 0, id % 7, id % 61)"))
    for horizon in (1, 60):
        plain = with_labels(base, label_masks(base, acted, horizon_minutes=horizon))
        split = with_labels(base, label_masks(base, acted, horizon_minutes=horizon, hot_users=hot_users))
        assert split.exceptAll(plain).count() == 0 and split.count() == plain.count()


def test_a_hot_key_in_one_slot_spreads(spark, tables):
    """A third of both logs is one user, item and session within a quarter of an hour."""
    shown, acted = tables()["scroll_impressions"], tables()["scroll_interactions"]
    def log(df, n, values):
        return spark.range(n).selectExpr(*[
            f"cast({values.get(c, 'null')} as {df.schema[c].dataType.simpleString()}) as {c}" for c in df.columns])
    values = {
        "id": "id", "user_id": "if(id % 3 = 0, 1, 100 + id % 500)", "scroll_id": "if(id % 3 = 0, 7, id % 50)",
        "session_id": "if(id % 3 = 0, 'bot', null)", "event_type": "1 + id % 15",
        "created_at": "timestamp_micros(1709294400000000 + (id * 7919 % 900) * 1000000)"}
    base = resolve_items(log(shown, 9000, values))
    events = log(acted, 9000, values)
    hot = frequent_values(base, ["user_id"])["user_id"]
    assert 1 in hot
    kept = thinned(events.selectExpr("*", "unix_micros(created_at) as us").select(
        "user_id", "session_id", "scroll_id", "product_id", "event_type", "us"), [1])
    # 15 minutes, twelve kinds or so, two ends: whatever the number of events.
    assert kept.where("user_id = 1").count() <= 16 * 15 * 2
    got = with_labels(base, label_masks(base, events, hot_users=hot))
    plain = with_labels(base, label_masks(base, events))
    assert got.exceptAll(plain).count() == 0 and got.count() == 9000


def test_hot_user_makes_small_groups(stored):
    """24 hours of log: a third of the rows is one user in one session."""
    shown = stored["scroll_impressions"]
    for hot_users, share in ((None, 1 / 6), ([1], 1 / 20)):
        points = slot_points(shown, hot_users=hot_users)
        biggest = points.groupBy("user_id", "slot").count().agg(F.max("count")).head()[0]
        assert biggest <= 800 * share * 1.3


def test_more_events_never_lower_a_flag(stored):
    base = resolve_items(stored["scroll_impressions"])
    acted = stored["scroll_interactions"]
    some = with_labels(base, label_masks(base, acted.where("id % 2 = 0")))
    both = with_labels(base, label_masks(base, acted))
    pairs = some.alias("a").join(both.alias("b"), "impression_id")
    lowered = F.greatest(*[F.col(f"a.{c}") - F.col(f"b.{c}") for c in EVENT_LABELS])
    assert pairs.count() == 2400 and pairs.where(lowered > 0).count() == 0
    assert both.agg(F.sum("is_click")).head()[0] > some.agg(F.sum("is_click")).head()[0] > 0


def test_large_tables_in_small_files_are_not_broadcast(spark, tables, tmp_path):
    """20,000 items and affinities of few values take less than the threshold as files; broadcast they
    would all go through the driver. A table of few rows is still broadcast."""
    data = dict(tables())
    def rows(name, n, values):
        df = data[name]
        spark.range(n).selectExpr(*[
            f"cast({values.get(c, 'null')} as {df.schema[c].dataType.simpleString()}) as {c}" for c in df.columns
        ]).write.parquet(f"{tmp_path}/{name}")
        data[name] = spark.read.parquet(f"{tmp_path}/{name}")
    many = 20_000
    rows("scroll_impressions", 500, {
        "id": "id", "user_id": "id % 40", "scroll_id": "id % 11", "position_index": "id % 15",
        "created_at": "timestamp_micros(1709294400000000 + id * 36 * 1000000)"})
    rows("scroll_interactions", 500, {"id": "id", "impression_id": "id", "event_type": "6"})
    rows("scrolls", many, {"id": "id", "user_id": "1", "category": "'a'"})
    rows("products", many, {"id": "id", "user_id": "1", "category": "'a'"})
    rows("scroll_stats", many, {"scroll_id": "id", "impressions": "1"})
    rows("item_global_stats", many, {"item_id": "id", "item_type": "2", "impressions": "1"})
    rows("user_category_affinity", many, {"user_id": "id", "category_id": "'a'", "score": "1"})
    rows("user_creator_affinity", many, {"user_id": "id", "creator_id": "1", "score": "1"})
    frame = build_dataset(data)
    plan = plan_of(frame)
    # The position baseline alone.
    assert len(re.findall(r"^\(\d+\) BroadcastExchange", plan, re.M)) == 1
    assert frame.count() == 500
    rows("position_bias_baseline", 3, {"position_index": "id", "expected_ctr": "0.1"})
    few = {**data, "scrolls": data["scrolls"].where("id < 100"), "scroll_stats": data["scroll_stats"].where("scroll_id < 100")}
    assert len(re.findall(r"^\(\d+\) BroadcastExchange", plan_of(build_dataset(few)), re.M)) == 3


def test_views_do_not_broadcast_the_items(spark, tmp_path):
    """What batch_probability and all queries with affinities read: 20,000 items in a small file."""
    spark.range(300).selectExpr(
        "id as event_id", "timestamp_micros(1704067200000000 + id * 1000000) as ts", "id % 40 as user_id",
        "if(id % 2 = 0, 'click', 'purchase') as event_type", "1D as value", "'{\"k\": 3}' as props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(20_000).selectExpr(
        "id as p_partkey", "'a' as p_name", "'b' as p_brand", "'c' as p_type", "1 as p_size", "1D as p_retailprice",
    ).write.parquet(f"{tmp_path}/part.parquet")
    loaded = views.load(spark, str(tmp_path))
    for name in ("user_category_affinity", "user_creator_affinity"):
        assert loaded[name].count() == 40 / 2
        assert "Broadcast" not in plan_of(loaded[name])

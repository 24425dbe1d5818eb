"""Kept masks: merged in buckets and joined without an exchange."""
import pytest
from conftest import at

from feedloom.__main__ import main
from feedloom.operators.attribution import label_masks
from feedloom.operators.items import resolve_items
from feedloom.plans.dataset import build_dataset
from feedloom.sources import tables as sources
from feedloom.sources.masks import bucket_count, compact_masks, kept_masks


@pytest.fixture
def kept_table(spark):
    yield "kept_masks_of_tests"
    for name in ("kept_masks_of_tests", "kept_masks_of_tests_next"):
        spark.sql(f"drop table if exists {name}")


def folder_of(tables, root):
    """Impressions of three days; events that name them come up to two days later."""
    data = tables(
        scroll_impressions=[{"id": i, "user_id": i % 5, "scroll_id": i % 4, "created_at": at(i * 1800)} for i in range(144)],
        scroll_interactions=[{"impression_id": i, "event_type": 1 + i % 15, "created_at": at(i * 1800 + 172_800)}
                             for i in range(0, 144, 2)]
        + [{"user_id": i % 5, "scroll_id": i % 4, "event_type": 6, "created_at": at(i * 1900)} for i in range(60)])
    for name, df in data.items():
        df.write.parquet(f"{root}/{name}")
    return str(root)


def nodes(plan):
    """All nodes of a physical plan, what adaptive execution wraps included."""
    yield plan
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from nodes(plan.inputPlan())
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def test_masks_merge_into_the_table(spark, kept_table):
    def masks(*rows):
        return spark.createDataFrame(rows, "impression_id string, mask int")

    compact_masks(masks(("1", 2), ("1", 4), ("2", 8), (None, 1)), kept_table, buckets=4)
    assert bucket_count(spark, kept_table) == 4
    for _ in range(2):
        compact_masks(masks(("2", 2), ("3", 16), ("3", 16)), kept_table)
    assert sorted(map(tuple, spark.table(kept_table).collect())) == [(1, 6), (2, 10), (3, 16)]
    assert bucket_count(spark, kept_table) == 4
    assert not spark.catalog.tableExists(f"{kept_table}_next")


def test_a_day_with_kept_masks_equals_one_from_the_log(spark, tables, tmp_path, kept_table):
    folder = folder_of(tables, tmp_path / "tables")
    stream = str(tmp_path / "stream")
    main(["attribute-stream", "--tables", folder, "--out", stream, "--checkpoint", str(tmp_path / "c"), "--once"])
    main(["compact-masks", "--data", stream, "--masks-table", kept_table, "--buckets", "8"])
    range_ = ["--start", "2024-03-02", "--end", "2024-03-03"]
    main(["build", "--tables", folder, "--out", str(tmp_path / "a"), *range_])
    main(["build", "--tables", folder, "--out", str(tmp_path / "b"), *range_, "--masks-table", kept_table])
    log, kept = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    assert log.count() == 48 and log.exceptAll(kept).count() == 0 == kept.exceptAll(log).count()


def test_no_exchange_of_the_kept_masks(spark, tables, tmp_path, kept_table):
    data = sources.from_parquet(spark, folder_of(tables, tmp_path / "tables"))
    base = resolve_items(data["scroll_impressions"])
    compact_masks(label_masks(base, data["scroll_interactions"]), kept_table, buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = build_dataset(data, start=at(3600), end=at(90_000), hot_support=None, kept=kept_masks(spark, kept_table))
        plan = frame._jdf.queryExecution().executedPlan()
        joins = [n for n in nodes(plan) if "Join" in n.nodeName()]
        sides = [n.children().apply(1) for n in joins if n.children().size() == 2]
        mine = [s for s in sides if any(kept_table in x.simpleString(200) for x in nodes(s)) or any(
            "Bucketed: true" in x.simpleString(10_000) for x in nodes(s))]
        assert len(mine) == 1 and not any("Exchange" in n.nodeName() for n in nodes(mine[0]))
        # The next version is written from the buckets as they lie, too.
        assert frame.count() == 48
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

import sys
import tempfile
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

T0 = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)

SCHEMAS = {
    "scroll_impressions": (
        "id bigint, user_id bigint, scroll_id int, product_id int, item_type int, "
        "session_id string, position_index int, feed_type string, created_at timestamp, "
        "ml_shadow_score double, ml_commerce_score double, heuristic_score double, "
        "recommendation_run_id string, ranking_version string, candidate_source string, "
        "recommendation_profile_kind string, retrieval_score double, semantic_score double"
    ),
    "scroll_interactions": (
        "id bigint, impression_id bigint, user_id bigint, session_id string, scroll_id int, "
        "product_id int, event_type int, created_at timestamp"
    ),
    "scrolls": (
        "id int, user_id int, category string, content_category string, quality_score double, "
        "products array<int>, views int, likes int, save_count int, created_at timestamp"
    ),
    "products": (
        "id int, user_id int, category string, content_category string, average_rating double, "
        "total_sales_count int, review_count int, likes int, save_count int, created_at timestamp"
    ),
    "scroll_stats": (
        "scroll_id int, impressions int, completions int, qualified_views int, purchases int"
    ),
    "item_global_stats": (
        "item_id int, item_type int, impressions int, clicks int, product_views int, carts int, "
        "purchases int"
    ),
    "user_category_affinity": "user_id bigint, category_id string, score double",
    "user_creator_affinity": "user_id bigint, creator_id int, score double",
    "position_bias_baseline": "position_index int, expected_ctr double",
}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-test-"))
    yield session


def at(seconds: float = 0, **parts) -> datetime:
    return T0 + timedelta(seconds=seconds, **parts)


@pytest.fixture(scope="session")
def table(spark):
    """Rows given as dicts; columns left out are null."""
    def make(name: str, *rows: dict):
        schema = SCHEMAS[name]
        columns = [part.split()[0] for part in schema.split(", ")]
        unknown = {key for row in rows for key in row} - set(columns)
        assert not unknown, unknown
        data = [tuple(row.get(c) for c in columns) for row in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def tables(table):
    """All nine tables, empty unless rows are given by table name."""
    def make(**rows):
        return {name: table(name, *rows.get(name, [])) for name in SCHEMAS}

    return make

"""Feed logs and item tables derived from the driver's ``events`` and ``part`` tables.

One text for Spark and DuckDB, so that both engines see the same rows. Every view reads its whole
base table. Event times are compressed 60 times, otherwise the 5-minute to 1-hour windows would
be almost empty. Items belong to users (ten slots each), so that a user meets an item repeatedly;
items of the slots 8 and 9 get ids that the item tables do not know.
"""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "e": """
        select event_id, user_id, event_type, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
          cast(floor(cast({US} as double) / 60) as bigint) as us from events""",
    "f": """
        select event_id, user_id, event_type, k, us,
          cast((user_id * 10 + (k - k % 2) % 10) * case when k % 10 >= 8 then -1 else 1 end as int) as even_item,
          cast((user_id * 10 + k % 10) * case when k % 10 >= 8 then -1 else 1 end as int) as item,
          case when event_id % 4 <> 0 then concat('s', cast(user_id as varchar(20)), '-',
            cast(cast(floor(cast(us as double) / 7200000000) as bigint) as varchar(20))) end as session_id
        from e""",
    "scroll_impressions": """
        select event_id as id,
          case when event_id % 50 = 7 then null else user_id end as user_id,
          case when event_id % 97 = 5 then null when k % 2 = 0 or event_id % 13 = 0 then even_item end as scroll_id,
          case when event_id % 97 = 5 then null when k % 2 = 1 then item end as product_id,
          case when event_id % 31 = 3 then 3 when event_id % 5 = 0 then null when k % 2 = 1 then 2 else 1 end as item_type,
          session_id, cast(event_id % 15 as int) as position_index,
          case k % 3 when 0 then 'home' when 1 then 'explore' else 'shop' end as feed_type,
          us as created_us, {TS}(1704067200000000 + us) as created_at,
          case when event_id % 10 = 0 then null else cast(event_id * 37 % 1000 as double) / 1000 end as ml_shadow_score,
          case when event_id % 10 = 0 then null else cast(event_id * 71 % 1000 as double) / 1000 end as ml_commerce_score,
          cast(event_id * 53 % 1000 as double) / 1000 as heuristic_score,
          concat('run-', cast(event_id % 7 as varchar(20))) as recommendation_run_id,
          case when event_id % 2 = 0 then 'v1' else 'v2' end as ranking_version,
          case event_id % 3 when 0 then 'retrieval' when 1 then 'trending' else 'follow' end as candidate_source,
          case event_id % 6 when 0 then 'behavior_14d' when 1 then 'behavior_7d' when 2 then 'session'
            when 3 then 'declared_interest' when 4 then 'manual' end as recommendation_profile_kind,
          case when event_id % 3 = 0 then cast(k as double) / 100 end as retrieval_score,
          case when event_id % 4 = 1 then cast(k as double) / 100 end as semantic_score
        from f where event_type in ('view', 'signup')""",
    "scroll_interactions": """
        select event_id as id, case when event_id % 3 = 0 then event_id - 1 end as impression_id, user_id,
          case when k % 2 = 0 then item end as scroll_id, case when k % 2 = 1 then item end as product_id, session_id,
          cast(case event_type when 'click' then 6 when 'purchase' then 8 else 1 + k % 15 end as int) as event_type,
          us as created_us, {TS}(1704067200000000 + us) as created_at
        from f where event_type in ('click', 'purchase', 'error')""",
    "items": """
        select cast(p_partkey as int) as id, p_size as user_id, p_brand as category, p_type, p_size, p_retailprice,
          p_partkey % 10 as slot, case when p_partkey % 4 < 2 then p_type end as content_category,
          case when p_partkey % 10 = 3 then null when p_partkey % 10 = 4 then (p_partkey % 100) * 7200000000
            else -(p_partkey + 1) * 21600000000 end as created_us from part""",
    "scrolls": """
        select id, user_id, category, content_category, cast(p_size as double) / 50 as quality_score,
          case when slot = 2 then {ARR} end as products, p_size * 3 as views, p_size as likes, p_size - 20 as save_count,
          created_us, {TS}(1704067200000000 + created_us) as created_at from items""",
    "products": """
        select id, user_id, category, content_category, p_retailprice / 200 as average_rating, p_size as total_sales_count,
          p_size * 2 as review_count, p_size as likes, p_size - 30 as save_count,
          created_us, {TS}(1704067200000000 + created_us) as created_at from items""",
    "scroll_stats": """
        select id as scroll_id, case when slot = 6 then 0 else 100 + p_size end as impressions, p_size as completions,
          p_size + 5 as qualified_views, p_size % 7 as purchases from items""",
    "item_global_stats": """
        select item_id, item_type, case when slot = 5 then 0 else 80 + p_size end as impressions, p_size as clicks,
          p_size % 11 as product_views, p_size % 5 as carts, p_size % 3 as purchases
        from (select id as item_id, 1 as item_type, slot, p_size from items
              union all select id as item_id, 2 as item_type, slot, p_size + 1 as p_size from items) z""",
    "user_category_affinity": """
        select{MERGE} f.user_id, coalesce(items.content_category, items.category) as category_id,
          cast(count(*) as double) / 10 as score
        from f join items on items.id = f.item where f.event_type = 'click' group by 1, 2""",
    "user_creator_affinity": """
        select{MERGE} f.user_id, items.user_id as creator_id, cast(count(*) as double) / 20 as score
        from f join items on items.id = f.item where f.event_type = 'purchase' group by 1, 2""",
    "position_bias_baseline": """
        select distinct cast(event_id % 12 as int) as position_index,
          cast(0.2 as double) / (1 + event_id % 12) as expected_ctr from events""",
}

SPARK = {
    "US": "unix_micros(cast(ts as timestamp)) - 1704067200000000",
    "ARR": "array(1, 2)",
    "TS": "timestamp_micros",
    # A large `part` makes a small file: by its size Spark would broadcast a million items.
    "MERGE": " /*+ merge(items) */",
}
DUCKDB = {"US": "epoch_us(ts) - 1704067200000000", "ARR": "[1, 2]", "TS": "make_timestamp", "MERGE": ""}
TABLES = [name for name in VIEWS if name not in ("e", "f", "items")]


def with_views(dialect: dict[str, str]) -> str:
    """All views as one WITH clause."""
    return "with " + ",\n".join(f"{n} as ({t.format(**dialect)})" for n, t in VIEWS.items())


@lru_cache(maxsize=4)
def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine input tables as DataFrames over the Parquet files of ``sf_dir``. Only the analysed
    plans are kept between calls; every query reads the files."""
    for name in ("events", "part"):
        spark.read.parquet(str(Path(sf_dir) / f"{name}.parquet")).createOrReplaceTempView(name)
    views = {}
    for name, text in VIEWS.items():
        views[name] = spark.sql(text.format(**SPARK))
        views[name].createOrReplaceTempView(name)
    return {name: views[name] for name in TABLES}

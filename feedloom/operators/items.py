"""Item side of an impression: resolved type, category, quality, popularity and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.contracts import ITEM_TYPES
from feedloom.functions.columns import DAY, HOUR, micros, or_zero, ratio
from feedloom.operators.skew import Hot, spread_left_join, unless_small

SCROLL, PRODUCT = ITEM_TYPES["SCROLL"], ITEM_TYPES["PRODUCT"]

# How strong a semantic profile of each kind is.
PROFILE_STRENGTH = {
    "behavior_14d": 1.0,
    "behavior_7d": 0.9,
    "session": 0.75,
    "declared_interest": 0.55,
    "manual": 0.4,
}

# Key into the product tables: the statistics of a product fall back to the scroll id.
PRODUCT_KEY = f"if(item_type = {PRODUCT}, coalesce(product_id, scroll_id), product_id)"


def resolve_items(impressions: DataFrame) -> DataFrame:
    """Impressions that name an item, with item_type filled in and the time also in microseconds."""
    by_id = f"if(product_id is not null, {PRODUCT}, {SCROLL})"
    return impressions.where("scroll_id is not null or product_id is not null").selectExpr(
        "* except (id, created_at, item_type)",
        "id as impression_id",
        "created_at as impressed_at",
        f"{micros('created_at')} as impressed_us",
        f"coalesce(item_type, {by_id}) as item_type",
    )


def social_proof(counts: list[str], saturation: float = 5.0) -> str:
    """Logarithm of the summed positive counts, 1 from e^saturation on."""
    total = " + ".join(f"greatest(coalesce(cast({c} as bigint), 0L), 0L)" for c in counts)
    return f"least(1D, ln(1L + {total}) / {saturation}D)"


def scroll_facts(scrolls: DataFrame) -> DataFrame:
    """Per scroll what its impressions need; the arithmetic runs once per scroll."""
    return scrolls.selectExpr(
        "id as scroll_id",
        "user_id as s_creator",
        "category as s_category",
        "content_category as s_content_category",
        "cast(quality_score as double) as s_quality",
        "if(size(products) > 0, 1, 0) as s_has_products",
        f"{social_proof(['views', 'likes', 'save_count'])} as s_proof",
        f"{micros('created_at')} as s_created_us",
    )


def scroll_rates(scroll_stats: DataFrame) -> DataFrame:
    return scroll_stats.selectExpr(
        "scroll_id",
        f"if(impressions > 0, {ratio('completions', 'impressions')}, 0D) as s_completion",
        f"{ratio('qualified_views', 'impressions')} as s_ctr",
        f"{ratio('purchases', 'impressions')} as s_conversion",
    )


def product_facts(products: DataFrame) -> DataFrame:
    counts = ["total_sales_count", "review_count", "likes", "save_count"]
    return products.selectExpr(
        "id as product_key",
        "user_id as p_creator",
        "category as p_category",
        "content_category as p_content_category",
        "cast(average_rating as double) as p_quality",
        f"{social_proof(counts)} as p_proof",
        f"{micros('created_at')} as p_created_us",
    )


def product_rates(item_stats: DataFrame) -> DataFrame:
    """Rates of products; the statistics of other item types reach no feature."""
    shown, clicks, views, carts, bought = map(
        or_zero, ["impressions", "clicks", "product_views", "carts", "purchases"])
    # A cart weighs 3, a purchase 6.
    interest = f"({clicks} + {views} + {carts} * 3D + {bought} * 6D)"
    return item_stats.where(f"item_type = {PRODUCT}").selectExpr(
        "item_id as product_key",
        f"least(1D, {interest} / greatest({shown}, 1D)) as g_completion",
        f"{ratio(f'({clicks} + {views})', shown)} as g_ctr",
        f"{ratio(bought, shown)} as g_conversion",
    )


def join_items(
    base: DataFrame,
    scrolls: DataFrame,
    products: DataFrame,
    scroll_stats: DataFrame,
    item_stats: DataFrame,
    hot: Hot | None = None,
) -> DataFrame:
    """Attach the item tables. Two shuffles of the log at most: one by scroll, one by product."""
    with_scroll = spread_left_join(
        base.selectExpr("*", f"{PRODUCT_KEY} as product_key"),
        [scroll_facts(unless_small(scrolls)), scroll_rates(unless_small(scroll_stats))],
        ["scroll_id"], "impression_id", hot,
    )
    return spread_left_join(
        with_scroll,
        [product_facts(unless_small(products)), product_rates(unless_small(item_stats))],
        ["product_key"], "impression_id", hot,
    )


def hour_of_day(us: str) -> str:
    """UTC hour, whatever the session's time zone."""
    return f"cast(floor(pmod({us}, {DAY}L) / {HOUR}D) as int)"


def freshness(age_us: str) -> str:
    """1 when new, 1/2 after three days (products) or one day (others). Not clamped: an item dated
    after its impression gives more than 1 or less than 0, and 0 where the age cancels the scale."""
    scale = f"if(item_type = {PRODUCT}, 72D, 24D)"
    return or_zero(f"try_divide(1D, 1D + ({age_us}) / {HOUR}D / {scale})")


def item_features(joined: DataFrame) -> DataFrame:
    """Features and categories from ``join_items``, and the semantic ones; helpers are dropped."""
    def by_type(for_product: str, for_scroll: str) -> str:
        return f"if(item_type = {PRODUCT}, {for_product}, {for_scroll})"

    def own(column: str) -> str:
        # A product impression that names only a scroll has statistics, but no product.
        return f"if(product_id is not null, {column}, null)"

    created = by_type(own("p_created_us"), "s_created_us")
    created = f"coalesce({created}, impressed_us)"
    quality = by_type(own("p_quality"), "s_quality")
    proof = by_type(own("p_proof"), "s_proof")
    p_content, p_category = own("p_content_category"), own("p_category")
    strength = " ".join(f"when '{kind}' then {v}D" for kind, v in PROFILE_STRENGTH.items())
    retrieval, semantic = or_zero("retrieval_score"), or_zero("semantic_score")
    features = {
        "category": f"coalesce(s_category, {p_category})",
        "content_category": f"coalesce(s_content_category, {p_content}, s_category, {p_category})",
        "creator_id": f"coalesce(s_creator, {own('p_creator')})",
        "is_product": by_type("1", "0"),
        "video_quality": or_zero(quality),
        "has_products": by_type("1", "coalesce(s_has_products, 0)"),
        "hour_of_day": hour_of_day("impressed_us"),
        "completion_rate": or_zero(by_type("g_completion", "s_completion")),
        "global_ctr": or_zero(by_type("g_ctr", "s_ctr")),
        "global_conversion_rate": or_zero(by_type("g_conversion", "s_conversion")),
        "social_proof_score": or_zero(proof),
        "content_created_us": created,
        "content_freshness": freshness(f"impressed_us - {created}"),
        "retrieval_score": retrieval,
        "semantic_score": semantic,
        "has_semantic_candidate": f"if({semantic} > 0 or {retrieval} > 0, 1, 0)",
        "semantic_profile_strength": f"case recommendation_profile_kind {strength} else 0D end",
    }
    kept = [
        c for c in joined.columns
        if c[:2] not in ("s_", "p_", "g_") and c not in features and c != "product_key"
    ]
    return joined.selectExpr(*kept, *[f"{text} as {name}" for name, text in features.items()])

"""The column contract shared by dataset building, training, scoring and evaluation."""

from __future__ import annotations

# Item and event codes found in the logs.
ITEM_TYPES = {"SCROLL": 1, "PRODUCT": 2, "STYLE": 3, "CIRCLE_POST": 4}
EVENT_TYPES = {
    "QUALIFIED_VIEW": 1,
    "COMPLETE": 2,
    "SKIP": 3,
    "REWATCH": 4,
    "PRODUCT_VIEW": 5,
    "PRODUCT_CLICK": 6,
    "ADD_TO_CART": 7,
    "PURCHASE": 8,
    "SAVE": 9,
    "GRID_IMPRESSION": 10,
    "GRID_DWELL": 11,
    "PRODUCT_HOVER": 12,
    "SCROLL_PAUSE": 13,
    "CHECKOUT_START": 14,
    "SHARE": 15,
}

# Column -> Spark type. Metadata has no default.
METADATA = {
    "impression_id": "string",
    "user_id": "string",
    "scroll_id": "string",
    "product_id": "string",
    "item_type": "int",
    "feed_type": "string",
    "category": "string",
    "content_category": "string",
    "impressed_at": "timestamp",
    "candidate_source": "string",
    "recommendation_profile_kind": "string",
    "recommendation_run_id": "string",
    "ranking_version": "string",
}

# Feature -> (Spark type, default).
CORE_FEATURES = {
    "position_index": ("int", 0),
    "user_category_score": ("double", 0.0),
    "video_quality": ("double", 0.0),
    "has_products": ("int", 0),
    "hour_of_day": ("int", 0),
    "completion_rate": ("double", 0.0),
    "expected_ctr_at_position": ("double", 0.05),
    "session_velocity": ("double", 1.0),
    "session_dwell_time": ("double", 0.0),
}
EXTENDED_FEATURES = {
    "is_product": ("int", 0),
    "creator_affinity_score": ("double", 0.0),
    "content_freshness": ("double", 0.0),
    "global_ctr": ("double", 0.0),
    "global_conversion_rate": ("double", 0.0),
    "social_proof_score": ("double", 0.0),
    "semantic_score": ("double", 0.0),
    "retrieval_score": ("double", 0.0),
    "has_semantic_candidate": ("int", 0),
    "semantic_profile_strength": ("double", 0.0),
    "text_semantic_score": ("double", 0.0),
    "visual_semantic_score": ("double", 0.0),
    "semantic_agreement_score": ("double", 0.0),
    "has_visual_embedding": ("int", 0),
    "category_visual_prior": ("double", 0.0),
}
FEATURES = {**CORE_FEATURES, **EXTENDED_FEATURES}
SCORES = {
    "ml_shadow_score": ("double", 0.0),
    "ml_commerce_score": ("double", 0.0),
    "heuristic_score": ("double", 0.0),
}

# Label -> the event that sets it; the click label is derived from others.
EVENT_LABELS = {
    "is_qualified_view": "QUALIFIED_VIEW",
    "is_complete": "COMPLETE",
    "is_skip": "SKIP",
    "is_rewatch": "REWATCH",
    "is_product_view": "PRODUCT_VIEW",
    "is_share": "SHARE",
    "is_product_click": "PRODUCT_CLICK",
    "is_add_to_cart": "ADD_TO_CART",
    "is_checkout_start": "CHECKOUT_START",
    "is_purchase": "PURCHASE",
    "is_save": "SAVE",
    "is_pause": "SCROLL_PAUSE",
}
# The labels that make a click, and those of commerce in order of strength.
CLICK_LABELS = [
    "is_qualified_view",
    "is_complete",
    "is_product_view",
    "is_product_click",
    "is_add_to_cart",
    "is_checkout_start",
    "is_purchase",
    "is_save",
]
COMMERCE_LABELS = [
    "is_purchase",
    "is_checkout_start",
    "is_add_to_cart",
    "is_product_click",
    "is_product_view",
]
LABELS = {name: ("int", 0) for name in ["is_click", *EVENT_LABELS]}

FEATURE_COLUMNS = list(FEATURES)
SCORE_COLUMNS = list(SCORES)
LABEL_COLUMNS = list(LABELS)
DATASET_COLUMNS = [*METADATA, *FEATURES, *SCORES, *LABELS]

# What a scoring request has to hold, and the one default that differs from training.
SCORING_REQUIRED = [
    "position_index", "user_category_score", "video_quality", "has_products", "hour_of_day",
    "completion_rate",
]
SCORING_DEFAULTS = {name: default for name, (_, default) in FEATURES.items()} | {
    "expected_ctr_at_position": 0.0}

# Relational inputs of the dataset build, with the columns it reads.
SOURCE_COLUMNS = {
    "scroll_impressions": [
        "id", "user_id", "scroll_id", "product_id", "item_type", "session_id", "position_index",
        "feed_type", "created_at", "ml_shadow_score", "ml_commerce_score", "heuristic_score",
        "recommendation_run_id", "ranking_version", "candidate_source",
        "recommendation_profile_kind", "retrieval_score", "semantic_score",
    ],
    "scroll_interactions": [
        "impression_id", "user_id", "scroll_id", "product_id", "session_id", "event_type",
        "created_at",
    ],
    "scrolls": [
        "id", "user_id", "category", "content_category", "quality_score", "products", "views",
        "likes", "save_count", "created_at",
    ],
    "products": [
        "id", "user_id", "category", "content_category", "average_rating", "total_sales_count",
        "review_count", "likes", "save_count", "created_at",
    ],
    "scroll_stats": ["scroll_id", "impressions", "completions", "qualified_views", "purchases"],
    "item_global_stats": [
        "item_id", "item_type", "impressions", "clicks", "product_views", "carts", "purchases",
    ],
    "user_category_affinity": ["user_id", "category_id", "score"],
    "user_creator_affinity": ["user_id", "creator_id", "score"],
    "position_bias_baseline": ["position_index", "expected_ctr"],
}
# What a column may be, by kind; and the kinds of the inputs' columns. Ids may be numbers or text, but
# those that meet in a join have to be of one kind, which Spark's own analysis sees to.
KINDS = {
    "id": ["tinyint", "smallint", "int", "bigint", "string"],
    "whole": ["tinyint", "smallint", "int", "bigint"],
    "number": ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal"],
    "text": ["string"],
    "time": ["timestamp", "timestamp_ntz"],
    "list": ["array"],
}
COLUMN_KINDS = {
    "id": ["id", "user_id", "scroll_id", "product_id", "impression_id", "item_id", "creator_id", "category_id"],
    "whole": ["item_type", "position_index", "event_type"],
    "text": [
        "session_id", "feed_type", "recommendation_run_id", "ranking_version", "candidate_source",
        "recommendation_profile_kind", "category", "content_category",
    ],
    "time": ["created_at"],
    "list": ["products"],
}
# What has to be there in every row; null times and users are part of the logs.
FILLED = {"scroll_impressions": ["id"], "scroll_interactions": ["event_type"], "scrolls": ["id"], "products": ["id"]}
# What the dataset joins take to be unique.
TABLE_KEYS = {
    "scroll_impressions": ["id"],
    "scrolls": ["id"],
    "products": ["id"],
    "scroll_stats": ["scroll_id"],
    "item_global_stats": ["item_id", "item_type"],
    "user_category_affinity": ["user_id", "category_id"],
    "user_creator_affinity": ["user_id", "creator_id"],
    "position_bias_baseline": ["position_index"],
}
REQUIRED_TABLES = ["scrolls", "scroll_interactions", "scroll_impressions"]

"""Shipped quality rules (Q4) and the join rules of the insight jobs (Q8)."""

from __future__ import annotations

from typing import Any

# Rules by table, on the columns that the pipelines make.
RULES: dict[str, Any] = {
    "trending_videos": {
        "rules": [
            {"column": "video_id", "type": "string", "null_allowed": False, "unique": True},
            {"column": "views", "type": "numeric", "min_value": 0, "null_allowed": False},
            {"column": "likes", "type": "numeric", "min_value": 0},
            {"column": "comments", "type": "numeric", "min_value": 0},
            {"column": "published_at", "type": "timestamp", "null_allowed": False},
        ]
    },
    "channels": {
        "rules": [
            {"column": "channel_id", "type": "string", "null_allowed": False, "unique": True},
            {"column": "subscribers", "type": "numeric", "min_value": 0},
            {"column": "video_count", "type": "numeric", "min_value": 0},
        ]
    },
    "categories": {
        "rules": [
            {"column": "category_id", "type": "numeric", "null_allowed": False, "unique": True},
            {"column": "category_name", "type": "string", "null_allowed": False},
        ]
    },
    "video_performance_metrics": {"rules": [{"column": "video_id", "type": "string", "null_allowed": False}]},
    "channel_growth_metrics": {"rules": [{"column": "channel_id", "type": "string", "null_allowed": False}]},
    "join_validations": [
        {"source_table": "trending_videos", "target_table": "channels", "keys": ["channel_id"], "max_orphaned_ratio": 0.1},
        {"source_table": "trending_videos", "target_table": "categories", "keys": ["category_id"], "max_orphaned_ratio": 0.05},
    ],
}

# The keys each job joins its tables by, as (source, target, key).
JOIN_KEYS: dict[str, list[tuple[str, str, str]]] = {
    "author_activity_metrics": [
        ("comment_threads", "authors", "author_id"),
        ("comment_threads", "replies", "comment_thread_id"),
    ],
    "category_popularity_metrics": [("trending_videos", "categories", "category_id")],
    "channel_engagement_metrics": [
        ("channels", "trending_videos", "channel_id"),
        ("channels", "countries", "country_id"),
    ],
    "channel_growth_metrics": [("channels", "trending_videos", "channel_id")],
    "comment_insights": [("comment_threads", "trending_videos", "video_id")],
    "related_videos_network": [
        ("related_videos", "trending_videos", "video_id"),
        ("related_videos", "categories", "category_id"),
    ],
    "tag_performance_metrics": [("tags", "trending_videos", "video_id")],
    "video_performance_metrics": [("trending_videos", "categories", "category_id")],
}


def join_rules(job: str, max_orphaned_ratio: float = 0.1) -> list[dict[str, Any]]:
    """The join rules of an insight job, in the form of a rule book's."""
    return [
        {"source_table": s, "target_table": t, "keys": [k], "max_orphaned_ratio": max_orphaned_ratio}
        for s, t, k in JOIN_KEYS[job]
    ]

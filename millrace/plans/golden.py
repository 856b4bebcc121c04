"""The raw-to-golden pipelines (R1-R6) as specs for the runner.

Each differs from a plain list of steps in three points that matter at scale:
no global sort before a partitioned write (``sort_by`` orders the rows within each file),
tags are split from the un-exploded frame (a video without tags is kept), and every
surrogate key is an expression, so no entity has to be joined back.
"""

from __future__ import annotations

from typing import Any


# The raw zone's columns.  Numbers arrive as text, because an absent one is the text "N/A".
RAW_SCHEMAS: dict[str, str] = {
    "trending_videos": (
        "video_id string, title string, view_count string, like_count string, "
        "comment_count string, published_at string, duration double, dimension string, "
        "definition string, licensed_content boolean, channel_id string, channel_title string, "
        "tags string, category_id string, audio_language string, live_broadcast_content string"
    ),
    "channels_information": (
        "channel_id string, title string, description string, published_at string, "
        "view_count string, subscriber_count string, video_count string, country string"
    ),
    "related_category_videos": (
        "video_id string, title string, description string, published_at string, "
        "channel_id string, channel_title string, thumbnails string, "
        "liveBroadcastContent string, category_id string"
    ),
    "categories": "category_id string, category_title string",
    "comment_threads": (
        "comment_thread_id string, video_id string, author_name string, text string, "
        "like_count string, published_at string, total_reply_count string"
    ),
    "replies": (
        "comment_id string, author_name string, author_channel_id string, text_display string, "
        "like_count string, published_at string, updated_at string, comment_thread_id string"
    ),
}


def _step(name: str, target: str | None = None, into: list[str] | None = None, **params: Any):
    step: dict[str, Any] = {"name": name, "params": params}
    if target:
        step["target"] = target
    if into:
        step["output_names"] = into
        step["multi_output"] = len(into) > 1
    return step


#: Buckets of the golden entity tables, by key; a spec may have others under ``buckets``.
ENTITY_BUCKETS = 32


def _overwritten(frame: str, path: str, keys: list[str], event: str, **more: Any):
    return {
        "dataframe": frame,
        "path": path,
        "store_type": "SCD1",
        "primary_key": keys,
        "partition_by": [],
        "finish_event": event,
        **more,
    }


def _with_history(
    frame: str, path: str, keys: list[str], event: str, partition_by: list[str], **more: Any
):
    return {
        "dataframe": frame,
        "path": f"{path}/current",
        "history_path": f"{path}/history",
        "store_type": "SCD4",
        "primary_key": keys,
        "partition_by": partition_by,
        "finish_event": event,
        **more,
    }


def _spec(dataset: str, steps: list, outputs: list) -> dict[str, Any]:
    return {
        "dataset": dataset,
        "database": "raw",
        "input": {
            "format": "csv",
            "schema": RAW_SCHEMAS[dataset],
            # no multiLine: raw text holds no line breaks, and files stay splittable
            "options": {"header": "true", "escape": '"'},
        },
        "transformations": steps,
        "output": outputs,
    }


def categories(root: str) -> dict[str, Any]:
    """R1."""
    frame = "categories_df"
    return _spec(
        "categories",
        [
            _step("select_columns", into=[frame], columns=["category_id", "category_title"]),
            _step("rename_columns", frame, mapping={"category_title": "category_name"}),
            _step("cast_columns", frame, type_mapping={"category_id": "int"}),
            _step("drop_duplicates", frame, subset=["category_id"]),
        ],
        [
            _overwritten(
                frame,
                f"{root}/categories",
                ["category_id"],
                "categories_done",
                sort_by=["category_id"],
            )
        ],
    )


def channels_information(root: str, as_of: str | None = None) -> dict[str, Any]:
    """R2.  ``as_of`` (a date) stands for today in the channel's age."""
    today = f"DATE'{as_of}'" if as_of else "current_date()"
    return _spec(
        "channels_information",
        [
            _step(
                "select_columns",
                columns=[
                    "channel_id",
                    "title",
                    "country",
                    "published_at",
                    "subscriber_count",
                    "video_count",
                    "view_count",
                ],
            ),
            _step(
                "rename_columns",
                mapping={
                    "title": "channel_name",
                    "subscriber_count": "subscribers",
                    "view_count": "total_views",
                },
            ),
            _step(
                "cast_columns",
                type_mapping={
                    **dict.fromkeys(["subscribers", "video_count", "total_views"], "long"),
                    "published_at": "timestamp",
                },
            ),
            _step("filter_rows", condition="channel_id IS NOT NULL AND subscribers IS NOT NULL"),
            _step(
                "extract_unique_entities",
                into=["channels_df", "countries_df"],
                entity_columns=["country"],
                id_column="country_id",
            ),
            _step(
                "add_columns",
                "channels_df",
                columns={
                    "channel_age_years": f"year({today}) - year(published_at)",
                    "avg_views_per_video": "try_divide(total_views, video_count)",
                },
            ),
        ],
        [
            _with_history(
                "channels_df",
                f"{root}/channels",
                ["channel_id"],
                "channels_done",
                ["country_id"],
                sort_by=["subscribers desc"],
                tracking_columns=[
                    "channel_name",
                    "subscribers",
                    "total_views",
                    "video_count",
                    "channel_age_years",
                    "avg_views_per_video",
                ],
            ),
            _overwritten("countries_df", f"{root}/countries", ["country_id"], "countries_done", buckets=ENTITY_BUCKETS),
        ],
    )


def _comments(
    dataset: str,
    root: str,
    required: str,
    casts: dict[str, str],
    names: dict[str, str],
    key: str,
    tracking: list[str],
) -> dict[str, Any]:
    frame = f"{dataset}_df"
    return _spec(
        dataset,
        [
            _step("filter_rows", condition=required),
            _step("cast_columns", type_mapping=casts),
            _step("rename_columns", mapping=names),
            _step(
                "extract_unique_entities",
                into=[frame, "authors_df"],
                entity_columns=["author_name"],
                id_column="author_id",
            ),
            _step(
                "add_columns",
                frame,
                columns={"year": "year(published_at)", "month": "month(published_at)"},
            ),
        ],
        [
            _with_history(
                frame,
                f"{root}/{dataset}",
                [key],
                f"{dataset}_done",
                ["year", "month"],
                sort_by=["published_at"],
                tracking_columns=tracking,
            ),
            _overwritten("authors_df", f"{root}/authors", ["author_id"], "authors_done", buckets=ENTITY_BUCKETS),
        ],
    )


def comment_threads(root: str) -> dict[str, Any]:
    """R3."""
    return _comments(
        "comment_threads",
        root,
        "comment_thread_id IS NOT NULL AND video_id IS NOT NULL",
        {"like_count": "int", "total_reply_count": "int", "published_at": "timestamp"},
        {"text": "comment_text", "like_count": "comment_likes"},
        "comment_thread_id",
        ["comment_text", "comment_likes", "total_reply_count"],
    )


def replies(root: str) -> dict[str, Any]:
    """R5."""
    return _comments(
        "replies",
        root,
        "comment_id IS NOT NULL AND comment_thread_id IS NOT NULL",
        {"like_count": "int", "published_at": "timestamp", "updated_at": "timestamp"},
        {"text_display": "reply_text", "like_count": "reply_likes"},
        "comment_id",
        ["reply_text", "reply_likes"],
    )


def _channel_names(target: str | None, frame: str) -> dict[str, Any]:
    return _step(
        "extract_unique_entities",
        target,
        [frame, "channels_basic_information_df"],
        entity_columns=["channel_id", "channel_title"],
        id_column="channel_id",
        drop_original_columns=False,
        drop_after_join=["channel_title"],
    )


def _channel_names_output(root: str) -> dict[str, Any]:
    return _overwritten(
        "channels_basic_information_df",
        f"{root}/channels_basic_information",
        ["channel_id"],
        "channels_basic_information_done",
        order_by=["channel_title"],
        buckets=ENTITY_BUCKETS,
    )


def related_category_videos(root: str) -> dict[str, Any]:
    """R4."""
    frame = "related_category_videos_df"
    return _spec(
        "related_category_videos",
        [
            _step("rename_columns", mapping={"liveBroadcastContent": "is_live_content"}),
            _step(
                "cast_columns",
                type_mapping={"category_id": "int", "published_at": "timestamp"},
            ),
            _step("filter_rows", condition="video_id IS NOT NULL AND channel_id IS NOT NULL"),
            _channel_names(None, frame),
            _step("add_columns", frame, columns={"year": "year(published_at)"}),
        ],
        [
            _with_history(
                frame,
                f"{root}/related_category_videos",
                ["video_id"],
                "related_category_videos_done",
                ["year"],
                tracking_columns=["title", "description", "is_live_content"],
            ),
            _channel_names_output(root),
        ],
    )


def trending_videos(root: str) -> dict[str, Any]:
    """R6."""
    frame = "trending_videos_df"
    return _spec(
        "trending_videos",
        [
            _step(
                "extract_df",
                into=[frame, "tags_df"],
                split_column="tags",
                id_columns=["video_id"],
                dedup_columns=["video_id"],
            ),
            _channel_names(frame, frame),
            _step(
                "cast_columns",
                frame,
                type_mapping={
                    **dict.fromkeys(["view_count", "like_count", "comment_count"], "long"),
                    "category_id": "int",
                    "published_at": "timestamp",
                },
            ),
            _step(
                "rename_columns",
                frame,
                mapping={"view_count": "views", "like_count": "likes", "comment_count": "comments"},
            ),
            _step(
                "add_columns",
                frame,
                columns={
                    "year": "year(published_at)",
                    "engagement_rate": "try_divide(likes, views) * 100",
                },
            ),
        ],
        [
            _with_history(
                frame,
                f"{root}/trending_videos",
                ["video_id"],
                "trending_videos_done",
                ["category_id"],
                sort_by=["views desc"],
                tracking_columns=["views", "likes", "comments"],
            ),
            _channel_names_output(root),
            _overwritten("tags_df", f"{root}/tags", ["video_id", "id"], "tags_done", buckets=ENTITY_BUCKETS),
        ],
    )


GOLDEN = {
    "categories": categories,
    "channels_information": channels_information,
    "comment_threads": comment_threads,
    "related_category_videos": related_category_videos,
    "replies": replies,
    "trending_videos": trending_videos,
}

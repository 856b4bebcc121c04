"""Nested API responses to flat raw rows.

A response is a JSON object with an ``items`` array.  All dumps of one kind are read as
one frame and exploded together; there is no loop over responses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import (
    clean_id,
    clean_number,
    clean_text,
    duration_seconds,
    join_values,
)

# The shape of one item of each kind of response.
ITEM_SCHEMAS: dict[str, str] = {
    "videos": (
        "id string, "
        "snippet struct<title:string, publishedAt:string, channelId:string, "
        "channelTitle:string, tags:array<string>, categoryId:string, "
        "defaultAudioLanguage:string, liveBroadcastContent:string>, "
        "statistics struct<viewCount:string, likeCount:string, commentCount:string>, "
        "contentDetails struct<duration:string, dimension:string, definition:string, "
        "licensedContent:boolean>"
    ),
    "channels": (
        "id string, "
        "snippet struct<title:string, description:string, publishedAt:string, country:string>, "
        "statistics struct<viewCount:string, subscriberCount:string, videoCount:string>"
    ),
    "search": (
        "id struct<videoId:string>, "
        "snippet struct<title:string, description:string, publishedAt:string, "
        "channelId:string, channelTitle:string, thumbnails:struct<high:struct<url:string>>, "
        "liveBroadcastContent:string>"
    ),
    "categories": "id string, snippet struct<title:string>",
    "threads": (
        "id string, "
        "snippet struct<topLevelComment:struct<snippet:struct<videoId:string, "
        "authorDisplayName:string, textDisplay:string, likeCount:string, "
        "publishedAt:string>>, totalReplyCount:string>"
    ),
    "comments": (
        "id string, "
        "snippet struct<authorDisplayName:string, authorChannelId:struct<value:string>, "
        "textDisplay:string, likeCount:string, publishedAt:string, updatedAt:string>"
    ),
}

Text = Callable[..., Column]


def _videos(text: Text) -> dict[str, Column]:
    return {
        "video_id": clean_id("item.id"),
        "title": text("item.snippet.title"),
        "view_count": clean_number("item.statistics.viewCount"),
        "like_count": clean_number("item.statistics.likeCount"),
        "comment_count": clean_number("item.statistics.commentCount"),
        "published_at": text("item.snippet.publishedAt"),
        "duration": duration_seconds("item.contentDetails.duration"),
        "dimension": text("item.contentDetails.dimension"),
        "definition": text("item.contentDetails.definition"),
        "licensed_content": F.coalesce("item.contentDetails.licensedContent", F.lit(False)),
        "channel_id": text("item.snippet.channelId"),
        "channel_title": text("item.snippet.channelTitle"),
        "tags": join_values("item.snippet.tags"),
        "category_id": text("item.snippet.categoryId"),
        "audio_language": text("item.snippet.defaultAudioLanguage"),
        "live_broadcast_content": text("item.snippet.liveBroadcastContent", missing="normal"),
    }


def _channels(text: Text) -> dict[str, Column]:
    return {
        "channel_id": clean_id("item.id"),
        "title": text("item.snippet.title"),
        "description": text("item.snippet.description"),
        "published_at": F.col("item.snippet.publishedAt"),
        "view_count": clean_number("item.statistics.viewCount"),
        "subscriber_count": clean_number("item.statistics.subscriberCount"),
        "video_count": clean_number("item.statistics.videoCount"),
        "country": text("item.snippet.country"),
    }


def _search(text: Text) -> dict[str, Column]:
    return {
        "video_id": clean_id("item.id.videoId"),
        "title": text("item.snippet.title"),
        "description": text("item.snippet.description"),
        "published_at": text("item.snippet.publishedAt"),
        "channel_id": text("item.snippet.channelId"),
        "channel_title": text("item.snippet.channelTitle"),
        "thumbnails": text("item.snippet.thumbnails.high.url"),
        "liveBroadcastContent": text("item.snippet.liveBroadcastContent"),
    }


def _categories(text: Text) -> dict[str, Column]:
    return {"category_id": clean_id("item.id"), "category_title": text("item.snippet.title")}


def _threads(text: Text) -> dict[str, Column]:
    top = "item.snippet.topLevelComment.snippet"
    return {
        "comment_thread_id": clean_id("item.id"),
        "video_id": clean_id(f"{top}.videoId"),
        "author_name": text(f"{top}.authorDisplayName"),
        "text": text(f"{top}.textDisplay"),
        "like_count": clean_number(f"{top}.likeCount"),
        "published_at": text(f"{top}.publishedAt"),
        "total_reply_count": clean_number("item.snippet.totalReplyCount"),
    }


def _comments(text: Text) -> dict[str, Column]:
    return {
        "comment_id": clean_id("item.id"),
        "author_name": text("item.snippet.authorDisplayName"),
        "author_channel_id": clean_id("item.snippet.authorChannelId.value"),
        "text_display": text("item.snippet.textDisplay"),
        "like_count": clean_number("item.snippet.likeCount"),
        "published_at": text("item.snippet.publishedAt"),
        "updated_at": text("item.snippet.updatedAt"),
    }


_COLUMNS = {
    "videos": _videos,
    "channels": _channels,
    "search": _search,
    "categories": _categories,
    "threads": _threads,
    "comments": _comments,
}


def flatten(
    responses: DataFrame,
    kind: str,
    body: str = "body",
    stamp: list[str] | None = None,
    escape_quotes: bool = False,
) -> DataFrame:
    """One flat row per item of the JSON text in column ``body``.

    ``stamp`` names columns of ``responses`` (the key a response was fetched for) to put
    on each of its rows.  A response without items, or that is not JSON, gives no row.
    """
    if kind not in _COLUMNS:
        raise ValueError(f"unknown response kind {kind!r}; use one of {sorted(_COLUMNS)}")

    def text(path: str, **options) -> Column:
        return clean_text(path, escape_quotes=escape_quotes, **options)

    items = f"items array<struct<{_nested(ITEM_SCHEMAS[kind])}>>"
    keys = list(stamp or [])
    unfolded = responses.select(
        *keys, F.explode(F.from_json(F.col(body), items)["items"]).alias("item")
    )
    return unfolded.select(
        *[column.alias(name) for name, column in _COLUMNS[kind](text).items()], *keys
    )


def _nested(ddl: str) -> str:
    """A column list as the inside of ``struct<...>``: top-level names take a colon."""
    out, depth = [], 0
    for part in ddl.split(", "):
        out.append(part.replace(" ", ":", 1) if depth == 0 else part)
        depth += part.count("<") - part.count(">")
    return ", ".join(out)


def extract(
    spark: SparkSession, path: str | list[str], kind: str, stamp: list[str] | None = None
) -> DataFrame:
    """All dumps at ``path`` as raw rows.

    A dump is a JSON-lines file with the response text in ``body`` and the columns of
    ``stamp`` beside it.
    """
    columns = ", ".join(["body string", *[f"{c} string" for c in stamp or []]])
    return flatten(spark.read.schema(columns).json(path), kind, "body", stamp)

"""Every kind of response, with absent parts."""

import json

import pytest
from conftest import rows

from millrace.sources import responses as rs

VIDEO = {
    "id": " v1 ",
    "snippet": {"title": 'A "b",\nc', "publishedAt": "2024-01-02T03:04:05Z", "channelId": "c1",
                "channelTitle": "One", "tags": ["x", "y"], "categoryId": "10",
                "defaultAudioLanguage": "en", "liveBroadcastContent": "none"},
    "statistics": {"viewCount": "100", "likeCount": "7", "commentCount": "2"},
    "contentDetails": {"duration": "PT1M", "dimension": "2d", "definition": "hd",
                       "licensedContent": True},
}
BARE = {
    "id": "v2",
    "snippet": {"title": "t", "publishedAt": "2024-01-02T03:04:05Z", "channelId": "c1",
                "channelTitle": "One"},
    "statistics": {"viewCount": "many"},
    "contentDetails": {"duration": "garbage"},
}


def flat(spark, kind, items, **extra):
    body = json.dumps({"items": items})
    df = spark.createDataFrame([(body, "K")], "body string, key string")
    return rs.flatten(df, kind, **extra)


def test_videos(spark):
    got = {r["video_id"]: r.asDict() for r in flat(spark, "videos", [VIDEO, BARE]).collect()}
    assert got["v1"]["title"] == 'A "b", c' and got["v1"]["tags"] == "x,y"
    assert (got["v1"]["view_count"], got["v1"]["duration"]) == (100, 60.0)
    assert got["v2"] == {
        "video_id": "v2", "title": "t", "view_count": None, "like_count": None,
        "comment_count": None, "published_at": "2024-01-02T03:04:05Z", "duration": None,
        "dimension": "N/A", "definition": "N/A", "licensed_content": False, "channel_id": "c1",
        "channel_title": "One", "tags": "", "category_id": "N/A", "audio_language": "N/A",
        "live_broadcast_content": "normal",
    }
    doubled = flat(spark, "videos", [VIDEO], escape_quotes=True).first()["title"]
    assert doubled == 'A ""b"", c'


def test_channels(spark):
    item = {"id": "c", "snippet": {"title": "T", "publishedAt": "2020"},
            "statistics": {"viewCount": 5, "videoCount": "0"}}
    assert rows(flat(spark, "channels", [item])) == [("c", "T", "N/A", "2020", 5, None, 0, "N/A")]


def test_search_with_stamp(spark):
    item = {"id": {"videoId": "v"}, "snippet": {
        "title": "T", "description": "D", "publishedAt": "P", "channelId": "C",
        "channelTitle": "CT", "thumbnails": {"high": {"url": "U"}}, "liveBroadcastContent": "L"}}
    out = flat(spark, "search", [item, item], stamp=["key"])
    assert rows(out) == [("v", "T", "D", "P", "C", "CT", "U", "L", "K")] * 2


def test_categories(spark):
    assert rows(flat(spark, "categories", [{"id": "1 ", "snippet": {"title": " Film "}}])) == [
        ("1", "Film")
    ]


def test_threads_and_comments(spark):
    thread = {"id": "t", "snippet": {"totalReplyCount": 3, "topLevelComment": {"snippet": {
        "videoId": "v", "authorDisplayName": "A", "textDisplay": "x\ry", "likeCount": 4,
        "publishedAt": "P"}}}}
    assert rows(flat(spark, "threads", [thread])) == [("t", "v", "A", "x y", 4, "P", 3)]
    comment = {"id": "c", "snippet": {"authorDisplayName": None, "authorChannelId": {"value": "ac"},
                                      "textDisplay": "x", "likeCount": "n", "publishedAt": "P"}}
    assert rows(flat(spark, "comments", [comment])) == [
        ("c", "N/A", "ac", "x", None, "P", "N/A")
    ]


def test_empty_and_broken_responses_give_no_row(spark):
    df = spark.createDataFrame([('{"items": []}',), ("{}",), ("no json",), (None,)], "body string")
    assert rs.flatten(df, "videos").count() == 0
    with pytest.raises(ValueError, match="unknown response kind"):
        rs.flatten(df, "playlists")


def test_extract_reads_all_dumps(spark, tmp_path):
    for i in range(3):
        line = {"body": json.dumps({"items": [VIDEO, BARE]}), "region": f"r{i}"}
        (tmp_path / f"{i}.json").write_text(json.dumps(line))
    out = rs.extract(spark, str(tmp_path), "videos", ["region"])
    assert out.count() == 6 and out.select("region").distinct().count() == 3

"""R0-R6 and I1-I8 end to end: dumps, raw CSV, manifest, golden tables, insights."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import insights, runner
from millrace.plans.golden import GOLDEN
from millrace.plans.raw import RAW_TABLES, build_raw
from millrace.sources import catalog, ledger
from millrace.sources import manifest as m
from millrace.sources.tables import AppendTable, VersionedTable, stored_table
from millrace.streaming import readiness as rd


def dump(folder, kind, items, **stamp):
    path = folder / kind
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text(
        json.dumps({"body": json.dumps({"items": items}), **stamp})
    )


def video(ident, channel, title, views, likes, category="1", tags=None, year=2024):
    snippet = {"title": f"video {ident}", "publishedAt": f"{year}-05-06T07:08:09Z",
               "channelId": channel, "channelTitle": title, "categoryId": category}
    if tags:
        snippet["tags"] = tags
    return {"id": ident, "snippet": snippet,
            "statistics": {"viewCount": views, "likeCount": likes, "commentCount": "3"},
            "contentDetails": {"duration": "PT10S"}}


def fill(folder):
    dump(folder, "videos", [
        video("v1", "c1", "One", "100", "10", tags=["x", "y"]),
        video("v2", "c1", "Uno", "0", "5", "2", tags=["x"], year=2023),
        video("v3", "c2", "Two", "50", None),  # no tags, no likes
        video("v1", "c1", "One", "100", "10", tags=["y", "z"]),  # the same video twice
    ])
    dump(folder, "categories", [{"id": "1", "snippet": {"title": "Film"}},
                                {"id": "2", "snippet": {"title": "Music"}}])
    dump(folder, "channels", [
        {"id": "c1", "snippet": {"title": "One", "publishedAt": "2010-01-01T00:00:00Z",
                                 "country": "VN"},
         "statistics": {"viewCount": "1000", "subscriberCount": "9", "videoCount": "0"}},
        {"id": "c2", "snippet": {"title": "Two", "publishedAt": "2012-01-01T00:00:00Z"},
         "statistics": {"viewCount": "500", "subscriberCount": "8", "videoCount": "4"}},
        {"id": "c3", "snippet": {"title": "Hidden", "publishedAt": "2012-01-01T00:00:00Z"},
         "statistics": {"viewCount": "1"}},
    ])

    def search(ident):
        return {"id": {"videoId": ident}, "snippet": {
            "title": f"related {ident}", "description": 'a, "b"', "channelId": "c1",
            "publishedAt": "2024-01-01T00:00:00Z", "channelTitle": "One",
            "thumbnails": {"high": {"url": "u"}}, "liveBroadcastContent": "none"}}

    dump(folder, "search", [search("v1"), search("v9")], category_id="2")

    def thread(ident, video_id, author):
        return {"id": ident, "snippet": {"totalReplyCount": 1, "topLevelComment": {"snippet": {
            "videoId": video_id, "authorDisplayName": author, "textDisplay": "nice\none",
            "likeCount": 2, "publishedAt": "2024-02-03T00:00:00Z"}}}}

    dump(folder, "threads", [thread("t1", "v1", "ann"), thread("t2", "v1", "bob"),
                             thread("t3", "v2", "ann")])

    def reply(ident, author):
        return {"id": ident, "snippet": {
            "authorDisplayName": author, "authorChannelId": {"value": "ac"},
            "textDisplay": f"re {ident}", "likeCount": 1, "publishedAt": "2024-02-04T00:00:00Z",
            "updatedAt": "2024-02-04T00:00:00Z"}}

    dump(folder, "comments", [reply("r1", "cid"), reply("r2", "ann")], comment_thread_id="t1")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """All six datasets from dumps to golden tables; returns reader, ledger and events."""
    root = tmp_path_factory.mktemp("lake")
    fill(root / "dumps")
    book = ledger.Ledger(spark, str(root / "ledger"))
    outputs = []

    def announce(event):
        ledger.send_finish_event(spark, str(root / "events"), event)

    for dataset, (kind, _) in RAW_TABLES.items():
        batch = m.Batch(str(root), "site", "raw", dataset, "20240601", 1)
        written = build_raw(spark, str(root / "dumps" / kind), batch)
        spec = m.with_manifest(GOLDEN[dataset](str(root / "golden")), written, str(root))
        outputs += runner.execute(spark, spec, book, announce).outputs

    def read(name):
        return stored_table(spark, str(root / "golden" / name)).read()

    read.root, read.book, read.outputs = root, book, outputs
    return read


def test_golden_tables(lake):
    assert rows(lake("categories")) == [(1, "Film"), (2, "Music")]
    channels = lake("channels/current")
    assert rows(channels.select("channel_id", "avg_views_per_video")) == [("c1", None), ("c2", 125.0)]
    assert rows(lake("countries").select("country")) == [("N/A",), ("VN",)]
    videos = lake("trending_videos/current")
    assert rows(videos.select("video_id", "views", "likes", "engagement_rate", "year")) == [
        ("v1", 100, 10, 10.0, 2024), ("v2", 0, 5, None, 2023), ("v3", 50, None, None, 2024),
    ]
    assert rows(lake("tags").select("video_id", "value")) == [
        ("v1", "x"), ("v1", "y"), ("v1", "z"), ("v2", "x"),
    ]
    # One name per channel; R4 wrote to the same table
    assert rows(lake("channels_basic_information")) == [("c1", "One"), ("c2", "Two")]
    # Authors of threads and of replies keep apart and meet where equal
    assert rows(lake("authors").select("author_name")) == [("ann",), ("bob",), ("cid",)]
    assert rows(lake("comment_threads/current").select("comment_text").distinct()) == [("nice one",)]
    assert rows(lake("related_category_videos/current").select("description").distinct()) == [
        ('a, "b"',)
    ]
    assert lake("replies/current").count() == 2


def test_history_and_ledger(spark, lake):
    history = AppendTable(spark, str(lake.root / "golden/trending_videos/history")).read()
    assert history.count() == 3 and "record_timestamp" in history.columns
    statuses = ledger.latest_status(lake.book.rows(), ["dataset"])
    assert rows(statuses.select("status").distinct()) == [("SUCCESS",)]


def test_events_make_insights_ready(spark, lake):
    events = spark.read.text(str(lake.root / "events"))
    valid = rd.validate_events(events)
    assert valid.filter("reject_reason IS NOT NULL").count() == 0
    sent = {r[0] for r in rows(valid.select("finish_event").distinct())}
    mapping = rd.load_mapping(insights.TRIGGERS)
    rd.check_mapping(mapping, sent)
    wanted = [(name,) for name in sorted(insights.INSIGHTS)]
    for messages in (valid, ledger.run_messages(lake.book.rows())):
        ready = rd.ready_targets(messages, rd.mapping_rows(spark, mapping))
        assert rows(ready.select("target")) == wanted


def test_outputs_are_registered(spark, lake):
    done = catalog.register_outputs(spark, "golden", lake.outputs)
    assert len([n for n in done if not n.endswith("_history")]) == 10
    assert spark.table("golden.trending_videos_history").count() == 3
    assert spark.table("golden.trending_videos").count() == 3
    assert spark.table("golden.channels").columns[-1] == "country_id"


def test_publish(spark, lake):
    root = str(lake.root)
    for name in insights.INSIGHTS:
        insights.publish(spark, name, f"{root}/golden", f"{root}/insights/{name}", "insights")
    again = insights.publish(
        spark, "comment_insights", f"{root}/golden", f"{root}/insights/comment_insights", "insights"
    )
    assert again.version() == 2
    assert spark.table("insights.comment_insights").count() == 2
    assert spark.table("insights.tag_performance_metrics").count() == 3
    with pytest.raises(ValueError, match="does not exist"):
        insights.publish(spark, "comment_insights", f"{root}/nothing", f"{root}/x")


def test_second_day(spark, lake, tmp_path):
    """The same spec on another batch: SCD4 current follows, history grows, tags add up."""
    raw = spark.createDataFrame(
        [("v1", "100", "10", "x"), ("v2", "5", "1", None)],
        "video_id string, view_count string, like_count string, tags string",
    ).selectExpr(
        "*", "'t' AS title", "'1' AS comment_count", "'2024-01-01T00:00:00Z' AS published_at",
        "1.0D AS duration", "'2d' AS dimension", "'hd' AS definition", "true AS licensed_content",
        "'c' AS channel_id", "'C' AS channel_title", "'1' AS category_id",
        "'en' AS audio_language", "'none' AS live_broadcast_content",
    )
    path = str(tmp_path / "golden")
    for day in (raw, raw.filter("video_id = 'v1'").withColumn("view_count", F.lit("200"))):
        m.write_csv_batch(day, m.Batch(str(tmp_path), "s", "raw", "t", "d", 1))
        spec = GOLDEN["trending_videos"](path)
        spec["input"]["path"] = m.Batch(str(tmp_path), "s", "raw", "t", "d", 1).data_path
        spec["input"]["schema"] = day.schema
        spec["input"]["cache"] = True
        spec["quality"] = {"trending_videos_df": [
            {"column": "views", "type": "numeric", "min_value": 150, "null_allowed": False}]}
        result = runner.execute(spark, spec)
    assert result.outputs[0]["schema"][0]["name"] == "video_id"
    report = {r["check"]: r["passed"] for r in result.quality.collect()}
    assert report == {"null": True, "min_value": True}
    read = lambda name: stored_table(spark, f"{path}/{name}").read()
    assert rows(read("trending_videos/current").select("video_id", "views")) == [
        ("v1", 200), ("v2", 5),
    ]
    assert AppendTable(spark, f"{path}/trending_videos/history").read().count() == 3
    assert read("tags").count() == 1


def test_insights(spark, lake):
    frames = {}
    for needed in insights.DEPENDENCIES.values():
        frames.update(insights.read_golden(spark, str(lake.root / "golden"), needed))
    out = {name: job(frames) for name, job in insights.INSIGHTS.items()}
    assert rows(out["video_performance_metrics"].select("video_id", "category_name")) == [
        ("v1", "Film"), ("v2", "Music"), ("v3", "Film"),
    ]
    assert out["category_popularity_metrics"].columns == out["video_performance_metrics"].columns
    assert rows(out["channel_engagement_metrics"].select("channel_name", "country_name")) == [
        ("One", "VN"), ("One", "VN"), ("Two", "N/A"),
    ]
    assert rows(out["channel_growth_metrics"]) == [
        ("c1", "One", 100, 15, 6, 10.0, 2), ("c2", "Two", 50, None, 3, None, 1),
    ]
    assert [tuple(r) for r in out["comment_insights"].collect()] == [
        ("v1", 2, 4, 2, "video v1", 100, 10, 3), ("v2", 1, 2, 1, "video v2", 0, 5, 3),
    ]
    activity = out["author_activity_metrics"].select("comment_thread_id", "author_name", "reply_text")
    assert rows(activity) == [
        ("t1", "ann", "re r1"), ("t1", "ann", "re r2"), ("t2", "bob", None), ("t3", "ann", None),
    ]
    assert rows(out["related_videos_network"]) == [
        ("v1", "related v1", 2, "Music", "v1", "video v1", 100, "c1"),
    ]
    assert [tuple(r)[:3] for r in out["tag_performance_metrics"].collect()] == [
        ("x", 2, 100), ("y", 1, 100), ("z", 1, 100),
    ]


def test_insights_are_exact_when_a_dimension_repeats_a_key(spark):
    videos = spark.createDataFrame(
        [("v1", "c", 1, 2, 3, 4.0, "t"), ("v2", "c", 10, 20, 30, None, "u")],
        "video_id string, channel_id string, views int, likes int, comments int, "
        "engagement_rate double, title string",
    )
    channels = spark.createDataFrame([("c", "n"), ("c", "n")], "channel_id string, channel_name string")
    got = insights.channel_growth({"trending_videos": videos, "channels": channels})
    assert rows(got) == [("c", "n", 22, 44, 66, 4.0, 2)]
    threads = spark.createDataFrame(
        [("t1", "v1", 5, "a"), ("t2", "v1", 6, "a")],
        "comment_thread_id string, video_id string, comment_likes int, author_id string",
    )
    got = insights.comment_insights({"comment_threads": threads, "trending_videos": videos.union(videos)})
    assert rows(got) == [("v1", 4, 22, 1, "t", 1, 2, 3)]
    tags = spark.createDataFrame(
        [("v1", "x"), ("v1", "x"), ("v2", "x"), ("v2", "y")], "video_id string, value string"
    )
    got = insights.tag_performance({"tags": tags, "trending_videos": videos})
    assert rows(got) == [("x", 2, 12, 24, 36, 4.0), ("y", 1, 10, 20, 30, None)]


def test_command_line(spark, lake, tmp_path):
    from millrace.__main__ import main

    spec = GOLDEN["comment_threads"](str(tmp_path / "golden"))
    (tmp_path / "spec.json").write_text(json.dumps(spec))
    batch = m.Batch(str(lake.root), "site", "raw", "comment_threads", "20240601", 1)
    common = ["--spec", str(tmp_path / "spec.json"), "--root", str(lake.root)]
    main(["spec", *common, "--batch-id", "b7", "--database", "shell", "--manifest", batch.manifest_path,
          "--ledger", str(tmp_path / "ledger"), "--events", str(tmp_path / "events")])
    threads = VersionedTable(spark, str(tmp_path / "golden/comment_threads/current")).read()
    assert rows(threads) == rows(lake("comment_threads/current"))
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.status_of(book.rows(), "comment_threads_df") == "SUCCESS"
    assert spark.read.text(str(tmp_path / "events")).count() == 2
    assert rows(book.rows().select("batch_id").distinct()) == [("b7",)]
    assert spark.table("shell.comment_threads").count() == threads.count()
    (tmp_path / "mapping.json").write_text('{"comment_threads_done,authors_done": "both"}')
    main(["readiness", "--events", str(tmp_path / "events"), "--mapping", str(tmp_path / "mapping.json"),
          "--checkpoint", str(tmp_path / "checkpoint"), "--out", str(tmp_path / "fired")])
    assert rows(spark.read.parquet(str(tmp_path / "fired"))) == [("b7", "both")]
    (tmp_path / "empty.json").write_text('{"partitions": []}')
    with pytest.raises(ValueError, match="names no files"):
        main(["spec", *common, "--manifest", str(tmp_path / "empty.json")])
    main(["insight", "--name", "author_activity_metrics",
          "--golden", str(lake.root / "golden"), "--out", str(tmp_path / "out")])
    assert VersionedTable(spark, str(tmp_path / "out")).read().count() == 4


def test_unknown_raw_table(spark):
    with pytest.raises(ValueError, match="unknown raw table"):
        build_raw(spark, "x", m.Batch("r", "s", "raw", "playlists", "d", 1))


# --- the runner


def test_runner_errors(spark):
    df = {"input_df": spark.range(3)}
    with pytest.raises(ValueError, match="no frame named 'x'"):
        runner.apply_steps(df, [{"name": "filter_rows", "target": "x", "params": {"condition": "true"}}])
    with pytest.raises(ValueError, match="unknown step"):
        runner.apply_steps(df, [{"name": "nope"}])
    with pytest.raises(ValueError, match="output_names do not fit"):
        runner.apply_steps(
            df,
            [{"name": "extract_unique_entities", "multi_output": True, "output_names": ["a"],
              "params": {"entity_columns": ["id"], "id_column": "id"}}],
        )
    with pytest.raises(ValueError, match="expected one DataFrame"):
        runner.apply_steps(
            df,
            [{"name": "extract_unique_entities",
              "params": {"entity_columns": ["id"], "id_column": "id"}}],
        )
    with pytest.raises(ValueError, match="no frame named 'y'"):  # D9
        runner.apply_steps(
            df, [{"name": "join_dataframes", "params": {"df2": "y", "join_cols": ["id"]}}]
        )


def test_runner_targets(spark):
    frames, last = runner.apply_steps(
        {"input_df": spark.range(4)},
        [
            {"name": "filter_rows", "params": {"condition": "id > 0"}},  # replaces its target
            {"name": "add_columns", "params": {"columns": {"x": "id * 2"}}, "output_names": ["b"]},
            {"name": "drop_columns", "params": {"columns": ["id"]}, "show_sample": True},
        ],
    )
    assert last == "b" and frames["input_df"].count() == 3 and rows(frames["b"]) == [(2,), (4,), (6,)]


def test_failed_output_is_noted(spark, tmp_path):  # D17
    book = ledger.Ledger(spark, str(tmp_path))
    spec = {"output": [{"dataframe": "d", "finish_event": "done"}]}
    sent = []

    def broken(df, output):
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError):
        runner.write_outputs({"d": spark.range(1)}, spec, broken, book, sent.append)
    assert ledger.status_of(book.rows(), "d") == "FAILED" and sent == []
    with pytest.raises(ValueError, match="unknown frame"):
        runner.write_outputs({}, spec, broken)


def test_ledger_closes_before_the_event(spark, tmp_path):  # D16
    book = ledger.Ledger(spark, str(tmp_path))
    seen = []
    runner.write_outputs(
        {"d": spark.range(1)},
        {"output": [{"dataframe": "d", "finish_event": "done"}]},
        lambda df, output: None,
        book,
        lambda event: seen.append(ledger.status_of(book.rows(), event["dataset"])),
    )
    assert seen == ["SUCCESS"]


def test_expected_schema_and_quality(spark):
    frames = {"d": spark.range(3)}
    spec = {"output": [{"dataframe": "d", "expected_schema": {"id": "string"}}]}
    with pytest.raises(ValueError, match="schema differs"):
        runner.write_outputs(frames, spec, lambda df, output: None)
    rules = {"d": [{"column": "id", "type": "numeric", "min_value": 1}]}
    assert runner.check_quality(frames, rules).first()["violations"] == 1
    with pytest.raises(ValueError):
        runner.check_quality(frames, {"zz": []})
    assert runner.check_quality(frames, {}) is None


def test_schema_rows(spark):
    df = spark.range(1).select("id", F.lit("x").alias("s", metadata={"note": "n"}))
    assert runner.schema_rows(df) == [
        {"ordinal": 0, "name": "id", "type": "bigint", "nullable": False},
        {"ordinal": 1, "name": "s", "type": "string", "nullable": False, "metadata": {"note": "n"}},
    ]

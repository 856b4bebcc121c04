"""Insights kept up to date batch by batch, dense numbers, and joins of bucketed catalog tables."""

import random

from conftest import SMALL, rows
from pyspark.sql import functions as F

from checks import insights as checked
from millrace.plans import insights
from millrace.plans.incremental import ChannelGrowth, CommentInsights
from millrace.sources import catalog
from millrace.sources.catalog import write_bucketed
from millrace.sources.ids import DenseIds


def test_numbers_are_dense_and_stay(spark, tmp_path):
    ids = DenseIds(spark, str(tmp_path / "ids"), buckets=4)
    got = {}
    for batch in (["a", "b", "b", None], [None], ["c", "a", "d"], ["d"]):
        df = spark.createDataFrame([(v, 1) for v in batch], "v string, x int").repartition(3)
        for r in ids.number(df, "v", "n").collect():
            assert got.setdefault(r.v, r.n) == r.n
    assert got.pop(None) is None
    assert sorted(got.values()) == [1, 2, 3, 4] and {got["a"], got["b"]} == {1, 2}


def videos(spark, drawn, n):
    made = [
        (f"v{drawn.randrange(30)}", drawn.choice(["c1", "c2", "c3", None]), drawn.randrange(100), drawn.choice([None, 5]), 2,
         drawn.choice([None, 0.5, 2.0]), "t")
        for _ in range(n)
    ] + [(None, "c1", 1, 1, 1, 1.0, "t")]
    kind = "video_id string, channel_id string, views long, likes long, comments long, engagement_rate double, title string"
    return spark.createDataFrame(made, kind)


def test_growth_equals_the_whole_after_every_batch(spark, tmp_path):
    drawn = random.Random(4)
    channels = spark.createDataFrame([("c1", "One"), ("c2", "Two"), ("c2", "Two"), ("c9", "None")], "channel_id string, channel_name string")
    job, whole = ChannelGrowth(spark, str(tmp_path / "growth")), None

    def same():
        got, want = job.result(channels), insights.channel_growth({"trending_videos": whole, "channels": channels})
        assert got.dtypes == want.dtypes and rows(got) == rows(want)

    for number in range(3):
        batch = videos(spark, drawn, 40)
        whole = batch if whole is None else whole.union(batch)
        job.add(batch, f"b{number}")
        same()
    job.add(batch, "b2")  # again
    same()
    job.partials.compact("all")
    same()
    assert job.partials.parts.read().count() <= 5
    job.add(batch.limit(0), "empty")
    same()


def test_comments_equal_the_whole(spark, tmp_path):
    drawn = random.Random(5)
    some = videos(spark, drawn, 30).filter("video_id IS NOT NULL")
    kind = "comment_thread_id string, video_id string, comment_likes int, author_id string"
    job, whole = CommentInsights(spark, str(tmp_path / "comments")), None
    for number in range(3):
        made = [(drawn.choice([None, "t1", "t2"]), f"v{drawn.randrange(40)}", 3, drawn.choice([None, "a", "b", f"x{number}"])) for _ in range(60)]
        batch = spark.createDataFrame(made, kind)
        whole = batch if whole is None else whole.union(batch)
        job.add(batch, str(number))
    want = insights.comment_insights({"comment_threads": whole, "trending_videos": some})
    assert rows(job.result(some)) == rows(want)


def test_partials_of_sparse_groups_stay_small(spark, tmp_path):
    """A group with few of very many values keeps a few words, not a whole bitmap."""
    job = CommentInsights(spark, str(tmp_path / "comments"))
    job.add(spark.range(40_000).selectExpr("string(id)", "string(id % 400)", "1", "string(id)").toDF("comment_thread_id", "video_id", "comment_likes", "author_id"), "0")
    parts = job.partials.parts.read()
    assert parts.count() <= 40_000
    held = sum(f.stat().st_size for f in (tmp_path / "comments" / "partials").rglob("*.parquet"))
    assert held < 24 * 40_000
    got = job.partials.merged("authors")
    assert got.selectExpr("count(*)", "min(authors)", "max(authors)").first()[:] == (400, 100, 100)


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    drawn = random.Random(6)
    some = videos(spark, drawn, 30).filter("video_id IS NOT NULL")
    threads = spark.createDataFrame(
        [(f"t{i}", f"v{drawn.randrange(40)}", 1, "a") for i in range(90)],
        "comment_thread_id string, video_id string, comment_likes int, author_id string",
    )
    plain = {"comment_threads": threads, "trending_videos": some}
    frames = {n: write_bucketed(df, "bucketed", n, ["video_id"], 4, str(tmp_path / n), ["video_id"]) for n, df in plain.items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = insights.comment_insights(frames)
        got, plan = rows(df), df._jdf.queryExecution().executedPlan().toString()
        other = insights.comment_insights(plain)
        want, shuffled = rows(other), other._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want
    assert "SortMergeJoin" in plan and "hashpartitioning(video_id" not in plan
    assert "hashpartitioning(video_id" in shuffled
    again = write_bucketed(some.limit(3), "bucketed", "trending_videos", ["video_id"], 4, str(tmp_path / "again"))
    assert again.count() == 3 and spark.table("bucketed.trending_videos").select(F.count("*")).first()[0] == 3


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    assert [catalog.buckets_for(n, 8) for n in (0, 4_000_000, 4_000_001, 216_000_000)] == [8, 8, 16, 512]
    monkeypatch.setattr(catalog, "ROWS_A_BUCKET", 500)
    got = checked.bucketed_insight(spark, SMALL)
    assert rows(got) == rows(checked.i5_comment_insights(spark, SMALL))
    about = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED checked_buckets.comment_threads").collect()}
    assert int(about["Num Buckets"]) == 16

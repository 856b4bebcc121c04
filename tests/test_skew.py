"""One key holds a third of all rows: results stay whole and no task gets the key alone."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.joins import left_join_fanout
from millrace.plans import insights

N = 120_000
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for key, value in CONF.items():
        spark.conf.set(key, value)
    ids = spark.range(0, N, 1, 8)
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    yield ids.select("id", hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_after(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_fanout_join_splits_the_hot_right_side(spark, skewed):
    left = spark.range(0, 6000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    out = left_join_fanout(left, skewed, ["k"])
    plan = plan_after(out)
    assert "skew=true" in plan
    counts = out.agg(F.count("*"), F.count("id"), F.count_distinct("k")).first()
    hot_free = skewed.select("k").distinct().count()
    assert tuple(counts) == (N + 6000 - hot_free, N, 6000)


def test_author_activity(spark, skewed):
    threads = spark.range(0, 6000).select(
        F.col("id").alias("comment_thread_id"),
        F.lit("a").alias("author_id"),  # one author wrote everything
        F.lit("x").alias("comment_text"),
        F.lit(1).alias("comment_likes"),
        F.lit(1).alias("total_reply_count"),
        F.lit("v").alias("video_id"),
        F.current_timestamp().alias("published_at"),
    )
    authors = spark.createDataFrame([("a", "ann")], "author_id string, author_name string")
    replies = skewed.select(
        F.col("k").alias("comment_thread_id"),
        F.col("text").alias("reply_text"),
        F.lit(1).alias("reply_likes"),
    )
    out = insights.author_activity(
        {"comment_threads": threads, "authors": authors, "replies": replies}
    )
    assert "skew=true" in plan_after(out)
    assert out.filter("reply_text IS NOT NULL").count() == N
    assert out.filter("author_name = 'ann'").count() == out.count()


def test_tag_performance(spark, skewed):
    tags = skewed.select(F.col("k").alias("video_id"), F.col("text").alias("value"))
    videos = spark.range(0, 5000).select(
        F.col("id").alias("video_id"),
        (F.col("id") + 1).alias("views"),
        F.lit(1).alias("likes"),
        F.lit(1).alias("comments"),
        F.lit(1.0).alias("engagement_rate"),
    )
    out = insights.tag_performance({"tags": tags, "trending_videos": videos})
    assert "skew=true" in plan_after(out)
    total = out.agg(F.count("*"), F.sum("total_views")).first()
    assert tuple(total) == (N, skewed.agg(F.sum(F.col("k") + 1)).first()[0])


def test_growth_meets_its_dimension_reduced(spark, skewed):
    """The hot channel is one row when it is joined: the join's input is as small as the
    number of channels."""
    videos = skewed.select(
        F.col("id").alias("video_id"),
        F.col("k").alias("channel_id"),
        F.lit(1).alias("views"),
        F.lit(2).alias("likes"),
        F.lit(3).alias("comments"),
        F.lit(0.5).alias("engagement_rate"),
    )
    channels = spark.range(0, 5000).select(
        F.col("id").alias("channel_id"), F.col("id").cast("string").alias("channel_name")
    )
    out = insights.channel_growth({"trending_videos": videos, "channels": channels})
    plan = plan_after(out)
    below_join = plan[plan.index("SortMergeJoin") :]
    assert "HashAggregate" in below_join
    assert rows(out.filter("channel_id = 0").drop("channel_name")) == [
        (0, N // 3 + 16, 2 * (N // 3 + 16), 3 * (N // 3 + 16), 0.5, N // 3 + 16)
    ]

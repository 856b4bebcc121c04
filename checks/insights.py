"""Insight jobs over the test tables.

Roles: part = video, words of its name = tags, supplier = channel, nation = country and
category, line item = a video's figures or a reply, order = comment thread, customer =
author.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import table
from millrace.functions import ratio
from millrace.operators.normalise import split_values
from millrace.plans import insights
from millrace.plans.incremental import ChannelGrowth, CommentInsights
from millrace.sources.catalog import buckets_for, write_bucketed
from millrace.sources.files import work_folder


def figures(spark, d):
    """Line items as trending videos: one row per sale, so a video has many rows."""
    items = table(spark, d, "lineitem")
    part = table(spark, d, "part").select(F.col("p_partkey").alias("video_id"), "p_name")
    return (
        items.select(
            F.col("l_partkey").alias("video_id"),
            F.col("l_suppkey").alias("channel_id"),
            F.col("l_linenumber").alias("category_id"),
            F.col("l_extendedprice").cast("bigint").alias("views"),
            F.col("l_quantity").cast("bigint").alias("likes"),
            F.col("l_orderkey").alias("comments"),
            F.year("l_shipdate").alias("year"),
        )
        .join(part, "video_id")
        .withColumnsRenamed({"p_name": "title"})
        .withColumn("engagement_rate", ratio("likes", "views", 100))
    )


def _videos(spark, d):
    """Parts as trending videos: one row per video."""
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("video_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").cast("bigint").alias("views"),
        F.col("p_size").cast("bigint").alias("likes"),
        F.length("p_type").cast("bigint").alias("comments"),
    )


def _categories(spark, d):
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("category_name")
    )


def _channels(spark, d):
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("channel_id"),
        F.col("s_name").alias("channel_name"),
        F.nullif("s_nationkey", F.lit(3)).alias("country_id"),
        F.length("s_name").alias("video_count"),
        F.col("s_suppkey").alias("subscribers"),
        F.col("s_acctbal").cast("bigint").alias("total_views"),
        ratio("s_acctbal", F.length("s_name")).alias("avg_views_per_video"),
    )


def _countries(spark, d):
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country")
    )


def i1_video_performance(spark, d):
    """I1 J2"""
    return insights.video_performance(
        {"trending_videos": figures(spark, d), "categories": _categories(spark, d)}
    )


def i2_category_popularity(spark, d):
    """I2 J2"""
    return insights.category_popularity(
        {"trending_videos": figures(spark, d), "categories": _categories(spark, d)}
    )


def i3_channel_engagement(spark, d):
    """I3 J5"""
    return insights.channel_engagement(
        {
            "trending_videos": figures(spark, d),
            "channels": _channels(spark, d),
            "countries": _countries(spark, d),
        }
    )


def i4_channel_growth(spark, d):
    """I4 A2 A3 A5"""
    return insights.channel_growth(
        {"trending_videos": figures(spark, d), "channels": _channels(spark, d)}
    ).withColumn("avg_engagement_rate", F.round("avg_engagement_rate", 6))


def _comments(spark, d):
    """Line items as comments, customers as their authors."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("author_id")
    )
    return (
        table(spark, d, "lineitem")
        .select("l_orderkey", "l_partkey", "l_quantity")
        .join(orders, "l_orderkey")
        .select(
            F.col("l_orderkey").alias("comment_thread_id"),
            F.col("l_partkey").alias("video_id"),
            F.col("l_quantity").cast("bigint").alias("comment_likes"),
            "author_id",
        )
    )


def i5_comment_insights(spark, d):
    """I5 A4 A6"""
    return insights.comment_insights(
        {"comment_threads": _comments(spark, d), "trending_videos": _videos(spark, d)}
    )


def _in_batches(job, facts, key):
    """Three batches, the second one twice, and then what they add up to put in their place."""
    for number in (0, 1, 1, 2):
        job.add(facts.filter(F.pmod(F.xxhash64(*key), F.lit(3)) == number), f"batch-{number}")
    job.partials.compact("all")
    return job


def incremental_growth(spark, d):
    """I4 K2 A5: totals and exact distinct counts from the partial results of three batches"""
    job = _in_batches(ChannelGrowth(spark, work_folder(spark, "growth")), figures(spark, d), ["video_id", "comments"])
    return job.result(_channels(spark, d)).withColumn("avg_engagement_rate", F.round("avg_engagement_rate", 6))


def incremental_comments(spark, d):
    """The same for comments and their authors"""
    job = _in_batches(CommentInsights(spark, work_folder(spark, "comments")), _comments(spark, d), ["comment_thread_id"])
    return job.result(_videos(spark, d))


def bucketed_insight(spark, d):
    """Comments and videos in catalog tables bucketed by video; no shuffle on the video"""
    buckets = buckets_for(table(spark, d, "lineitem").count(), 8)
    frames = {
        "comment_threads": write_bucketed(
            _comments(spark, d), "checked_buckets", "comment_threads", ["video_id"], buckets, work_folder(spark, "comments")
        ),
        "trending_videos": write_bucketed(
            _videos(spark, d), "checked_buckets", "trending_videos", ["video_id"], buckets, work_folder(spark, "videos")
        ),
    }
    return insights.comment_insights(frames)


def i6_author_activity(spark, d):
    """I6 J4"""
    threads = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("comment_thread_id"),
        F.nullif("o_custkey", F.lit(7)).alias("author_id"),
        F.col("o_orderpriority").alias("comment_text"),
        F.col("o_totalprice").cast("bigint").alias("comment_likes"),
        F.length("o_orderpriority").alias("total_reply_count"),
        F.col("o_orderstatus").alias("video_id"),
        F.col("o_orderdate").alias("published_at"),
    )
    authors = table(spark, d, "customer").select(
        F.col("c_custkey").alias("author_id"), F.col("c_name").alias("author_name")
    )
    replies = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("comment_thread_id"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("reply_text"),
        F.col("l_quantity").cast("bigint").alias("reply_likes"),
    )
    return insights.author_activity(
        {"comment_threads": threads, "authors": authors, "replies": replies}
    )


def i7_related_network(spark, d):
    """I7 J6"""
    related = table(spark, d, "part").select(
        F.col("p_partkey").alias("video_id"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("category_id"),
        F.col("p_brand").alias("channel_id"),
    )
    return insights.related_network(
        {
            "related_videos": related,
            "trending_videos": figures(spark, d),
            "categories": _categories(spark, d),
        }
    )


def i8_tag_performance(spark, d):
    """I8 N2 J3 O2"""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("video_id"), "p_name")
    _, tags = split_values(part, "p_name", ["video_id"], ["video_id"], " ")
    return insights.tag_performance(
        {"tags": tags, "trending_videos": figures(spark, d)}
    ).withColumn("avg_engagement_rate", F.round("avg_engagement_rate", 6))


QUERIES = {
    f.__name__: f
    for f in (
        i1_video_performance,
        i2_category_popularity,
        i3_channel_engagement,
        i4_channel_growth,
        i5_comment_insights,
        i6_author_activity,
        i7_related_network,
        i8_tag_performance,
        incremental_growth,
        incremental_comments,
        bucketed_insight,
    )
}

_FIGURES = """
WITH t AS (
  SELECT l_partkey AS video_id, l_suppkey AS channel_id, l_linenumber AS category_id,
         p_name AS title, CAST(trunc(l_extendedprice) AS BIGINT) AS views,
         CAST(trunc(l_quantity) AS BIGINT) AS likes, l_orderkey AS comments,
         CAST(trunc(l_quantity) AS DOUBLE) / nullif(CAST(trunc(l_extendedprice) AS DOUBLE), 0)
           * 100.0 AS engagement_rate,
         CAST(year(l_shipdate) AS INTEGER) AS year
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
_PERFORMANCE = f"""{_FIGURES}
SELECT video_id, channel_id, category_id, title, views, likes, comments, engagement_rate, year,
       n_name AS category_name
FROM t JOIN nation ON category_id = n_nationkey
"""
_SUMS = """CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
       CAST(sum(comments) AS BIGINT) AS total_comments,
       round(avg(engagement_rate), 6) AS avg_engagement_rate"""

SQL = {
    "i1_video_performance": _PERFORMANCE,
    "i2_category_popularity": _PERFORMANCE,
    "i3_channel_engagement": """
        SELECT s_suppkey AS channel_id, s_name AS channel_name,
               nullif(s_nationkey, 3) AS country_id, n_name AS country_name,
               CAST(length(s_name) AS INTEGER) AS video_count, s_suppkey AS subscribers,
               CAST(trunc(s_acctbal) AS BIGINT) AS total_views,
               s_acctbal / CAST(length(s_name) AS DOUBLE) AS avg_views_per_video
        FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey
        LEFT JOIN nation ON n_nationkey = nullif(s_nationkey, 3)""",
    "i4_channel_growth": f"""{_FIGURES}
        SELECT channel_id, s_name AS channel_name, {_SUMS},
               count(DISTINCT video_id) AS total_videos
        FROM t JOIN supplier ON s_suppkey = channel_id GROUP BY channel_id, s_name""",
    "i5_comment_insights": """
        SELECT p_partkey AS video_id, count(*) AS total_comments,
               CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS total_likes,
               count(DISTINCT o_custkey) AS unique_authors, p_name AS video_title,
               CAST(trunc(p_retailprice) AS BIGINT) AS video_views,
               CAST(p_size AS BIGINT) AS video_likes, length(p_type) AS video_comments
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY p_partkey, p_name, p_retailprice, p_size, p_type
        ORDER BY total_comments DESC""",
    "i6_author_activity": """
        SELECT o_orderkey AS comment_thread_id, c_name AS author_name,
               o_orderpriority AS comment_text, CAST(trunc(o_totalprice) AS BIGINT) AS comment_likes,
               CAST(length(o_orderpriority) AS INTEGER) AS total_reply_count,
               l_returnflag || '/' || l_linestatus AS reply_text,
               CAST(trunc(l_quantity) AS BIGINT) AS reply_likes, o_orderstatus AS video_id,
               o_orderdate AS published_at
        FROM orders LEFT JOIN customer ON c_custkey = nullif(o_custkey, 7)
        LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "i7_related_network": f"""{_FIGURES}
        SELECT p_partkey AS related_video_id, p_name AS related_video_title,
               p_size AS related_category_id, n_name AS related_category_name,
               video_id AS trending_video_id, title AS trending_video_title,
               views AS trending_video_views, p_brand AS channel_id
        FROM part JOIN t ON p_partkey = video_id JOIN nation ON n_nationkey = p_size""",
    "i8_tag_performance": f"""{_FIGURES},
        g AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS value FROM part)
        SELECT value, count(DISTINCT video_id) AS video_count, {_SUMS}
        FROM g JOIN t ON g.p_partkey = t.video_id GROUP BY value ORDER BY total_views DESC""",
}
SQL["incremental_growth"] = SQL["i4_channel_growth"]
SQL["incremental_comments"] = SQL["bucketed_insight"] = SQL["i5_comment_insights"]

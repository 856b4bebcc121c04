"""Insight jobs (I1-I8): functions of named golden frames.

Wherever a job groups after a join, the fact side is reduced to one row per join key
*before* the join (map-side combine, then one shuffle).  A channel or video with a third
of all rows is then one row when it meets its dimension.  The second grouping costs no
further shuffle: its input is already partitioned by the join key.  It keeps the result
exact should a dimension repeat a key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import left_join_fanout, lookup_join
from millrace.operators.quality import RuleBook, Watch, check_joins
from millrace.operators.rows import sort_by_metric
from millrace.plans.rules import join_rules
from millrace.sources.catalog import create_or_repair
from millrace.sources.tables import VersionedTable, stored_table

Frames = Mapping[str, DataFrame]


def video_performance(frames: Frames) -> DataFrame:
    """Every trending video with the name of its category."""
    categories = frames["categories"].select("category_id", "category_name")
    return lookup_join(frames["trending_videos"], categories, "category_id").select(
        "video_id",
        "channel_id",
        "category_id",
        "title",
        "views",
        "likes",
        "comments",
        "engagement_rate",
        "year",
        "category_name",
    )


def category_popularity(frames: Frames) -> DataFrame:
    """The same rows as I1, published under the category report's name."""
    return video_performance(frames)


def channel_engagement(frames: Frames) -> DataFrame:
    """Channel figures with country name, one row per trending video of the channel.

    Channel and country are joined first: both are small next to the videos, of which
    only the channel id is read.
    """
    countries = frames["countries"].select(
        "country_id", F.col("country").alias("country_name")
    )
    channels = (
        frames["channels"]
        .select(
            "channel_id",
            "channel_name",
            "country_id",
            "video_count",
            "subscribers",
            "total_views",
            "avg_views_per_video",
        )
        .join(countries, "country_id", "left")
    )
    return (
        frames["trending_videos"]
        .select("channel_id")
        .join(channels, "channel_id", "inner")
        .select(
            "channel_id",
            "channel_name",
            "country_id",
            "country_name",
            "video_count",
            "subscribers",
            "total_views",
            "avg_views_per_video",
        )
    )


def channel_growth(frames: Frames) -> DataFrame:
    """I4: totals of the trending videos of each channel."""
    totals = (
        frames["trending_videos"]
        .groupBy("channel_id")
        .agg(
            F.sum("views").alias("views"),
            F.sum("likes").alias("likes"),
            F.sum("comments").alias("comments"),
            F.sum("engagement_rate").alias("rate_sum"),
            F.count("engagement_rate").alias("rate_count"),
            F.count_distinct("video_id").alias("videos"),
        )
    )
    channels = frames["channels"].select("channel_id", "channel_name")
    return (
        totals.join(channels, "channel_id", "inner")
        .groupBy("channel_id", "channel_name")
        .agg(
            F.sum("views").alias("total_views"),
            F.sum("likes").alias("total_likes"),
            F.sum("comments").alias("total_comments"),
            F.try_divide(F.sum("rate_sum"), F.sum("rate_count")).alias("avg_engagement_rate"),
            F.max("videos").alias("total_videos"),
        )
    )


def comment_insights(frames: Frames) -> DataFrame:
    """Comments, likes and authors per trending video, most commented first."""
    per_video = (
        frames["comment_threads"]
        .groupBy("video_id")
        .agg(
            F.count("comment_thread_id").alias("threads"),
            F.sum("comment_likes").alias("thread_likes"),
            F.count_distinct("author_id").alias("authors"),
        )
    )
    videos = frames["trending_videos"].select(
        "video_id",
        F.col("title").alias("video_title"),
        F.col("views").alias("video_views"),
        F.col("likes").alias("video_likes"),
        F.col("comments").alias("video_comments"),
    )
    attributes = ["video_title", "video_views", "video_likes", "video_comments"]
    metrics = (
        per_video.join(videos, "video_id", "inner")
        .groupBy("video_id", *attributes)
        .agg(
            F.sum("threads").alias("total_comments"),
            F.sum("thread_likes").alias("total_likes"),
            F.max("authors").alias("unique_authors"),
        )
        .select("video_id", "total_comments", "total_likes", "unique_authors", *attributes)
    )
    return sort_by_metric(metrics, "total_comments", "video_id")


def author_activity(frames: Frames) -> DataFrame:
    """Every comment thread with its author and each of its replies."""
    authors = frames["authors"].select("author_id", "author_name")
    replies = frames["replies"].select("comment_thread_id", "reply_text", "reply_likes")
    threads = (
        frames["comment_threads"]
        .select(
            "comment_thread_id",
            "author_id",
            "comment_text",
            "comment_likes",
            "total_reply_count",
            "video_id",
            "published_at",
        )
        .join(authors, "author_id", "left")
    )
    return left_join_fanout(threads, replies, ["comment_thread_id"]).select(
        "comment_thread_id",
        "author_name",
        "comment_text",
        "comment_likes",
        "total_reply_count",
        "reply_text",
        "reply_likes",
        "video_id",
        "published_at",
    )


def related_network(frames: Frames) -> DataFrame:
    """Related videos that are trending themselves, with the related side's category."""
    related = frames["related_videos"].select(
        F.col("video_id").alias("related_video_id"),
        F.col("title").alias("related_video_title"),
        F.col("category_id").alias("related_category_id"),
        "channel_id",
    )
    trending = frames["trending_videos"].select(
        F.col("video_id").alias("trending_video_id"),
        F.col("title").alias("trending_video_title"),
        F.col("views").alias("trending_video_views"),
    )
    categories = frames["categories"].select(
        F.col("category_id").alias("related_category_id"),
        F.col("category_name").alias("related_category_name"),
    )
    return (
        lookup_join(related, categories, "related_category_id")
        .join(trending, F.col("related_video_id") == F.col("trending_video_id"), "inner")
        .select(
            "related_video_id",
            "related_video_title",
            "related_category_id",
            "related_category_name",
            "trending_video_id",
            "trending_video_title",
            "trending_video_views",
            "channel_id",
        )
    )


def tag_performance(frames: Frames) -> DataFrame:
    """I8: totals of the trending videos that carry each tag, most viewed first.

    Both sides are reduced before the join: one row per video, and one per video and tag
    with the number of times it occurs.  Counting videos then needs no DISTINCT after the
    join, which would bind the grouping to the join's partitioning and keep adaptive
    execution from splitting a video with very many tags.
    """
    videos = (
        frames["trending_videos"]
        .groupBy("video_id")
        .agg(
            F.sum("views").alias("views"),
            F.sum("likes").alias("likes"),
            F.sum("comments").alias("comments"),
            F.sum("engagement_rate").alias("rate_sum"),
            F.count("engagement_rate").alias("rate_count"),
        )
    )
    tags = frames["tags"].groupBy("video_id", "value").agg(F.count(F.lit(1)).alias("times"))

    def total(name: str) -> Column:
        return F.sum(F.col("times") * F.col(name))

    metrics = (
        tags.join(videos, "video_id", "inner")
        .groupBy("value")
        .agg(
            F.count("video_id").alias("video_count"),
            total("views").alias("total_views"),
            total("likes").alias("total_likes"),
            total("comments").alias("total_comments"),
            F.try_divide(total("rate_sum"), total("rate_count")).alias("avg_engagement_rate"),
        )
    )
    return sort_by_metric(metrics, "total_views", "value")


INSIGHTS: dict[str, Callable[[Frames], DataFrame]] = {
    "video_performance_metrics": video_performance,
    "category_popularity_metrics": category_popularity,
    "channel_engagement_metrics": channel_engagement,
    "channel_growth_metrics": channel_growth,
    "comment_insights": comment_insights,
    "author_activity_metrics": author_activity,
    "related_videos_network": related_network,
    "tag_performance_metrics": tag_performance,
}

# The golden tables each job reads, by the name the job knows them under.
DEPENDENCIES: dict[str, dict[str, str]] = {
    "video_performance_metrics": {
        "trending_videos": "trending_videos/current",
        "categories": "categories",
    },
    "category_popularity_metrics": {
        "trending_videos": "trending_videos/current",
        "categories": "categories",
    },
    "channel_engagement_metrics": {
        "channels": "channels/current",
        "countries": "countries",
        "trending_videos": "trending_videos/current",
    },
    "channel_growth_metrics": {
        "channels": "channels/current",
        "trending_videos": "trending_videos/current",
    },
    "comment_insights": {
        "comment_threads": "comment_threads/current",
        "trending_videos": "trending_videos/current",
    },
    "author_activity_metrics": {
        "authors": "authors",
        "comment_threads": "comment_threads/current",
        "replies": "replies/current",
    },
    "related_videos_network": {
        "related_videos": "related_category_videos/current",
        "categories": "categories",
        "trending_videos": "trending_videos/current",
    },
    "tag_performance_metrics": {
        "tags": "tags",
        "trending_videos": "trending_videos/current",
    },
}

# Fixed values (ST7): the finish events that each job waits for, as a mapping file has them.
TRIGGERS: dict[str, str] = {
    "categories_done,channels_basic_information_done,trending_videos_done": "video_performance_metrics",
    "channels_done,countries_done,trending_videos_done": "channel_engagement_metrics",
    "categories_done,trending_videos_done": "category_popularity_metrics",
    "authors_done,comment_threads_done,replies_done": "author_activity_metrics",
    "related_category_videos_done,categories_done,trending_videos_done": "related_videos_network",
    "channels_done,trending_videos_done": "channel_growth_metrics",
    "tags_done,trending_videos_done": "tag_performance_metrics",
    "comment_threads_done,trending_videos_done": "comment_insights",
}


def read_golden(spark: SparkSession, root: str, needed: Mapping[str, str]) -> Frames:
    """The current version of each golden table; an absent table is an error."""
    frames = {}
    for name, path in needed.items():
        frame = stored_table(spark, f"{root}/{path}").read()
        if frame is None:
            raise ValueError(f"golden table {path!r} does not exist")
        frames[name] = frame
    return frames


@dataclass(frozen=True)
class Checked:
    """Q5, Q8: what the rules found when an insight was published."""

    rules: DataFrame | None
    joins: DataFrame | None

    def failed(self) -> list[str]:
        found = [] if self.rules is None else [f"{r['column']}.{r['check']}" for r in self.rules.collect() if not r["passed"]]
        if self.joins is not None:
            found += [f"{r['source_table']}-{r['target_table']}.{r['keys']}" for r in self.joins.collect() if not r["passed"]]
        return found


def check_insight(frames: Frames, name: str, watch: Watch | None, written: DataFrame | None, book: RuleBook) -> Checked:
    """The rules on a job's result, measured as it was written, and the join rules between its tables."""
    joins = check_joins(frames, [*join_rules(name), *book.joins_of(frames)])
    if joins is not None:  # a row for each rule
        joins = joins.sparkSession.createDataFrame(joins.collect(), joins.schema)
    return Checked(watch.report(written) if watch else None, joins)


def publish(
    spark: SparkSession,
    name: str,
    golden: str,
    path: str,
    database: str | None = None,
    book: RuleBook | None = None,
    blocking: bool = False,
    report: str | None = None,
) -> VersionedTable:
    """Run one insight job: read its golden tables, replace its result at ``path`` and, with
    ``database``, enter it in the catalog under ``name``.

    With a rule book, its rules on the result are measured while it is written, and the join rules between the
    job's tables are checked; results are added below ``report``.  ``blocking`` keeps a result with a failed rule from
    taking the place of the one before.
    """
    frames = read_golden(spark, golden, DEPENDENCIES[name])
    result = INSIGHTS[name](frames)
    stored = VersionedTable(spark, path)
    if book is None:
        stored.replace(result)
    else:
        watch = Watch(result, book.rules(name), name)

        def check(written: DataFrame) -> None:
            found = check_insight(frames, name, watch, written, book)
            if report is not None:
                found.rules.write.mode("append").parquet(f"{report.rstrip('/')}/rules")
                if found.joins is not None:
                    found.joins.write.mode("append").parquet(f"{report.rstrip('/')}/joins")
            failed = found.failed()
            if blocking and failed:
                raise ValueError(f"blocking quality rules fail: {failed}")

        stored.replace(watch.frame, check=check)
    if database is not None:
        location, _ = stored.place()
        create_or_repair(spark, database, name, result.schema, location)
    return stored

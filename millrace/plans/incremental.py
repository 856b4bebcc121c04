"""Insight jobs kept up to date batch by batch.

Of each batch of facts a partial result is kept: sums, and the distinct values as bits of
their dense numbers, ``WORD`` of them to a row, so that there never are more rows than groups have distinct
values.  (Spark's bitmap aggregates keep 4 KB for each group and bucket, however few of its bits are set.)
Partial results merge, so the figures over all batches come from the partial
ones alone, and a new batch costs a pass over that batch.  A batch that is added again
takes the place of its first attempt.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.rows import sort_by_metric
from millrace.sources.ids import DenseIds
from millrace.sources.tables import AppendTable, staged


#: Bits of a long.
WORD = 64


class Partials:
    """Sums and exact distinct counts per group over batches of rows.

    ``sums`` names aggregates by the columns they add up, ``counted`` those of which the values
    that aren't null are counted, ``distinct`` the column whose distinct values are.  Sums lie in ``totals``, a row for each
    group and batch, and bits in ``parts``; a batch that dies between the two is to be added again, as any that dies.
    """

    def __init__(
        self, spark: SparkSession, path: str, group: str, distinct: str, sums: Mapping[str, str], counted: Mapping[str, str]
    ) -> None:
        self.group, self.distinct, self.sums, self.counted = group, distinct, dict(sums), dict(counted)
        self.ids = DenseIds(spark, f"{path}/ids")
        self.parts = AppendTable(spark, f"{path}/partials")
        self.totals = AppendTable(spark, f"{path}/totals")

    def add(self, facts: DataFrame, batch: str) -> None:
        """Keep the partial result of one batch of rows."""
        columns = list(dict.fromkeys([self.group, self.distinct, *self.sums.values(), *self.counted.values()]))
        with staged(facts.select(*columns), "facts") as rows:
            sums = [F.sum(c).alias(n) for n, c in self.sums.items()]
            counts = [F.count(c).alias(n) for n, c in self.counted.items()]
            self.totals.append(rows.groupBy(self.group).agg(*sums, *counts), batch)
            numbered = self.ids.number(rows.select(self.group, self.distinct), self.distinct, "_number")
            # a value that is null has no number, and counts as none
            place, bit = F.floor(F.col("_number") / WORD), F.expr(f"shiftleft(1L, CAST(_number % {WORD} AS INT))")
            words = numbered.where("_number IS NOT NULL").groupBy(self.group, place.alias("word")).agg(F.bit_or(bit).alias("bits"))
            self.parts.append(words, batch)

    def _words(self) -> DataFrame:
        return self.parts.read().groupBy(self.group, "word").agg(F.bit_or("bits").alias("bits"))

    def _sums(self, *more: str) -> list[Column]:
        return [F.sum(n).alias(n) for n in (*self.sums, *self.counted, *more)]

    def merged(self, distinct_as: str) -> DataFrame:
        """One row per group over all batches, the number of distinct values as ``distinct_as``."""
        totals = self.totals.read()
        if totals is None:
            raise ValueError("no batch has been added")
        values = self._words().groupBy(self.group).agg(F.sum(F.bit_count("bits")).alias(distinct_as))
        both = totals.withColumn(distinct_as, F.lit(0).cast("long")).unionByName(values, allowMissingColumns=True)
        return both.groupBy(self.group).agg(*self._sums(distinct_as))

    def compact(self, batch: str) -> None:
        """Put one merged partial result in place of all there are; ``batch`` names it."""
        totals = self.totals.read()
        if totals is None:
            return
        for table, merged in ((self.totals, totals.groupBy(self.group).agg(*self._sums())), (self.parts, self._words())):
            with staged(merged, "compacted") as rows:
                table.replace(rows, batch)


class ChannelGrowth:
    """I4 over batches of trending videos; equal to :func:`~millrace.plans.insights.channel_growth` over all."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.partials = Partials(
            spark, path, "channel_id", "video_id",
            {"views": "views", "likes": "likes", "comments": "comments", "rate_sum": "engagement_rate"},
            {"rate_count": "engagement_rate"},
        )

    def add(self, trending_videos: DataFrame, batch: str) -> None:
        self.partials.add(trending_videos, batch)

    def result(self, channels: DataFrame) -> DataFrame:
        totals = self.partials.merged("videos")
        return (
            totals.join(channels.select("channel_id", "channel_name"), "channel_id", "inner")
            .groupBy("channel_id", "channel_name")
            .agg(
                F.sum("views").alias("total_views"),
                F.sum("likes").alias("total_likes"),
                F.sum("comments").alias("total_comments"),
                F.try_divide(F.sum("rate_sum"), F.sum("rate_count")).alias("avg_engagement_rate"),
                F.max("videos").alias("total_videos"),
            )
        )


class CommentInsights:
    """I5 over batches of comment threads; equal to :func:`~millrace.plans.insights.comment_insights` over all."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.partials = Partials(
            spark, path, "video_id", "author_id", {"thread_likes": "comment_likes"}, {"threads": "comment_thread_id"}
        )

    def add(self, comment_threads: DataFrame, batch: str) -> None:
        self.partials.add(comment_threads, batch)

    def result(self, trending_videos: DataFrame) -> DataFrame:
        attributes = {"video_title": "title", "video_views": "views", "video_likes": "likes", "video_comments": "comments"}
        videos = trending_videos.select("video_id", *[F.col(c).alias(n) for n, c in attributes.items()])
        metrics = (
            self.partials.merged("authors")
            .join(videos, "video_id", "inner")
            .groupBy("video_id", *attributes)
            .agg(
                F.sum("threads").alias("total_comments"),
                F.sum("thread_likes").alias("total_likes"),
                F.max("authors").alias("unique_authors"),
            )
            .select("video_id", "total_comments", "total_likes", "unique_authors", *attributes)
        )
        return sort_by_metric(metrics, "total_comments", "video_id")

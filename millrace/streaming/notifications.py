"""Object notifications: parse and route (ST1, ST2, S11)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.paths import decode_key, last_segment, path_part

# The notification's shape, the event that is acted on, and the marks in keys.
NOTIFICATION = (
    "EventName string, "
    "Records array<struct<s3:struct<bucket:struct<name:string>, object:struct<key:string>>>>"
)
CREATED = "s3:ObjectCreated:Put"
TABLE_LOG_MARK = "_delta_log"
UNKNOWN = "Unknown"


def read_events(
    spark: SparkSession, path: str, schema: str | None = None, **options
) -> DataFrame:
    """A stream of JSON files from the first one on, one message per line: its
    text in ``value``, or its fields when a ``schema`` is given."""
    if schema is None:
        return spark.readStream.options(**options).text(path)
    return spark.readStream.options(**options).schema(schema).json(path)


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The same from a topic, from the earliest message on.  Needs Spark's Kafka
    connector on the class path; the query's checkpoint keeps the offsets."""
    topics = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    topics = topics.option("subscribe", topic).option("startingOffsets", "earliest")
    return topics.options(**options).load().select(F.col("value").cast("string").alias("value"))


def parse_notifications(messages: DataFrame, value: str = "value") -> DataFrame:
    """ST1: event name, bucket and key of the first record; absent parts are ``Unknown``."""
    event = F.from_json(F.col(value).cast("string"), NOTIFICATION)
    record = F.get(event["Records"], 0)["s3"]
    return messages.select(
        F.coalesce(event["EventName"], F.lit(UNKNOWN)).alias("event_name"),
        F.coalesce(record["bucket"]["name"], F.lit(UNKNOWN)).alias("bucket_name"),
        F.coalesce(record["object"]["key"], F.lit(UNKNOWN)).alias("object_key"),
    )


def _reason(tables: Iterable[str] | None) -> Column:
    key = F.col("object_key")
    reason = (
        F.when(key.contains(TABLE_LOG_MARK), "table log file")
        .when(F.col("event_name") != CREATED, "unhandled event")
        .when(~(key.contains("raw") & key.endswith(".json")), "not a control file")
        .when(F.size(F.split("decoded", "/")) < 3, "fewer than 3 path parts")
    )
    if tables is not None:
        known = path_part("decoded", 2).isin(sorted(tables))
        reason = reason.when(~known, "no pipeline for this table")
    return reason


def route_notifications(events: DataFrame, tables: Iterable[str] | None = None) -> DataFrame:
    """ST2: every parsed notification with its ``reject_reason`` (null: a work request).

    A work request is the creation of a ``.json`` below a raw zone; source, database and
    table are the first three parts of the decoded key.  With ``tables``, the names there
    is a pipeline for, other tables are rejected.
    """
    routed = events.withColumn("decoded", decode_key("object_key")).withColumn(
        "reject_reason", _reason(tables)
    )
    accepted = F.col("reject_reason").isNull()
    parts = {
        name: F.when(accepted, path_part("decoded", i))
        for i, name in enumerate(("source_system", "database", "table"))
    }
    return routed.select(
        "event_name",
        "bucket_name",
        F.col("decoded").alias("object_key"),
        *[column.alias(name) for name, column in parts.items()],
        "reject_reason",
    )


def work_requests(events: DataFrame, tables: Iterable[str] | None = None) -> DataFrame:
    """ST2: the accepted notifications only."""
    routed = route_notifications(events, tables)
    return routed.filter("reject_reason IS NULL").drop("reject_reason")


def with_outcome(routed: DataFrame) -> DataFrame:
    """Requests and rejects apart: write the result with ``partition_by=["outcome"]`` and
    one pass over the stream fills two folders."""
    outcome = F.when(F.col("reject_reason").isNull(), "request").otherwise("reject")
    return routed.withColumn("outcome", outcome)


def golden_requests(events: DataFrame) -> DataFrame:
    """ST2, golden side: dataset name (file name up to the first dot) of objects in a golden
    zone at least three parts deep."""
    return (
        events.withColumn("decoded", decode_key("object_key"))
        .filter(F.col("decoded").contains("golden") & (F.size(F.split("decoded", "/")) >= 3))
        .select(
            "event_name",
            "bucket_name",
            F.col("decoded").alias("object_key"),
            F.get(F.split(last_segment("decoded"), r"\."), 0).alias("dataset_name"),
        )
    )

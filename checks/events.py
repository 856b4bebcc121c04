"""Ledger, notifications and readiness over the event and page tables.

An event is read as a message: its type is the component that finished, its user the
batch it belongs to, and a value below 5 a failure.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from checks.tables import table
from millrace.sources.files import work_folder, write_text
from millrace.sources.ledger import dependencies_ready, latest_status
from millrace.streaming import notifications as n
from millrace.streaming import readiness as rd
from millrace.streaming import rounds
from millrace.streaming.rounds import FIRED, PROVIDER, ReadinessLoop

# Which targets wait for which events.
MAPPING = {
    "click,view": "engagement",
    "purchase,signup": "conversion",
    "error,click,view": "health",
}


def _messages(events):
    return events.select(
        F.col("user_id").cast("string").alias("batch_id"),
        F.col("event_type").alias("finish_event"),
        F.col("event_type").alias("dataset"),
        F.when(F.col("value") < 5, "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("ts").cast("timestamp").alias("at"),
        F.col("event_id").alias("id"),
    )


def latest_statuses(spark, d):
    """A8 K18"""
    return latest_status(_messages(table(spark, d, "events")), ["batch_id", "dataset"])


def dependency_tables(spark, d):
    """ST6: a user's datasets are its event types; a target is ready when all succeeded"""
    ledger = _messages(table(spark, d, "events")).withColumn(
        "dataset", F.concat_ws("/", "batch_id", "dataset")
    )
    tables = ledger.select(F.split_part("dataset", F.lit("/"), F.lit(1)).alias("target"), "dataset")
    return dependencies_ready(ledger, tables.distinct())


def readiness_batch(spark, d):
    """ST3 ST7 J10 U3 on a frame"""
    mapping = rd.mapping_rows(spark, rd.load_mapping(MAPPING))
    return rd.ready_targets(_messages(table(spark, d, "events")), mapping)


def readiness_stream(spark, d):
    """ST3 S10 as a stream over the same events"""
    schema = table(spark, d, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    )
    folder = work_folder(spark, "readiness")
    fired = rd.readiness_stream(_messages(events), rd.load_mapping(MAPPING))
    rd.run_available(fired, f"{folder}/checkpoint", f"{folder}/fired")
    return spark.read.schema("batch_id string, target string").parquet(f"{folder}/fired")


def readiness_rounds(spark, d):
    """ST3 ST4 as a stream with rounds: all messages in one trigger, so each pair fires in the first"""
    schema = table(spark, d, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    )
    folder, key = work_folder(spark, "rounds"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        fired = rounds.readiness_rounds(_messages(events), rd.load_mapping(MAPPING))
        rd.run_available(fired, f"{folder}/checkpoint", f"{folder}/fired")
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(FIRED).parquet(f"{folder}/fired")


def readiness_loop(spark, d):
    """ST7 J10 ST3: two triggers over the halves of the events; the second one meets a mapping with one more target"""
    folder = work_folder(spark, "loop")
    loop = ReadinessLoop(spark, folder, f"{folder}/targets.json", buckets=8)
    for half in (1, 0):
        write_text(spark, loop.mapping, json.dumps({e: t for e, t in MAPPING.items() if not half or t != "health"}))
        part = table(spark, d, "events").filter(F.pmod(F.col("event_id"), F.lit(2)) == half)
        part.write.parquet(f"{folder}/events/{half}")
        events = spark.readStream.schema(part.schema).parquet(f"{folder}/events/*")
        loop.follow(_messages(events), f"{folder}/checkpoint")
    return loop.fired.read().select("batch_id", "target")


def event_validation(spark, d):
    """ST5"""
    kind = F.col("event_type")
    event = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("batch_id"),
            F.when(kind != "signup", kind).alias("finish_event"),
            F.when(kind == "purchase", "").otherwise(kind).alias("dataset"),
            F.lit("COMPLETED").alias("status"),
            F.when(F.col("value") < 2, "soon").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        )
    )
    value = (
        F.when((kind == "error") & (F.col("value") < 10), F.concat(F.lit("["), event, F.lit("]")))
        .when(kind == "error", F.lit("{broken"))
        .otherwise(event)
    )
    messages = table(spark, d, "events").select(value.alias("value"))
    return rd.validate_events(messages).groupBy("finish_event", "dataset", "reject_reason").count()


def _notifications(spark, d):
    """Every page as an object notification: hosts as sources, paths as keys."""
    path = F.regexp_replace("url", "^https?://", "")
    key = (
        F.when(F.col("url").startswith("https"), F.concat(path, F.lit("/raw/control.json")))
        .when(F.col("url").contains("blog"), F.lit("raw.json"))
        .otherwise(F.concat(path, F.lit("/golden/part-0.snappy.parquet")))
    )
    encoded = F.replace(F.replace(key, F.lit("/"), F.lit("%2F")), F.lit("?"), F.lit("%3F"))
    record = F.struct(
        F.struct(
            F.struct(F.lit("lake").alias("name")).alias("bucket"),
            F.struct(encoded.alias("key")).alias("object"),
        ).alias("s3")
    )
    message = F.struct(
        F.when(F.col("url").contains("page="), "s3:ObjectRemoved:Delete")
        .when(F.col("url").contains("spam"), F.lit(None))
        .otherwise("s3:ObjectCreated:Put")
        .alias("EventName"),
        F.array(record).alias("Records"),
    )
    pages = table(spark, d, "pages").select(F.to_json(message).alias("value"))
    return n.parse_notifications(pages)


def url_route(spark, d):
    """ST1 ST2 F13 S11"""
    return n.route_notifications(_notifications(spark, d))


def url_requests(spark, d):
    """ST2, work requests only"""
    return n.work_requests(_notifications(spark, d))


def golden_route(spark, d):
    """ST2, golden side"""
    return n.golden_requests(_notifications(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        latest_statuses,
        dependency_tables,
        readiness_batch,
        readiness_stream,
        readiness_rounds,
        readiness_loop,
        event_validation,
        url_route,
        url_requests,
        golden_route,
    )
}

_NEWEST = """
    newest AS (SELECT CAST(user_id AS VARCHAR) AS batch_id, event_type AS dataset,
        arg_max(CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCESS' END, (ts, event_id)) AS status
        FROM events GROUP BY ALL)"""
_READY = f"""
    WITH {_NEWEST},
    m(target, event, need) AS (VALUES ('engagement', 'click', 2), ('engagement', 'view', 2),
        ('conversion', 'purchase', 2), ('conversion', 'signup', 2), ('health', 'error', 3),
        ('health', 'click', 3), ('health', 'view', 3))
    SELECT batch_id, target FROM newest JOIN m ON event = dataset WHERE status = 'SUCCESS'
    GROUP BY batch_id, target, need HAVING count(*) = need"""
_ROUTED = """
    WITH p AS (SELECT url, regexp_replace(url, '^https?://', '') AS path FROM pages),
    k AS (SELECT CASE WHEN url LIKE 'https%' THEN path || '/raw/control.json'
                      WHEN contains(url, 'blog') THEN 'raw.json'
                      ELSE path || '/golden/part-0.snappy.parquet' END AS object_key,
                 CASE WHEN contains(url, 'page=') THEN 's3:ObjectRemoved:Delete'
                      WHEN contains(url, 'spam') THEN 'Unknown'
                      ELSE 's3:ObjectCreated:Put' END AS event_name FROM p),
    r AS (SELECT *, string_split(object_key, '/') AS parts,
            CASE WHEN event_name <> 's3:ObjectCreated:Put' THEN 'unhandled event'
                 WHEN NOT (contains(object_key, 'raw') AND object_key LIKE '%.json')
                 THEN 'not a control file'
                 WHEN len(string_split(object_key, '/')) < 3
                 THEN 'fewer than 3 path parts' END AS reject_reason FROM k)"""

SQL = {
    "latest_statuses": f"WITH {_NEWEST} SELECT * FROM newest",
    "dependency_tables": f"""WITH {_NEWEST}
        SELECT batch_id AS target, bool_and(status = 'SUCCESS') AS ready
        FROM newest GROUP BY batch_id""",
    "readiness_batch": _READY,
    "readiness_stream": _READY,
    "readiness_rounds": f"SELECT batch_id, CAST(0 AS BIGINT) AS round, target FROM ({_READY})",
    "readiness_loop": f"""
        SELECT batch_id, target FROM ({_READY.replace("FROM events", "FROM events WHERE event_id % 2 = 1")})
        WHERE target <> 'health'
        UNION SELECT batch_id, target FROM ({_READY})""",
    "event_validation": """
        SELECT CASE WHEN event_type NOT IN ('signup', 'error') THEN event_type END AS finish_event,
               CASE WHEN event_type = 'purchase' THEN ''
                    WHEN event_type <> 'error' THEN event_type END AS dataset,
               CASE event_type WHEN 'error' THEN 'not a JSON object'
                    WHEN 'signup' THEN 'finish_event is missing'
                    WHEN 'purchase' THEN 'dataset is missing'
                    ELSE CASE WHEN value < 2 THEN 'timestamp is missing or no time' END
               END AS reject_reason,
               count(*) AS count
        FROM events GROUP BY ALL""",
    "url_route": f"""{_ROUTED}
        SELECT event_name, 'lake' AS bucket_name, object_key,
               CASE WHEN reject_reason IS NULL THEN parts[1] END AS source_system,
               CASE WHEN reject_reason IS NULL THEN parts[2] END AS database,
               CASE WHEN reject_reason IS NULL THEN parts[3] END AS "table", reject_reason
        FROM r""",
    "url_requests": f"""{_ROUTED}
        SELECT event_name, 'lake' AS bucket_name, object_key, parts[1] AS source_system,
               parts[2] AS database, parts[3] AS "table" FROM r WHERE reject_reason IS NULL""",
    "golden_route": f"""{_ROUTED}
        SELECT event_name, 'lake' AS bucket_name, object_key, 'part-0' AS dataset_name
        FROM r WHERE contains(object_key, 'golden') AND len(parts) >= 3""",
}

"""When are a derived dataset's inputs complete? (ST3-ST7)

A message says that a component reached a status: ``(batch_id, finish_event, dataset,
status, at, id)``.  A target fires, once per batch, when the newest status of each of its
events is SUCCESS.  :func:`ready_targets` answers this for a batch frame with two
aggregates; :func:`readiness_stream` keeps the newest statuses as checkpointed state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from millrace.sources.files import exists, read_text

#: Statuses that end a component well: in the ledger, and in finish events.
DONE = ("SUCCESS", "COMPLETED")
MESSAGE = (
    "batch_id string, finish_event string, dataset string, status string, "
    "at timestamp, id bigint"
)


def load_mapping(source: str | Mapping[str, str], spark: SparkSession | None = None):
    """ST7: ``{"e1,e2": target}`` as ``{target: (e1, e2)}``.

    ``source`` is the map, or the path of a JSON file with it; a file that is absent or is
    not JSON gives an empty map.
    """
    if isinstance(source, str):
        if not exists(spark, source):
            return {}
        try:
            source = json.loads(read_text(spark, source))
        except json.JSONDecodeError:
            return {}
    mapping: dict[str, tuple[str, ...]] = {}
    for events, target in source.items():
        needed = tuple(dict.fromkeys(e.strip() for e in events.split(",") if e.strip()))
        if not needed or not target or target in mapping:
            raise ValueError(f"bad mapping entry {events!r} -> {target!r}")
        mapping[target] = needed
    return mapping


def check_mapping(mapping: Mapping[str, tuple[str, ...]], known_events: set[str]) -> None:
    """Every event a target waits for must be one that some output sends."""
    unknown = sorted({e for needed in mapping.values() for e in needed} - known_events)
    if unknown:
        raise ValueError(f"the mapping waits for events nobody sends: {unknown}")


def mapping_rows(spark: SparkSession, mapping: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """ST7: rows ``(target, finish_event, need)``; as many as the config file has names."""
    rows = [
        F.struct(
            F.lit(target).alias("target"),
            F.lit(event).alias("finish_event"),
            F.lit(len(needed)).alias("need"),
        )
        for target, needed in mapping.items()
        for event in needed
    ]
    if not rows:
        return spark.createDataFrame([], "target string, finish_event string, need int")
    return spark.range(1).select(F.inline(F.array(*rows)))


def validate_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """ST5: messages as columns, with ``reject_reason`` for those that cannot be used.

    ``id`` is a hash of the message, so that of two with one time the same one counts as
    newest wherever they are read.
    """
    event = F.from_json(
        F.col(value).cast("string"),
        "batch_id string, finish_event string, dataset string, status string, "
        "timestamp string, _corrupt string",
        {"columnNameOfCorruptRecord": "_corrupt"},
    )
    parsed = messages.select(event.alias("e"), F.col(value).cast("string").alias("message"))
    blank = {
        name: F.coalesce(F.col(f"e.{name}"), F.lit("")) == ""
        for name in ("finish_event", "dataset")
    }
    at = F.col("e.timestamp").try_cast("timestamp")
    bad = F.col("e").isNull() | F.col("e._corrupt").isNotNull()
    bad = bad | ~F.ltrim("message").startswith("{")
    return parsed.select(
        "e.batch_id",
        "e.finish_event",
        "e.dataset",
        "e.status",
        at.alias("at"),
        F.xxhash64("message").alias("id"),
        F.when(bad, "not a JSON object")
        .when(blank["finish_event"], "finish_event is missing")
        .when(blank["dataset"], "dataset is missing")
        .when(at.isNull(), "timestamp is missing or no time")
        .alias("reject_reason"),
        "message",
    )


def needed_by(events: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each event with every target that waits for it.  The mapping's rows are in the
    plan itself, so Spark knows their size and broadcasts them without a hint."""
    return events.join(mapping, "finish_event", "inner")


def ready_targets(messages: DataFrame, mapping: DataFrame) -> DataFrame:
    """ST3 on a batch frame: ``(batch_id, target)`` whose events' newest status is done.

    A message without a time is older than any with one.
    """
    newest = messages.groupBy("batch_id", "finish_event").agg(
        F.max_by("status", F.struct("at", "id")).alias("status")
    )
    return (
        needed_by(newest.filter(F.col("status").isin(*DONE)), mapping)
        .groupBy("batch_id", "target", "need")
        .agg(F.count(F.lit(1)).alias("have"))
        .filter("have = need")
        .select("batch_id", "target")
    )


def newest_per_task(messages: DataFrame) -> DataFrame:
    """Cut a stream to the newest message per batch and event within each Arrow batch of a task.

    A streaming query has no map-side combine before a state operator, so this is it: a
    batch id with a third of all messages sends some rows per event and task to its state.
    """
    columns = ["batch_id", "finish_event", "dataset", "status", "at", "id"]

    def reduce_task(frames: Iterator) -> Iterator:
        for frame in frames:
            newest = frame.sort_values(["at", "id"], na_position="first")
            yield newest.drop_duplicates(["batch_id", "finish_event"], keep="last")

    return messages.select(*columns).mapInPandas(reduce_task, MESSAGE)


def readiness_stream(
    messages: DataFrame, mapping: Mapping[str, tuple[str, ...]]
) -> DataFrame:
    """ST3: a stream of ``(batch_id, target)``, each pair once.

    State per batch id: the newest ``(at, id, status)`` of each event that some target waits
    for, and the targets that fired.  It is kept, so that a message counts however late it
    is and no pair fires twice; ``mapping`` bounds its size, and there is one for each run of
    the pipelines.
    """
    needs = {t: list(e) for t, e in mapping.items()}
    wanted = sorted({e for events in needs.values() for e in events})

    def update(key, frames, state):
        import json as js

        import pandas as pd

        seen, fired = [js.loads(s) for s in state.get] if state.exists else ({}, [])
        for frame in frames:
            for event, status, at, number in zip(
                frame["finish_event"], frame["status"], frame["at"], frame["id"]
            ):
                time = -(1 << 63) if pd.isna(at) else int(pd.Timestamp(at).value)
                stamp = [time, int(number)]
                if event not in seen or stamp >= seen[event][:2]:
                    seen[event] = [*stamp, status]
        done = {event for event, (_, _, status) in seen.items() if status in DONE}
        new = [t for t, events in needs.items() if t not in fired and done.issuperset(events)]
        state.update((js.dumps(seen), js.dumps(fired + new)))
        if new:
            yield pd.DataFrame({"batch_id": [key[0]] * len(new), "target": new})

    return (
        newest_per_task(messages.filter(F.col("finish_event").isin(wanted)))
        .groupBy("batch_id")
        .applyInPandasWithState(
            update,
            "batch_id string, target string",
            "seen string, fired string",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


def run_available(
    stream: DataFrame, checkpoint: str, path: str, partition_by: list[str] | None = None
) -> None:
    """Run a stream over all input there is and stop; results are added to ``path``.

    The file sink notes finished epochs, so a restart neither loses nor repeats rows.  Batches without data are off,
    as state with a time to live asks for another one after each, without end; what has expired is not read anyway.
    """
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        query = _start(stream, checkpoint, path, partition_by)
    finally:
        conf.set(key, before)
    query.awaitTermination()


def _start(stream: DataFrame, checkpoint: str, path: str, partition_by: list[str] | None):
    return (
        stream.writeStream.format("parquet")
        .partitionBy(*(partition_by or []))
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

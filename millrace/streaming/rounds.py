"""Readiness in keyed state with rounds and a time to live (ST3, ST4), and over a mapping that changes (ST7, J10).

:func:`readiness_rounds` keeps for each batch id the newest status of each event and the targets that fired in
this round.  When all targets have fired the round is over: the state of that batch id is dropped, and what
arrives later begins the next one.  A state that nothing has changed for ``ttl`` expires.

:class:`ReadinessLoop` keeps the same in two tables bucketed by batch id, and reads the mapping anew in each
trigger: a target that is added fires for the batch ids whose events are complete already.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.sources.files import exists, read_text, write_text
from millrace.sources.tables import AppendTable, BucketedTable, staged
from millrace.streaming.readiness import DONE, load_mapping, mapping_rows, newest_per_task, ready_targets

#: What state stores with keyed state need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIRED = "batch_id string, round long, target string"


class _Rounds(StatefulProcessor):
    """State of a batch id is one value, read and written once in a trigger: each call to a state costs
    a round trip to the JVM, and there are as many batch ids as runs."""

    def __init__(self, needs: Mapping[str, tuple[str, ...]], ttl_ms: int | None) -> None:
        self.needs = {t: list(e) for t, e in needs.items()}
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # as JSON: for each event its newest time, id, status and when it came, for each target that fired when it did
        self.seen = handle.getValueState("seen", "events string, fired string", self.ttl_ms)
        self.round = handle.getValueState("round", "number long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0
        seen, fired = (json.loads(text) for text in self.seen.get() or ("{}", "{}"))
        if self.ttl_ms:  # each event and target expires by itself
            seen = {event: v for event, v in seen.items() if v[3] + self.ttl_ms > now}
            fired = {target: at for target, at in fired.items() if at + self.ttl_ms > now}
        for row in rows:
            stamp = [-(1 << 63) if row.at is None else row.at, row.id]
            known = seen.get(row.finish_event)
            if known is None or stamp >= known[:2]:
                seen[row.finish_event] = [*stamp, row.status, now]
        done = {event for event, v in seen.items() if v[2] in DONE}
        new = [t for t, events in self.needs.items() if t not in fired and done.issuperset(events)]
        number = (self.round.get() or (0,))[0] if new else 0
        fired |= dict.fromkeys(new, now)
        if len(fired) == len(self.needs):
            self.seen.clear()
            self.round.update((number + 1,))
        else:
            self.seen.update((json.dumps(seen), json.dumps(fired)))
        for target in new:
            yield Row(batch_id=key[0], round=number, target=target)

    def close(self) -> None:
        pass


def readiness_rounds(messages: DataFrame, mapping: Mapping[str, tuple[str, ...]], ttl_ms: int | None = None) -> DataFrame:
    """ST3, ST4: a stream of ``(batch_id, round, target)``, each once.

    Needs the state store provider :data:`PROVIDER`.  Without ``ttl_ms`` only a finished round drops state, but for its number.
    """
    wanted = sorted({e for events in mapping.values() for e in events})
    return (
        newest_per_task(messages.filter(F.col("finish_event").isin(wanted)))
        .select("batch_id", "finish_event", "status", F.unix_micros("at").alias("at"), "id")
        .groupBy("batch_id")
        .transformWithState(
            statefulProcessor=_Rounds(mapping, ttl_ms),
            outputStructType=FIRED,
            outputMode="Append",
            timeMode="ProcessingTime" if ttl_ms else "None",
        )
    )


class ReadinessLoop:
    """Readiness as tables below ``path``; ``mapping`` is the path of the mapping file.

    ``fired`` has each pair of batch id and target once, under the trigger in which it fired.  A trigger that
    is repeated replaces what it had added.
    """

    def __init__(self, spark: SparkSession, path: str, mapping: str, buckets: int = 32) -> None:
        self.spark, self.path, self.mapping = spark, path.rstrip("/"), mapping
        keys = ["batch_id", "finish_event"]
        self.statuses = BucketedTable(spark, f"{self.path}/statuses", keys, buckets, bucket_by=["batch_id"])
        self.known = BucketedTable(spark, f"{self.path}/known", ["batch_id", "target"], buckets, bucket_by=["batch_id"])
        self.fired = AppendTable(spark, f"{self.path}/fired")

    def _mapping(self, epoch: int) -> tuple[DataFrame, bool]:
        """The mapping's rows now, and whether they differ from those of the trigger before this one."""
        needs = load_mapping(self.mapping, self.spark)
        text, name = json.dumps(needs, sort_keys=True), f"{self.path}/mapping.json"
        before = json.loads(read_text(self.spark, name)) if exists(self.spark, name) else {}
        if before.get("epoch") == epoch:  # this trigger, begun once already
            changed = before["changed"]
        else:
            changed = bool(before) and before["text"] != text
            write_text(self.spark, name, json.dumps({"epoch": epoch, "text": text, "changed": changed}))
        return mapping_rows(self.spark, needs), changed

    def trigger(self, messages: DataFrame, epoch: int) -> None:
        """Take in one trigger's messages and note the targets that are ready now."""
        stamp = F.struct("at", "id")
        newest = messages.groupBy("batch_id", "finish_event").agg(
            F.max(stamp).alias("stamp"), F.max_by("status", stamp).alias("status")
        )
        newest = newest.select("batch_id", "finish_event", "status", "stamp.at", "stamp.id")
        with staged(newest, "messages") as batch:
            self.statuses.merge(batch, self.statuses.keys, self._newer)
            mapping, changed = self._mapping(epoch)
            rows = self.statuses.read() if changed else self.statuses.near(batch)
            if rows is None:
                return
            ready = ready_targets(rows, mapping)
            known = self.known.read() if changed else self.known.near(batch)
            if known is not None:
                before = known.filter(F.col("epoch") != epoch).select("batch_id", "target")
                ready = ready.join(before, (ready.batch_id.eqNullSafe(before.batch_id)) & (ready.target == before.target), "left_anti")
            with staged(ready.withColumn("epoch", F.lit(epoch).cast("long")), "ready") as fired:
                self.fired.append(fired, f"{epoch:012d}")
                self.known.merge(
                    fired, self.known.keys, lambda old, new: new if old is None else old.filter(F.col("epoch") != epoch).unionByName(new)
                )

    @staticmethod
    def _newer(old: DataFrame | None, new: DataFrame) -> DataFrame:
        if old is None:
            return new
        stamp = F.struct("at", "id")
        both = old.unionByName(new).groupBy("batch_id", "finish_event")
        rows = both.agg(F.max(stamp).alias("stamp"), F.max_by("status", stamp).alias("status"))
        return rows.select("batch_id", "finish_event", "status", "stamp.at", "stamp.id")

    def follow(self, messages: DataFrame, checkpoint: str):
        """Run over all messages there are and stop."""
        writer = messages.writeStream.foreachBatch(self.trigger).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query

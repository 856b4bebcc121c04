"""Run ledger and finish events: K17, K18, A8."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import write_text

# The kinds of things a ledger row is about.
ENTITIES = ("execution", "task_run", "task_event", "task_config", "dataset_run")

LEDGER_SCHEMA = (
    "entity string, id string, parent string, dataset string, status string, "
    "at timestamp, batch_id string, finish_event string, details string"
)
EVENT_SCHEMA = (
    "finish_event string, dataset string, status string, source_system string, "
    "database string, config_file_path string, bucket_name string, timestamp string, "
    "batch_id string"
)


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


class Ledger:
    """Rows are only added: a run is a RUNNING row and later a SUCCESS or FAILED row.

    Rows lie in a folder for each day (UTC), so that a question about some days reads those; what is
    noted together is one file, and a stream can read the ledger as it grows.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def note(
        self,
        entity: str,
        id: str,
        status: str,
        dataset: str | None = None,
        parent: str | None = None,
        details: dict[str, Any] | None = None,
        batch_id: str | None = None,
        finish_event: str | None = None,
    ) -> None:
        self.note_all(
            [
                {
                    "entity": entity,
                    "id": id,
                    "parent": parent,
                    "dataset": dataset,
                    "status": status,
                    "batch_id": batch_id,
                    "finish_event": finish_event,
                    "details": details,
                }
            ]
        )

    def note_all(self, rows: list[dict[str, Any]]) -> None:
        """Note several things at once, in one file."""
        unknown = sorted({str(r["entity"]) for r in rows} - set(ENTITIES))
        if unknown:
            raise ValueError(f"unknown ledger entity {unknown[0]!r}")
        if not rows:
            return
        at, names = _now(), [f.split()[0] for f in LEDGER_SCHEMA.split(", ")]
        lines = []
        for row in rows:
            filled = {**dict.fromkeys(names), "at": at, **row}
            if filled["details"] is not None and not isinstance(filled["details"], str):
                filled["details"] = json.dumps(filled["details"])
            lines.append(json.dumps({n: filled[n] for n in names}))
        write_text(self.spark, f"{self.path}/day={at[:10]}/{uuid.uuid4().hex}.json", "\n".join(lines))

    def start(
        self,
        dataset: str,
        parent: str | None = None,
        batch_id: str | None = None,
        finish_event: str | None = None,
    ) -> str:
        run = uuid.uuid4().hex
        self.note("dataset_run", run, "RUNNING", dataset, parent, None, batch_id, finish_event)
        return run

    def finish(
        self,
        run: str,
        dataset: str,
        status: str,
        batch_id: str | None = None,
        finish_event: str | None = None,
    ) -> None:
        self.note("dataset_run", run, status, dataset, None, None, batch_id, finish_event)

    def rows(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """All rows, or those noted from one day to another (``yyyy-mm-dd``, both included)."""
        rows = self.spark.read.schema(f"{LEDGER_SCHEMA}, day date").json(self.path)
        if since is not None:
            rows = rows.filter(F.col("day") >= F.lit(since).cast("date"))
        if until is not None:
            rows = rows.filter(F.col("day") <= F.lit(until).cast("date"))
        return rows.drop("day")


def run_messages(ledger: DataFrame) -> DataFrame:
    """Ledger rows of dataset runs as messages for :mod:`millrace.streaming.readiness`."""
    return ledger.filter((F.col("entity") == "dataset_run") & F.col("finish_event").isNotNull()).select(
        "batch_id", "finish_event", "dataset", "status", "at", F.xxhash64("id", "status").alias("id")
    )


def latest_status(
    ledger: DataFrame, keys: list[str], status: str = "status", order: list[str] | None = None
) -> DataFrame:
    """The newest status per key.  ``order`` runs from the time to the tie-break.

    An aggregate with a map-side combine: a key with very many rows is reduced where its
    rows lie.
    """
    newest = F.max_by(status, F.struct(*(order or ["at", "id"])))
    return ledger.groupBy(*keys).agg(newest.alias(status))


def status_of(ledger: DataFrame, dataset: str) -> str | None:
    """The newest status of one dataset, ``None`` when it has no row."""
    row = latest_status(ledger.filter(F.col("dataset") == dataset), ["dataset"]).first()
    return None if row is None else row["status"]


def dependencies_ready(ledger: DataFrame, tables: DataFrame) -> DataFrame:
    """ST6: per target of ``tables (target, dataset)``, whether every dataset's newest
    status is SUCCESS."""
    newest = latest_status(ledger, ["dataset"])
    return (
        tables.join(newest, "dataset", "left")
        .groupBy("target")
        .agg(F.bool_and(F.coalesce(F.col("status") == "SUCCESS", F.lit(False))).alias("ready"))
    )


def send_finish_event(
    spark: SparkSession, folder: str, event: dict[str, Any], status: str = "COMPLETED"
) -> dict[str, Any]:
    """Add one event, with its time, to the events folder."""
    sent = {"status": status, "timestamp": _now(), **event}
    write_text(spark, f"{folder.rstrip('/')}/{uuid.uuid4().hex}.json", json.dumps(sent))
    return sent

"""Runs that notifications start: from a control file's arrival to golden tables (S11, ST2, R0).

Each trigger takes the control files that were announced, reads each one's manifest and runs the spec of
its table.  A run goes by its control file: its name is what ledger rows, events, rejected lines and history
carry, and a mark is set when all its outputs are stored.  A trigger that is repeated, from the
checkpoint or because a file was announced again, skips runs that are marked; one that died midway
is run again, which replaces the part of the history that it had added.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.golden import GOLDEN
from millrace.plans.runner import execute
from millrace.sources.files import exists, write_text
from millrace.sources.ledger import Ledger
from millrace.sources.manifest import read_manifest, with_manifest
from millrace.streaming.notifications import parse_notifications, work_requests

log = logging.getLogger(__name__)

SpecOf = Callable[[str], dict[str, Any]]


@dataclass
class Runs:
    """What notifications of a lake at ``root`` start.

    ``specs`` gives for each raw table the spec of its run, from the folder of the golden tables.
    ``marks`` is the folder of the marks.  A run that fails is noted, and the
    others go on; it is tried again when its control file is announced again.
    """

    spark: SparkSession
    root: str
    golden: str
    marks: str
    specs: Mapping[str, SpecOf] = field(default_factory=lambda: GOLDEN)
    ledger: Ledger | None = None
    announce: Callable[[dict[str, Any]], None] | None = None
    as_of: Any = None

    def requests(self, messages: DataFrame) -> DataFrame:
        """ST2: ``run``, ``object_key`` and ``table`` of each control file announced, once."""
        found = work_requests(parse_notifications(messages), self.specs).select("object_key", "table").distinct()
        return found.select(F.sha2("object_key", 256).alias("run"), "object_key", "table")

    def trigger(self, messages: DataFrame, epoch: int) -> None:
        """Start the runs of one trigger.  There is a row for each control file announced in it."""
        for row in self.requests(messages).orderBy("object_key").collect():
            self.start(row["run"], row["object_key"], row["table"], epoch)

    def start(self, run: str, object_key: str, table: str, epoch: int = 0) -> bool:
        """Run the spec of one control file, unless that is done; whether it is now."""
        mark = f"{self.marks.rstrip('/')}/{run}.json"
        if exists(self.spark, mark):
            return True
        details = {"control_file": object_key, "epoch": epoch}
        try:
            manifest = read_manifest(self.spark, f"{self.root.rstrip('/')}/{object_key}")
            spec = with_manifest(self.specs[table](self.golden), manifest, self.root)
            execute(self.spark, {**spec, "batch_id": run}, self.ledger, self.announce, self.as_of)
        except Exception as error:
            log.exception("run of %s", object_key)
            self._note(run, "FAILED", table, {**details, "error": str(error)[:500]})
            return False
        write_text(self.spark, mark, json.dumps({**details, "table": table}))
        self._note(run, "SUCCESS", table, details)
        return True

    def _note(self, run: str, status: str, table: str, details: dict[str, Any]) -> None:
        if self.ledger is not None:
            self.ledger.note("execution", run, status, table, None, details, run)

    def follow(self, messages: DataFrame, checkpoint: str, once: bool = True):
        """The streaming query over ``messages``; with ``once`` it ends when all there is has been run."""
        writer = messages.writeStream.foreachBatch(self.trigger).option("checkpointLocation", checkpoint)
        if not once:
            return writer.start()
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query

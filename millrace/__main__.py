"""Run one job: ``python -m millrace {raw,spec,insight,readiness} --help``."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.plans.insights import INSIGHTS, TRIGGERS, publish  # noqa: E402
from millrace.plans.raw import build_raw  # noqa: E402
from millrace.plans.runner import execute  # noqa: E402
from millrace.sources.files import read_text  # noqa: E402
from millrace.sources.ledger import Ledger, send_finish_event  # noqa: E402
from millrace.sources.manifest import Batch, manifest_files, read_manifest, with_manifest  # noqa: E402
from millrace.streaming.readiness import (  # noqa: E402
    load_mapping,
    readiness_stream,
    run_available,
    validate_events,
)


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace")
    jobs = parser.add_subparsers(dest="job", required=True)
    spec = jobs.add_parser("spec", help="run a JSON spec over the files of a manifest")
    spec.add_argument("--spec", required=True)
    spec.add_argument("--manifest", help="default: the path the spec names itself")
    spec.add_argument("--root", default="", help="what the manifest's paths are relative to")
    spec.add_argument("--ledger")
    spec.add_argument("--events")
    spec.add_argument("--batch-id", help="what ledger rows and finish events of this run share")
    spec.add_argument("--database", help="register the outputs in this database of the catalog")
    insight = jobs.add_parser("insight", help="run an insight job over the golden tables")
    insight.add_argument("--name", required=True, choices=sorted(INSIGHTS))
    insight.add_argument("--golden", required=True)
    insight.add_argument("--out", required=True)
    insight.add_argument("--database")
    raw = jobs.add_parser("raw", help="flatten response dumps to a raw batch with a manifest")
    for name in ("--dumps", "--root", "--source", "--database", "--table", "--date", "--run"):
        raw.add_argument(name, required=True)
    ready = jobs.add_parser("readiness", help="add the targets that finish events make ready to a folder")
    for name in ("--events", "--checkpoint", "--out"):
        ready.add_argument(name, required=True)
    ready.add_argument("--mapping", help="a JSON file; default: the insight jobs' triggers")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = _arguments(given)
    spark = SparkSession.builder.appName(f"millrace {args.job}").getOrCreate()
    if args.job == "insight":
        publish(spark, args.name, args.golden, args.out, args.database)
        return
    if args.job == "raw":
        batch = Batch(args.root, args.source, args.database, args.table, args.date, args.run)
        build_raw(spark, args.dumps, batch)
        return
    if args.job == "readiness":
        mapping = load_mapping(args.mapping or TRIGGERS, spark)
        events = validate_events(spark.readStream.text(args.events)).filter("reject_reason IS NULL")
        run_available(readiness_stream(events, mapping), args.checkpoint, args.out)
        return
    spec = json.loads(read_text(spark, args.spec))
    if args.batch_id:
        spec["batch_id"] = args.batch_id
    if args.database:
        spec["register_in"] = args.database
    if args.manifest:
        manifest = read_manifest(spark, args.manifest)
        manifest_files(manifest, args.root)  # an empty manifest is an error
        spec = with_manifest(spec, manifest, args.root)

    def announce(event: dict) -> None:
        send_finish_event(spark, args.events, event)

    ledger = Ledger(spark, args.ledger) if args.ledger else None
    execute(spark, spec, ledger, announce if args.events else None)


if __name__ == "__main__":
    main()

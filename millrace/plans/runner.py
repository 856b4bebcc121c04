"""The spec runner (R0): a dict of steps folded over named frames.

Spec: ``{"dataset", "input": {...}, "transformations": [step...], "output": [out...],
"quality": {frame: [rule...]}}``.  A step is ``{"name", "params", "target",
"output_names", "multi_output", "show_sample"}``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from contextlib import ExitStack
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import STEPS
from millrace.operators.quality import Watch, check_schema, parse_rules, validate
from millrace.operators.rows import union_all
from millrace.sources.catalog import register_outputs
from millrace.sources.readers import CORRUPT, ORIGIN, read_input
from millrace.sources.tables import save, staged

INPUT_FRAME = "input_df"
log = logging.getLogger(__name__)


def apply_steps(
    frames: Mapping[str, DataFrame], steps: list[dict[str, Any]], start: str = INPUT_FRAME, first: int = 1
) -> tuple[dict[str, DataFrame], str]:
    """All frames after the steps, and the name of the last one made.  Steps count from ``first``.

    Nothing runs: the result is a set of lazy plans.
    """
    made = dict(frames)
    last = start
    for number, step in enumerate(steps, first):
        name = step["name"]
        target = step.get("target", last)
        if target not in made:
            raise ValueError(f"step {number} ({name}): no frame named {target!r}")
        function = STEPS.get(name)
        params = dict(step.get("params", {}))
        for parameter in STEPS.frame_parameters(name):
            wanted = params.get(parameter)
            if isinstance(wanted, str):
                if wanted not in made:
                    raise ValueError(f"step {number} ({name}): no frame named {wanted!r}")
                params[parameter] = made[wanted]
        result = function(made[target], **params)
        outputs = step.get("output_names", [])
        if step.get("multi_output", False):
            if not isinstance(result, tuple) or len(result) != len(outputs):
                raise ValueError(
                    f"step {number} ({name}): {len(outputs)} output_names do not fit its result"
                )
        else:
            if not isinstance(result, DataFrame):
                raise ValueError(f"step {number} ({name}): expected one DataFrame")
            result, outputs = (result,), (outputs or [target])[:1]
        made.update(zip(outputs, result))
        last = outputs[0]
        if step.get("show_sample", False):
            # the schema is free; printing rows would run the plan once more
            for output in outputs:
                log.info("%s: %s", output, made[output].schema.simpleString())
    return made, last


def run_pipeline(
    spark: SparkSession, spec: dict[str, Any], source: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Read the spec's input (or take ``source``) and apply its steps."""
    frame = source if source is not None else read_input(spark, spec["input"])
    frames, _ = apply_steps({INPUT_FRAME: frame}, spec.get("transformations", []))
    return frames


def shared_steps(steps: list[dict[str, Any]]) -> int:
    """How many of the first steps only change the input frame, so that all frames come after them."""
    for number, step in enumerate(steps):
        alone = not any(isinstance(step.get("params", {}).get(p), str) for p in STEPS.frame_parameters(step["name"]))
        names = step.get("output_names") or [step.get("target", INPUT_FRAME)]
        if step.get("multi_output", False) or not alone or step.get("target", INPUT_FRAME) != INPUT_FRAME or names != [INPUT_FRAME]:
            return number
    return len(steps)


def rejected(df: DataFrame) -> DataFrame:
    """The lines of an input that did not fit its schema, each with its file."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), F.col(ORIGIN).alias("file"))


def accepted(df: DataFrame) -> DataFrame:
    """The other rows."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, ORIGIN)


def check_quality(
    frames: Mapping[str, DataFrame], rules: Mapping[str, list[dict[str, Any]]], as_of=None
) -> DataFrame | None:
    """Results of the spec's ``quality`` rules, one pass over each named frame."""
    report = None
    for name, rule_list in rules.items():
        if name not in frames:
            raise ValueError(f"quality rules name an unknown frame {name!r}")
        result = validate(frames[name], parse_rules(rule_list), name, as_of)
        report = result if report is None else report.unionByName(result)
    return report


def keep_report(report: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """Keep the results of the rules as rows (at ``quality_path``, if given), and fail the run
    if one fails that ``quality_blocking`` names, or any where it is true.

    There is a row for each rule, so that the report can be held here.
    """
    rows = report.collect()
    kept = report.sparkSession.createDataFrame(rows, report.schema)
    if spec.get("quality_path"):
        kept.withColumn("batch_id", F.lit(spec.get("batch_id")).cast("string")).write.mode("append").parquet(
            spec["quality_path"]
        )
    blocking = spec.get("quality_blocking", False)
    failed = [r["check"] for r in rows if not r["passed"] and (blocking is True or r["check"] in (blocking or ()))]
    if failed:
        raise ValueError(f"blocking quality rules fail: {failed}")
    return kept


def write_outputs(
    frames: Mapping[str, DataFrame],
    spec: dict[str, Any],
    save: Callable[[DataFrame, dict[str, Any]], Any],
    ledger=None,
    announce: Callable[[dict[str, Any]], None] | None = None,
) -> list[dict[str, Any]]:
    """Store every ``output`` of the spec; returns the outputs with their schemas.

    Per output: check ``expected_schema``, note RUNNING, store, note SUCCESS (or FAILED),
    and only then announce the finish event, so that a reader of the event finds the
    ledger already closed.
    """
    done = []
    for output in spec.get("output", []):
        name = output.get("dataframe", "transformed_df")
        if name not in frames:
            raise ValueError(f"output names an unknown frame {name!r}")
        frame = frames[name]
        if output.get("expected_schema"):
            check_schema(frame, output["expected_schema"], strict=True)
        about = {"batch_id": spec.get("batch_id"), "finish_event": output.get("finish_event")}
        run_id = ledger.start(name, **about) if ledger is not None else None
        try:
            save(frame, output)
        except Exception:
            if ledger is not None:
                ledger.finish(run_id, name, "FAILED", **about)
            raise
        if ledger is not None:
            ledger.finish(run_id, name, "SUCCESS", **about)
        if announce is not None and output.get("finish_event"):
            announce(
                {
                    "finish_event": output["finish_event"],
                    "batch_id": spec.get("batch_id"),
                    "dataset": name,
                    "source_system": spec.get("source_system"),
                    "config_file_path": spec.get("config_file_path"),
                    "database": "golden",
                }
            )
        done.append({**output, "schema": schema_rows(frame)})
    return done


@dataclass(frozen=True)
class PipelineResult:
    """What a run made: frames by name, stored outputs with schema, quality report."""

    frames: dict[str, DataFrame]
    outputs: list[dict[str, Any]]
    quality: DataFrame | None


def execute(
    spark: SparkSession,
    spec: dict[str, Any],
    ledger=None,
    announce: Callable[[dict[str, Any]], None] | None = None,
    as_of=None,
) -> PipelineResult:
    """Read, transform, check the ``quality`` rules, store every output and, where the spec
    says ``register_in``, enter the outputs into that database of the catalog.

    The input is read once: where several frames come from it, what they share is written to the work
    folder as columns.  Each output's rows are computed once as well, and its quality rules are measured as
    they are written; all outputs are there, and all rules read, before the first table changes.
    With ``rejects`` in the input, lines that don't fit the schema are added there, by ``batch_id``.
    """
    source = read_input(spark, spec["input"])
    try:
        with ExitStack() as held:
            frames = _frames_once(spark, spec, source, held)
            batches, report = _batches(frames, spec, ledger, as_of, held)
            outputs = write_outputs(
                {**frames, **batches},
                spec,
                lambda df, output: save(df, {**output, "batch_id": spec.get("batch_id")}, spark, as_of, stored=True),
                ledger,
                announce,
            )
    finally:
        if source.is_cached:
            source.unpersist()
    if spec.get("register_in"):
        register_outputs(spark, spec["register_in"], outputs)
    whole = accepted(source) if spec["input"].get("rejects") else source
    return PipelineResult(run_pipeline(spark, spec, whole), outputs, report)


def _frames_once(spark: SparkSession, spec: dict[str, Any], source: DataFrame, held: ExitStack) -> dict[str, DataFrame]:
    """The spec's frames over an input that is parsed once, however many of them are used."""
    steps = spec.get("transformations", [])
    used = {o.get("dataframe", "transformed_df") for o in spec.get("output", [])} | set(spec.get("quality", {}))
    rejects = spec["input"].get("rejects")
    if rejects:
        source = held.enter_context(staged(source, "input"))
        folder = f"{rejects.rstrip('/')}/batch={spec.get('batch_id') or 'none'}"
        rejected(source).write.mode("overwrite").parquet(folder)
        return apply_steps({INPUT_FRAME: accepted(source)}, steps)[0]
    shared = shared_steps(steps) if len(used) > 1 else 0
    frames, last = apply_steps({INPUT_FRAME: source}, steps[:shared])
    if len(used) > 1 and not source.is_cached:
        frames[last] = held.enter_context(staged(frames[last], "input"))
    return apply_steps(frames, steps[shared:], last, shared + 1)[0]


def _batches(
    frames: Mapping[str, DataFrame], spec: dict[str, Any], ledger, as_of, held: ExitStack
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """The rows of every output, computed once, and the results of the spec's quality rules."""
    rules, reports, batches = dict(spec.get("quality", {})), [], {}
    for output in spec.get("output", []):
        name = output.get("dataframe", "transformed_df")
        if name not in frames:
            raise ValueError(f"output names an unknown frame {name!r}")
        if output.get("expected_schema"):
            check_schema(frames[name], output["expected_schema"], strict=True)
        if name in batches:
            continue
        watch = Watch(frames[name], parse_rules(rules.pop(name)), name, as_of) if name in rules else None
        about = {"batch_id": spec.get("batch_id"), "finish_event": output.get("finish_event")}
        try:
            batches[name] = held.enter_context(staged(watch.frame if watch else frames[name]))
        except Exception:
            if ledger is not None:
                ledger.finish(ledger.start(name, **about), name, "FAILED", **about)
            raise
        if watch:
            reports.append(watch.report(batches[name]))
    others = check_quality({**frames, **batches}, rules, as_of)
    reports += [] if others is None else [others]
    return batches, keep_report(union_all(reports), spec) if reports else None


def schema_rows(df: DataFrame) -> list[dict[str, Any]]:
    """The schema as a list of name, type and nullable (and metadata if any)."""
    rows = []
    for ordinal, field in enumerate(df.schema.fields):
        row = {
            "ordinal": ordinal,
            "name": field.name,
            "type": field.dataType.simpleString(),
            "nullable": field.nullable,
        }
        if field.metadata:
            row["metadata"] = dict(field.metadata)
        rows.append(row)
    return rows

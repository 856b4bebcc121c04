"""Data-quality rules (Q1-Q9): every check of a table is one expression of one aggregate.

Violations come back as rows ``(table, column, rule, check, violations, row_count,
passed)``, so two rules on one column stay apart.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.metrics import as_timestamp, days_before
from millrace.operators.rows import union_all
from millrace.sources.files import read_text

RESULT_SCHEMA = (
    "`table` string, `column` string, rule string, `check` string, violations bigint, "
    "row_count bigint, passed boolean"
)


@dataclass(frozen=True)
class Rule:
    """One rule on one column.  ``null_allowed`` is true unless the rule says otherwise."""

    column: str
    kind: str
    null_allowed: bool = True
    unique: bool = False
    min_value: float | None = None
    max_value: float | None = None
    pattern: str | None = None
    max_age_days: int | None = None
    allow_future: bool = False

    def checks(self, as_of=None) -> dict[str, Column]:
        """Name of each check this rule asks for, with the count of its violations."""
        value = F.col(self.column)
        found: dict[str, Column] = {}
        if not self.null_allowed:
            found["null"] = F.count_if(value.isNull())
        if self.unique:
            # null is one more value
            distinct = F.count_distinct(value) + F.max(value.isNull().cast("int"))
            found["unique"] = F.count(F.lit(1)) - F.coalesce(distinct, F.lit(0))
        if self.kind == "numeric":
            if self.min_value is not None:
                found["min_value"] = F.count_if(value < F.lit(self.min_value))
            if self.max_value is not None:
                found["max_value"] = F.count_if(value > F.lit(self.max_value))
        elif self.kind == "string":
            if self.pattern is not None:
                found["pattern"] = F.count_if(~value.rlike(self.pattern))
        elif self.kind == "timestamp":
            now = as_timestamp(as_of)
            if self.max_age_days is not None:
                found["max_age_days"] = F.count_if(value < days_before(self.max_age_days, as_of))
            if not self.allow_future:
                found["future"] = F.count_if(value > now)
        return found


KINDS = ("numeric", "string", "timestamp")


def parse_rule(config: Mapping[str, Any]) -> Rule:
    """Q4: a rule from its config; an unknown type or parameter is an error."""
    known = dict(config)
    kind = known.pop("type", None)
    if kind not in KINDS:
        raise ValueError(f"unknown rule type {kind!r}; use one of {KINDS}")
    known.update(known.pop("parameters", {}))
    allowed = set(Rule.__dataclass_fields__) - {"kind"}
    if set(known) - allowed:
        raise ValueError(f"unknown rule parameters {sorted(set(known) - allowed)}")
    return Rule(kind=kind, **known)


def parse_rules(configs: list[Mapping[str, Any]]) -> list[Rule]:
    return [parse_rule(c) for c in configs]


@dataclass(frozen=True)
class RuleBook:
    """Q4, Q8: the rules of every table, and the join rules between tables."""

    tables: dict[str, list[Rule]] = field(default_factory=dict)
    joins: list[dict[str, Any]] = field(default_factory=list)

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> RuleBook:
        tables = {
            name: parse_rules(entry.get("rules", []))
            for name, entry in config.items()
            if name != "join_validations"
        }
        return cls(tables, list(config.get("join_validations", [])))

    @classmethod
    def from_file(cls, spark, path: str) -> RuleBook:
        """A rule book from a JSON file or, where PyYAML is installed, a YAML file, anywhere Spark reads."""
        text = read_text(spark, path)
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as error:
                raise ValueError("a YAML rule file needs PyYAML; use JSON") from error
            config = yaml.safe_load(text)
        else:
            config = json.loads(text)
        if not isinstance(config, Mapping):
            raise ValueError(f"{path} holds no rules by table")
        return cls.from_config(config)

    def rules(self, table: str) -> list[Rule]:
        return self.tables.get(table, [])

    def joins_of(self, tables) -> list[dict[str, Any]]:
        """The join rules between some tables."""
        return [r for r in self.joins if r["source_table"] in tables and r["target_table"] in tables]


def _planned(df: DataFrame, rules: list[Rule], as_of) -> tuple[list[tuple[Rule, str, Column]], list[Rule]]:
    """The checks of rules on columns that ``df`` has, and the rules on columns it lacks."""
    present = [r for r in rules if r.column in df.columns]
    planned = [(rule, check, count) for rule in present for check, count in rule.checks(as_of).items()]
    return planned, [r for r in rules if r.column not in df.columns]


def validate(df: DataFrame, rules: list[Rule], table: str, as_of=None) -> DataFrame:
    """Q5: all checks of all rules in one aggregate over ``df``.

    A rule on a column the table lacks is reported as a failed check.
    """
    planned, absent = _planned(df, rules, as_of)
    measured = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[count.alias(f"_c{i}") for i, (_, _, count) in enumerate(planned)],
    )

    def row(rule: Rule, check: str, violations: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(table).alias("table"),
            F.lit(rule.column).alias("column"),
            F.lit(rule.kind).alias("rule"),
            F.lit(check).alias("check"),
            violations.cast("bigint").alias("violations"),
            F.col("_rows").alias("row_count"),
            passed.alias("passed"),
        )

    rows = [
        row(rule, check, F.col(f"_c{i}"), F.col(f"_c{i}") == 0)
        for i, (rule, check, _) in enumerate(planned)
    ] + [row(rule, "column missing", F.col("_rows"), F.lit(False)) for rule in absent]
    if not rows:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return measured.select(F.inline(F.array(*rows)))


class Watch:
    """Q5: the checks of a frame, measured while its rows pass by on their way to somewhere.

    Write :attr:`frame`; then :meth:`report` gives what :func:`validate` would, without a pass over
    the rows.  Only the number of distinct values can't be taken in passing: that is read off the
    written columns.
    """

    def __init__(self, df: DataFrame, rules: list[Rule], table: str, as_of=None) -> None:
        self.table = table
        self.planned, self.absent = _planned(df, rules, as_of)
        self._observed = Observation()
        passing = [
            count.cast("bigint").alias(f"_c{i}") for i, (_, check, count) in enumerate(self.planned) if check != "unique"
        ]
        self.frame = df.observe(self._observed, F.count(F.lit(1)).alias("_rows"), *passing)

    def report(self, written: DataFrame) -> DataFrame:
        """The results, once :attr:`frame` has been written; ``written`` reads what was."""
        found = dict(self._observed.get)
        distinct = [
            count.cast("bigint").alias(f"_c{i}") for i, (_, check, count) in enumerate(self.planned) if check == "unique"
        ]
        if distinct:
            found.update(written.agg(*distinct).first().asDict())
        rows = [
            (self.table, rule.column, rule.kind, check, found[f"_c{i}"], found["_rows"], found[f"_c{i}"] == 0)
            for i, (rule, check, _) in enumerate(self.planned)
        ]
        rows += [
            (self.table, rule.column, rule.kind, "column missing", found["_rows"], found["_rows"], False)
            for rule in self.absent
        ]
        return written.sparkSession.createDataFrame(rows, RESULT_SCHEMA)


def summarise(report: DataFrame) -> DataFrame:
    """Q9: per table the number of checks, passes and failures and the failed checks.

    The report has one row per check, so a table's failures are a short list.
    """
    failed = F.when(~F.col("passed"), F.concat_ws(".", "column", "check"))
    return report.groupBy("table").agg(
        F.max("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.array_join(F.array_sort(F.collect_list(failed)), ",").alias("failed"),
        F.bool_and("passed").alias("passed"),
    )


def _types(schema: T.StructType | Mapping[str, str]) -> dict[str, str]:
    if isinstance(schema, T.StructType):
        return {f.name: f.dataType.simpleString() for f in schema.fields}
    return {n: T.StructType.fromDDL(f"c {t}")[0].dataType.simpleString() for n, t in schema.items()}


def schema_difference(
    df: DataFrame, expected: T.StructType | Mapping[str, str]
) -> list[tuple[str, str, str]]:
    """``(side, name, type)`` for what is missing and what is extra.  No job runs."""
    have, want = _types(df.schema), _types(expected)
    missing = [("missing", n, t) for n, t in want.items() if have.get(n) != t]
    extra = [("extra", n, t) for n, t in have.items() if want.get(n) != t]
    return sorted(missing + extra)


def check_schema(
    df: DataFrame, expected: T.StructType | Mapping[str, str], strict: bool = False
) -> bool:
    """Q6: whether the schemas match.  ``strict`` raises on a column that is missing or has
    another type; extra columns are allowed there."""
    difference = schema_difference(df, expected)
    missing = [d for d in difference if d[0] == "missing"]
    if strict and missing:
        raise ValueError(f"schema differs: missing {[d[1:] for d in missing]}")
    return not difference


def orphan_check(
    left: DataFrame, right: DataFrame, keys: list[str], threshold: float = 0.1
) -> DataFrame:
    """Q7: distinct keys on each side and how many have no partner.

    Both sides are reduced to one row per key in a single grouping (combined in the map
    tasks, so a hot key costs one row per task); no join takes place.  A key with a null
    part has no partner.  One row comes back.
    """
    sides = union_all(
        [
            left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")),
            right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")),
        ]
    )
    grouped = sides.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    matched = (F.col("_l") == 1) & (F.col("_r") == 1) & whole
    counts = grouped.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_keys"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_keys"),
        F.count_if((F.col("_l") == 1) & ~matched).alias("left_orphans"),
        F.count_if((F.col("_r") == 1) & ~matched).alias("right_orphans"),
    )
    share = {
        side: F.coalesce(
            F.try_divide(F.col(f"{side}_orphans").cast("double"), F.col(f"{side}_keys")), F.lit(0.0)
        )
        for side in ("left", "right")
    }
    return counts.withColumns({f"{s}_ratio": share[s] for s in share}).withColumn(
        "valid", F.greatest("left_ratio", "right_ratio") <= F.lit(threshold)
    )


def check_joins(
    frames: Mapping[str, DataFrame], joins: list[Mapping[str, Any]]
) -> DataFrame | None:
    """Q8: the join rules of a rule book, the source side held to ``max_orphaned_ratio``."""
    reports = []
    for rule in joins:
        source, target, keys = rule["source_table"], rule["target_table"], list(rule["keys"])
        limit = float(rule.get("max_orphaned_ratio", 0.1))
        counts = orphan_check(frames[source], frames[target], keys)
        reports.append(
            counts.select(
                F.lit(source).alias("source_table"),
                F.lit(target).alias("target_table"),
                F.lit(",".join(keys)).alias("keys"),
                F.col("left_keys").alias("source_keys"),
                F.col("left_orphans").alias("orphans"),
                F.col("left_ratio").alias("orphan_ratio"),
                (F.col("left_ratio") <= F.lit(limit)).alias("passed"),
            )
        )
    return union_all(reports) if reports else None

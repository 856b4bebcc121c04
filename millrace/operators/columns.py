"""Steps that work on columns: P1-P3, P5-P9."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.registry import STEPS


@STEPS.register("select_columns")
def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the named columns, in that order."""
    return df.select(*columns)


@STEPS.register("rename_columns")
def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename; an absent old name is ignored.

    Renames run one after the other, so a map that feeds one rename into the next,
    or gives a name that is taken, would yield two columns of one name: refused.
    """
    applied = {old: new for old, new in mapping.items() if old in df.columns and old != new}
    kept = [c for c in df.columns if c not in applied]
    targets = list(applied.values())
    clash = (set(targets) & (set(kept) | set(applied))) | {
        t for t in targets if targets.count(t) > 1
    }
    if clash:
        raise ValueError(f"rename gives a name that is in use: {sorted(clash)}")
    return df.withColumnsRenamed(applied)


@STEPS.register("cast_columns")
def convert(df: DataFrame, type_mapping: dict[str, str]) -> DataFrame:
    """Change types; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in type_mapping.items()})


@STEPS.register("add_columns")
def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """P5: SQL expressions in order; a later one may use an earlier one.

    The expressions follow the session's ANSI mode: write ``try_divide(a, b)`` where
    ``b`` can be zero.
    """
    for name, expression in columns.items():
        df = df.withColumn(name, F.expr(expression))
    return df


@STEPS.register("drop_columns")
def discard(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*columns)


def stamp(df: DataFrame, constants: dict[str, Any]) -> DataFrame:
    """Constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def prefixed(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    """Rename columns out of the way of the other side of a join."""
    names = df.columns if columns is None else columns
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in names})

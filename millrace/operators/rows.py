"""Steps that filter, deduplicate, sort, group and split rows: P4, A1, A7, O1-O4, N1, U1."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.registry import STEPS


@STEPS.register("filter_rows")
def where(df: DataFrame, condition: str) -> DataFrame:
    """Keep rows for which the SQL predicate is true (null drops the row)."""
    return df.filter(condition)


def _comparable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_comparable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _comparable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _sort_keys(df: DataFrame, names: Iterable[str]) -> list[Column]:
    """Columns to order by; what cannot be compared is ordered by its JSON text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.col(n) if _comparable(types[n]) else F.to_json(F.struct(F.col(n))) for n in names
    ]


def ordering(order_by: Iterable[str | tuple[str, str] | Column]) -> list[Column]:
    """``"a"``, ``"a desc"``, ``("a", "desc")`` or a Column, as sort columns."""
    result = []
    for item in order_by:
        if isinstance(item, Column):
            result.append(item)
            continue
        name, _, direction = (
            item.strip().partition(" ") if isinstance(item, str) else (item[0], "", item[1])
        )
        direction = direction.strip().lower() or "asc"
        if direction not in ("asc", "desc"):
            raise ValueError(f"sort direction must be asc or desc, not {direction!r}")
        result.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
    return result


@STEPS.register("drop_duplicates")
def deduplicate(
    df: DataFrame, subset: list[str] | None = None, order_by: list | None = None
) -> DataFrame:
    """One row per key, the first by ``order_by``, ties broken by all other columns.

    ``row_number() = 1`` is cut to one row per key *before* the shuffle (Spark plans a
    partial WindowGroupLimit), so a key with a third of all rows sends one row per task.
    """
    if not subset:
        return df.distinct()
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.select(*df.columns).distinct()
    keys = ordering(order_by or []) + _sort_keys(df, rest)
    position = F.row_number().over(Window.partitionBy(*subset).orderBy(*keys))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


@STEPS.register("sort_dataframe")
def sort(df: DataFrame, columns: list[str], ascending: bool = True) -> DataFrame:
    """O1: global order, one direction for all columns, nulls first when ascending.

    The row hash and row id after the sort columns let the range partitioner cut
    inside one value, so a value (or a group of equal rows) with a third of all rows
    is spread over many tasks instead of filling one.
    """
    keys = [F.col(c).asc() if ascending else F.col(c).desc() for c in columns]
    return df.orderBy(*keys, *_tie_break(df))


def sort_by_metric(df: DataFrame, metric: str, *keys: str) -> DataFrame:
    """O2: largest metric first; ``keys`` decide between equal metrics."""
    return df.orderBy(F.desc(metric), *[F.asc(k) for k in keys])


def _tie_break(df: DataFrame) -> list[Column]:
    hashable = [
        f.name for f in df.schema.fields if _comparable(f.dataType)
    ]  # hash functions refuse maps
    return [F.xxhash64(*hashable), F.monotonically_increasing_id()]


@STEPS.register("group_and_aggregate")
def aggregate(df: DataFrame, group_by: list[str], aggregations: dict[str, str]) -> DataFrame:
    """A1: SQL aggregates by output name."""
    return df.groupBy(*group_by).agg(*[F.expr(e).alias(name) for name, e in aggregations.items()])


@STEPS.register("split_column_to_rows")
def split_to_rows(
    df: DataFrame,
    column: str,
    delimiter: str = ",",
    keep_empty: bool = False,
    trim: bool = False,
) -> DataFrame:
    """One row per part of a delimited value.  The delimiter is taken literally.

    A row whose value is null is dropped, or kept with null when ``keep_empty``.
    """
    parts = F.split(F.col(column), re.escape(delimiter))
    if trim:
        parts = F.transform(parts, lambda part: F.trim(part))
    unfold = F.explode_outer if keep_empty else F.explode
    return df.withColumn(column, unfold(parts))


def preview(df: DataFrame, order_by: list, n: int) -> DataFrame:
    """O3: the first ``n`` rows by a full order, the same rows in every run."""
    return df.orderBy(*ordering(order_by), *_sort_keys(df, df.columns)).limit(n)


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), list(frames)
    )

"""Joins: J1-J9."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.registry import STEPS


@STEPS.register("join_dataframes", frames=("df2",))
def join_using(
    df1: DataFrame, df2: DataFrame, join_cols: list[str], join_type: str = "inner"
) -> DataFrame:
    """Equi-join on columns of one name; each key appears once."""
    return df1.join(df2, join_cols, join_type)


def lookup_join(
    fact: DataFrame,
    dimension: DataFrame,
    on: str | list[str] | dict[str, str],
    how: str = "inner",
) -> DataFrame:
    """Fact with a lookup table; ``on`` may map fact columns to dimension columns.

    Spark itself broadcasts a dimension that its statistics prove to be below
    ``spark.sql.autoBroadcastJoinThreshold`` (and adaptive execution does so from real
    sizes), so no hint is needed.  Beyond it the join shuffles and adaptive execution
    splits hot keys.
    """
    if isinstance(on, dict):
        dimension = dimension.withColumnsRenamed({d: f for f, d in on.items()})
        on = list(on)
    return fact.join(dimension, on, how)


def same_key(left_keys: list[str], right_keys: list[str]) -> Column:
    """Equality of all keys, by column name, where null equals null."""
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left_keys, right_keys, strict=True)]
    return reduce(lambda a, b: a & b, pairs)


def orphans(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``left`` with no partner; a null key never has one.

    Both sides are reduced before they meet, so that a hot key is one row on either.
    """
    partners = right.select(*keys).distinct()
    return left.select(*keys).distinct().join(partners, keys, "left_anti")


def without_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; null keys are compared as values.

    When ``other`` is a batch small enough to broadcast, ``df`` is not shuffled.
    """
    return _half_join(df, other, keys, "left_anti")


def with_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``; null keys are compared as values."""
    return _half_join(df, other, keys, "left_semi")


def _half_join(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    names = [f"_other_{k}" for k in keys]
    # one row per key: adaptive execution cannot split the right side of these joins
    partner = other.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    return df.join(partner, same_key(keys, names), how)


def left_join_fanout(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a side that may hold very many rows of one key.

    Adaptive execution cannot split the right side of a left join, so one hot key there
    would be joined in one task.  An inner join it can split on both sides; the left rows
    without a partner come from an anti join against the reduced keys.
    """
    matched = left.join(right, keys, "inner")
    unmatched = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)

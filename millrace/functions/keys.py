"""Stable surrogate keys (F16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "~"


def entity_key(*columns: Column | str) -> Column:
    """A key that depends on nothing but the values: the same tuple gets the same
    key in every run, on every executor, and null counts as a value.

    Each value is written as ``length:value`` so that no two tuples share a text.
    """
    if not columns:
        raise ValueError("entity_key needs at least one column")
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK))
        )
    return F.sha2(F.concat(*parts), 256)

"""Derived measures and clock arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(as_of: dt.datetime | str | Column | None) -> Column:
    """``as_of`` as a column; the query's own start time when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime) and as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)  # F17
    return F.lit(str(as_of)).cast("timestamp")


def ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """F8: ``numerator / denominator * scale``; null when the denominator is zero."""
    top, bottom = (F.col(c) if isinstance(c, str) else c for c in (numerator, denominator))
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value if scale == 1.0 else value * F.lit(float(scale))


def years_between(since: Column | str, as_of: dt.datetime | str | Column | None = None) -> Column:
    """difference of the calendar years."""
    start = F.col(since) if isinstance(since, str) else since
    return F.year(as_timestamp(as_of)) - F.year(start)


def days_before(days: int, as_of: dt.datetime | str | Column | None = None) -> Column:
    """the moment ``days`` days before ``as_of``."""
    return as_timestamp(as_of) - F.make_interval(days=F.lit(int(days)))

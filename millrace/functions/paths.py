"""Object keys and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def decode_key(key: Column | str) -> Column:
    """Percent-decode an object key.  ``+`` stays a plus, and a percent sign that
    starts no valid escape stays as it is, so no key can fail the job."""
    text = F.regexp_replace(_col(key), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def path_part(path: Column | str, index: int) -> Column:
    """Segment ``index`` (from 0) of a path; null when there is none."""
    return F.get(F.split(_col(path), "/"), index)


def last_segment(path: Column | str) -> Column:
    """The part after the last slash, ignoring slashes at the end."""
    return F.element_at(F.split(F.rtrim(_col(path), F.lit("/")), "/"), -1)


def parent_path(path: Column | str) -> Column:
    """Everything before the last slash; the empty string when there is none."""
    return F.regexp_extract(F.rtrim(_col(path), F.lit("/")), "^(.*)/[^/]*$", 1)

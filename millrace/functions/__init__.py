"""Column functions.  Every function returns a ``Column``; none runs Python per row."""

from millrace.functions.cleaning import (
    clean_id,
    clean_number,
    clean_text,
    duration_seconds,
    join_values,
)
from millrace.functions.keys import entity_key
from millrace.functions.paths import decode_key, last_segment, path_part, parent_path
from millrace.functions.metrics import days_before, ratio, years_between

__all__ = [
    "clean_id",
    "clean_number",
    "clean_text",
    "days_before",
    "decode_key",
    "duration_seconds",
    "entity_key",
    "join_values",
    "last_segment",
    "parent_path",
    "path_part",
    "ratio",
    "years_between",
]

"""Cleaning of text, numbers, ids and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder for absent text, and the characters that count
# as white space (ASCII controls and blank, next-line, and every Unicode separator).
MISSING_TEXT = "N/A"
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_ISO_DURATION = (
    r"^P(?=.)(?:(\d+)W)?(?:(\d+)D)?"
    r"(?:T(?=.)(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
)
_UNIT_SECONDS = (604800, 86400, 3600, 60, 1)
_MINUTE_STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove white space of any kind from both ends (plain ``trim`` knows blanks only).

    ``btrim`` looks at the ends alone, where a regular expression would scan the text.
    """
    return F.btrim(_col(value), F.lit(WHITE_SPACE))


def clean_text(
    value: Column | str, escape_quotes: bool = False, missing: str | None = MISSING_TEXT
) -> Column:
    """line breaks become blanks, ends are stripped, null becomes ``missing``.

    ``escape_quotes`` doubles every double quote.  It is off by default because
    Spark's CSV writer escapes quotes itself.
    """
    text = strip(F.translate(_col(value).cast("string"), "\n\r", "  "))
    if escape_quotes:
        text = F.replace(text, F.lit('"'), F.lit('""'))
    return text if missing is None else F.coalesce(text, F.lit(missing))


def clean_number(value: Column | str) -> Column:
    """a whole number, or null for anything that is not one."""
    return strip(_col(value).cast("string")).try_cast("bigint")


def clean_id(value: Column | str) -> Column:
    """an id without white space at its ends."""
    return strip(value)


def duration_seconds(value: Column | str) -> Column:
    """seconds of an ISO-8601 duration, or epoch seconds of ``yyyy-MM-ddTHH:mm``.

    Anything else is null.  The stamp is read as UTC whatever the session zone.
    """
    text = _col(value)
    parts = [
        F.coalesce(
            F.regexp_extract(text, _ISO_DURATION, group + 1).try_cast("double"), F.lit(0.0)
        )
        * seconds
        for group, seconds in enumerate(_UNIT_SECONDS)
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    stamp = F.concat(text, F.lit(":00")).try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(text.rlike(_ISO_DURATION), total).when(
        text.rlike(_MINUTE_STAMP), F.timestamp_diff("SECOND", epoch, stamp).cast("double")
    )


def join_values(values: Column | str, delimiter: str = ",") -> Column:
    """an array as one delimited string; an absent array is the empty string."""
    return F.coalesce(F.array_join(_col(values), delimiter), F.lit(""))

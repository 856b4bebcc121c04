"""Slowly changing dimensions as functions of the stored frame and a batch.

``target`` is the stored table, or ``None`` before the first write.  Nothing is written
here; :mod:`millrace.sources.tables` does that.

The batch is expected to be small next to the table; :mod:`millrace.sources.tables` gives only those
partitions of the table that it can change.  For type 1 the table is the streamed
side of a join with the batch: while the size Spark knows for the batch (that of its files)
is below the broadcast threshold, the table is scanned and not shuffled; beyond it, both
sides shuffle on the key.  Types 2 and 3 meet the batch in the same way.  The batch holds one row per key by then, so no key can be hot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.metrics import as_timestamp
from millrace.operators.joins import same_key, with_keys, without_keys
from millrace.operators.rows import deduplicate

Moment = dt.datetime | str | Column | None


def one_per_key(
    batch: DataFrame, keys: list[str], order_by: list | None = None, strict: bool = False
) -> DataFrame:
    """One batch row per key: the first by ``order_by``; with ``strict`` a second row for
    a key fails the job when it runs."""
    if not keys:
        raise ValueError("primary_key is needed")
    if not strict:
        return deduplicate(batch, keys, order_by)
    rest = [c for c in batch.columns if c not in keys]
    grouped = batch.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.any_value(F.struct(*rest)).alias("_row")] * bool(rest),
    )
    checked = grouped.filter(
        F.when(
            F.col("_n") > 1,
            F.raise_error(F.concat(F.lit("duplicate key in batch: "), F.to_json(F.struct(*keys)))),
        ).isNull()
    )
    columns = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns]
    return checked.select(*columns)


def merged_schema(*frames: DataFrame) -> list[T.StructField]:
    """All columns of all frames in order of first appearance (K8)."""
    fields: dict[str, T.StructField] = {}
    for frame in frames:
        for field in frame.schema.fields:
            fields.setdefault(field.name, field)
    return list(fields.values())


def conform(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """``df`` with exactly these columns; an absent one is null (K8)."""
    present = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def aligned(batch: DataFrame, target: DataFrame) -> DataFrame:
    """``batch`` with the stored type for every stored column.  A value that does not fit
    fails the job under ANSI mode rather than change the table's type or become null."""
    have = {f.name: f.dataType for f in batch.schema.fields}
    want = {f.name: f.dataType for f in target.schema.fields}
    return batch.withColumns(
        {n: F.col(n).cast(t) for n, t in want.items() if n in have and have[n] != t}
    )


#: Whole-number types by size; each widens to all after it.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """K8: the smallest type that holds every value of both exactly, in files that hold the one or
    the other; ``None`` if there is none.

    Whole numbers widen among themselves, to decimals with enough digits, and up to ``int`` to doubles;
    ``float`` to ``double``; decimals to those with more digits on both sides of the point; dates to
    timestamps without zone.  Nothing becomes text.
    """
    if a == b:
        return a
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.NullType):
            return other
        if one in _WHOLE and other in _WHOLE and _WHOLE.index(one) < _WHOLE.index(other):
            return other
        if one in _WHOLE and isinstance(other, T.DecimalType):
            digits = max(_DIGITS[one], other.precision - other.scale)
            return T.DecimalType(digits + other.scale, other.scale) if digits + other.scale <= 38 else None
        if one in _WHOLE[:3] and isinstance(other, T.DoubleType):
            return other
        if isinstance(one, T.FloatType) and isinstance(other, T.DoubleType):
            return other
        if isinstance(one, T.DateType) and isinstance(other, T.TimestampNTZType):
            return other
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    return None


def widened_schema(stored: T.StructType, batch: T.StructType, keys: list[str] | None = None) -> T.StructType:
    """K8: the stored columns, each wide enough for the batch's column of that name; a batch column that
    is stored under another type that doesn't widen is an error, found before any row is written.

    A batch column that is text, or narrower than the stored one, is no change.  ``keys`` only widen among whole
    numbers, since they are hashed as text.
    """
    have = {f.name: f.dataType for f in batch.fields}
    fields = []
    for field in stored.fields:
        kind = have.get(field.name, field.dataType)
        # text is cast to the stored type, and fails the job where it doesn't fit
        found = field.dataType if isinstance(kind, T.StringType) else wider(field.dataType, kind)
        whole = all(k in _WHOLE or (isinstance(k, T.DecimalType) and k.scale == 0) for k in (field.dataType, found))
        if found is None or (field.name in (keys or []) and found != field.dataType and not whole):
            raise ValueError(f"column {field.name}: {kind.simpleString()} does not fit {field.dataType.simpleString()}")
        fields.append(T.StructField(field.name, found, True, field.metadata))
    return T.StructType(fields)


def scd1(
    target: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    order_by: list | None = None,
    strict: bool = False,
) -> DataFrame:
    """K3: batch rows replace stored rows of the same key; other stored rows stay."""
    batch = one_per_key(batch, keys, order_by, strict)
    if target is None:
        return batch
    batch = aligned(batch, target)
    fields = merged_schema(target, batch)
    kept = without_keys(target, batch, keys)
    return conform(kept, fields).unionByName(conform(batch, fields))


def _differs(columns: list[str], old: str, new: str) -> Column:
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}"))
    return changed


def _meet(target: DataFrame, batch: DataFrame, keys: list[str], joins: Column) -> DataFrame:
    """Every stored row as ``_old`` beside the batch row of its key as ``_new``; either is null
    where the other has no partner.

    The table streams past the batch, which Spark broadcasts or shuffles by its size; a second look at the keys
    of the table, and no other column, finds the batch rows without a partner.  (A full outer join would read
    the table once, but could never leave it where it is.)  Stored rows for which ``joins`` is false
    meet nothing; they are spread over the tasks, so that a key with many of them is not hot.
    """
    spread = F.when(joins, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*target.columns), F.lit(1 << 20)))
    old = target.select(
        F.struct(*target.columns).alias("_old"), *_keyed(keys, "_old_key"), spread.alias("_old_spread")
    )
    new = batch.select(
        F.struct(*batch.columns).alias("_new"), *_keyed(keys, "_new_key"), F.lit(0).cast("long").alias("_new_spread")
    )
    names = range(len(keys))
    condition = (F.col("_old_spread") == F.col("_new_spread")) & same_key(
        [f"_old_key{i}" for i in names], [f"_new_key{i}" for i in names]
    )
    met = old.join(new, condition, "left").select("_old", "_new")
    seen = with_keys(target.filter(joins).select(*keys), batch, keys)
    alone = without_keys(batch, seen, keys)
    absent = F.lit(None).cast(met.schema["_old"].dataType)
    return met.union(alone.select(absent.alias("_old"), F.struct(*batch.columns).alias("_new")))


def _keyed(keys: list[str], prefix: str) -> list[Column]:
    return [F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]


def scd2(
    target: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    tracking: list[str] | None = None,
    as_of: Moment = None,
    order_by: list | None = None,
    strict: bool = False,
    start: str = "start_date",
    end: str = "end_date",
    current: str = "is_current",
) -> DataFrame:
    """K4: versioned rows.  A changed key's open row is closed and a new one opened; an
    unchanged key, and a key absent from the batch, stays as it is.

    Without ``tracking`` every column but the keys is compared, null equal to null.
    """
    batch = one_per_key(batch, keys, order_by, strict)
    moment = as_timestamp(as_of)
    opened = batch.withColumns(
        {
            start: moment,
            end: F.lit(None).cast("timestamp"),
            current: F.lit(True),
        }
    )
    if target is None:
        return opened
    compared = tracking or [c for c in batch.columns if c not in keys]
    opened = aligned(opened, target)
    fields = merged_schema(target, opened)
    stored = conform(target, fields)
    opened = conform(opened, fields)
    is_open = F.coalesce(F.col(current), F.lit(False))

    names = [f.name for f in fields]
    closed_row = F.struct(
        *[
            (
                moment if c == end else F.lit(False) if c == current else F.col(f"_old.{c}")
            ).alias(c)
            for c in names
        ]
    )
    changed = _differs(compared, "_old", "_new")
    versions = (
        F.when(F.col("_old").isNull(), F.array(F.col("_new")))
        .when(F.col("_new").isNotNull() & changed, F.array(closed_row, F.col("_new")))
        .otherwise(F.array(F.col("_old")))
    )
    return _meet(stored, opened, keys, is_open).select(F.inline(versions)).toDF(*names)


def scd3(
    target: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    tracking: list[str],
    order_by: list | None = None,
    strict: bool = False,
    prefix: str = "prev_",
) -> DataFrame:
    """K5: ``prev_<c>`` holds the value before the last change of ``c``.

    It is null for a new key, takes the stored value when the batch changes it, and is
    carried on when it does not.  Stored keys absent from the batch stay.
    """
    if not tracking:
        raise ValueError("SCD3 needs tracking_columns")
    batch = one_per_key(batch, keys, order_by, strict)
    types = {f.name: f.dataType for f in batch.schema.fields}
    fresh = batch.withColumns({f"{prefix}{c}": F.lit(None).cast(types[c]) for c in tracking})
    if target is None:
        return fresh
    batch, fresh = aligned(batch, target), aligned(fresh, target)
    fields = merged_schema(target, fresh)
    stored = conform(target, fields)
    added, found = F.col("_old").isNull(), F.col("_new").isNotNull()

    def value(name: str) -> Column:
        old, new = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        source = name.removeprefix(prefix)
        if name.startswith(prefix) and source in tracking:
            before, after = F.col(f"_old.{source}"), F.col(f"_new.{source}")
            kept = F.when(found & ~before.eqNullSafe(after), before).otherwise(old)
            return F.when(added, new).otherwise(kept)
        return F.when(found, new).otherwise(old) if name in batch.columns else old

    pairs = _meet(stored, conform(fresh, fields), keys, F.lit(True))
    return pairs.select(*[value(f.name).alias(f.name) for f in fields])


def scd4_history(
    batch: DataFrame,
    recorded_at: Moment = None,
    target: DataFrame | None = None,
    keys: list[str] | None = None,
    tracking: list[str] | None = None,
    changes_only: bool = False,
) -> DataFrame:
    """K6, history side: the whole batch with the time it was recorded.

    With ``changes_only``, rows whose tracked columns equal the stored current row are
    left out.  The current side is :func:`scd1`.
    """
    rows = batch
    if changes_only and target is not None:
        same = list(keys or []) + list(
            tracking or [c for c in batch.columns if c not in (keys or [])]
        )
        rows = without_keys(batch, conform(target, batch.select(*same).schema.fields), same)
    return rows.withColumn("record_timestamp", as_timestamp(recorded_at))


def append(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """K8: all rows of both, columns matched by name, absent ones null."""
    if target is None:
        return batch
    return target.unionByName(aligned(batch, target), allowMissingColumns=True)


def delete_where(target: DataFrame, condition: str) -> DataFrame:
    """Drop the rows for which the predicate is true; null keeps the row."""
    return target.filter(~F.coalesce(F.expr(condition), F.lit(False)))

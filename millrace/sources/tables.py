"""Stored tables: Parquet directories with one log entry per write.

Every write puts its files below a new directory ``data/_version=<n>-<id>/`` and then adds
``<path>/log/<n>.json``, which names the directories in force.  The log entry is the commit:
a job that dies before it leaves the old version in force, and a table is never overwritten
while it is read.  Of two writers of one version the second finds the entry taken and fails.

A merge rewrites only the partitions it has to: those that hold a key of the batch, and
those its rows belong to.  All others stay in force where they lie.  Entity tables without partition
columns of their own are :class:`BucketedTable`, histories :class:`AppendTable`.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.paths import decode_key
from millrace.operators import scd
from millrace.operators.joins import same_key, with_keys
from millrace.operators.rows import ordering
from millrace.operators.scd import widened_schema
from millrace.sources.files import exists, list_files, read_text, remove, work_folder, write_text
from millrace.sources.readers import narrow

LOG_SCHEMA = (
    "version bigint, operation string, written_at timestamp, tag string, "
    "live array<string>, schema string"
)

# In the path of a file: the directory, as the log names it.
FOLDER = r"/data/(_version=\d+-[0-9a-f]{8}(?:/.*)?)/[^/]+$"


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list | None = None,
    max_records_per_file: int | None = None,
    mode: str = "overwrite",
    dynamic: bool = False,
) -> None:
    """Hive-style directories, sorted within files, files capped by row count.

    With ``dynamic``, only the directories that rows belong to are replaced.

    Rows are rebalanced by the partition columns: adaptive execution joins small
    partitions and splits large ones, so each directory gets few files and a value with a
    third of all rows is written by many tasks.
    """
    columns = list(partition_by or [])
    if columns:
        df = df.hint("rebalance", *columns)
    order = [F.col(c) for c in columns] + ordering(sort_by or [])
    if order:
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if columns:
        writer = writer.partitionBy(*columns)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


@dataclass(frozen=True)
class Snapshot:
    """One version: its number, the directories in force and the columns."""

    version: int
    live: tuple[str, ...]
    schema: T.StructType


class VersionedTable:
    """A table at ``path``; see the module text for its layout."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partition_by: list[str] | None = None,
        sort_by: list | None = None,
        max_records_per_file: int | None = None,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.data = f"{self.path}/data"
        self.partition_by = list(partition_by or [])
        self.sort_by = list(sort_by or [])
        self.max_records_per_file = max_records_per_file

    # --- reading

    def history(self) -> DataFrame | None:
        """The log: one row per finished write."""
        names = list_files(self.spark, f"{self.path}/log", ".json")
        return self.spark.read.schema(LOG_SCHEMA).json(names) if names else None

    def version(self) -> int | None:
        """The number of the current version, ``None`` before the first write."""
        names = list_files(self.spark, f"{self.path}/log", ".json")
        return max((int(n.rsplit("/", 1)[-1][: -len(".json")]) for n in names), default=None)

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        number = self.version() if version is None else version
        if number is None:
            return None
        entry = json.loads(read_text(self.spark, f"{self.path}/log/{number}.json"))
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        return Snapshot(number, tuple(entry["live"]), schema)

    def _scan(self, live: tuple[str, ...], schema: T.StructType) -> DataFrame:
        """Rows of some directories.  The schema is known, so partition values keep their
        type and a directory written before a column existed gives null for it."""
        if not live:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.data)
        return reader.parquet(*[f"{self.data}/{d}" for d in live])

    def read(
        self,
        filter_conditions: str | None = None,
        partitions: Mapping[str, Any] | None = None,
        version: int | None = None,
    ) -> DataFrame | None:
        """The current (or a given) version, ``None`` if there is none."""
        found = self.snapshot(version)
        if found is None:
            return None
        rows = self._scan(found.live, found.schema).select(*found.schema.fieldNames())
        return narrow(rows, filter_conditions, partitions)

    def place(self) -> tuple[str, list[str] | None] | None:
        """Where a catalog entry has to point: a directory and, for a partitioned table,
        the directory of each partition.

        An entry has one directory for each partition, so a table that was appended to, and
        has several, can't be told by one: that is an error.  Use :class:`AppendTable`.
        """
        found = self.snapshot()
        if found is None:
            return None
        values = [d.partition("/")[2] for d in found.live]
        if len(set(values)) != len(values):
            raise ValueError(f"{self.path}: rows of one partition lie in several directories")
        where = [f"{self.data}/{d}" for d in found.live]
        return (self.data, where) if self.partition_by else (where[0], None)

    # --- writing

    def _write(self, df: DataFrame, version: int) -> tuple[str, ...]:
        """Files of one write; returns the directories that hold any."""
        folder = f"_version={version}-{uuid.uuid4().hex[:8]}"
        write_partitioned(
            df,
            f"{self.data}/{folder}",
            self.partition_by,
            self.sort_by,
            self.max_records_per_file,
        )
        if not self.partition_by:
            return (folder,)
        files = list_files(self.spark, f"{self.data}/{folder}", ".parquet")
        return tuple(sorted({f"{folder}{n.rsplit('/', 1)[0].split(folder, 1)[1]}" for n in files}))

    def _commit(
        self,
        version: int,
        operation: str,
        live: tuple[str, ...],
        schema: T.StructType,
        tag: str | None = None,
    ) -> int:
        entry = {
            "version": version,
            "operation": operation,
            "written_at": dt.datetime.now(dt.timezone.utc).isoformat(),
            "tag": tag,
            "live": list(live),
            "schema": schema.json(),
        }
        write_text(self.spark, f"{self.path}/log/{version}.json", json.dumps(entry), replace=False)
        return version

    def replace(
        self, df: DataFrame, operation: str = "overwrite", check: Callable[[DataFrame], None] | None = None
    ) -> int:
        """K2: ``df`` becomes the next version.  ``df`` may read the current one.

        ``check`` is given the written rows before they are in force; if it raises, they go.
        """
        number = (self.version() or 0) + 1
        live = self._write(df, number)
        if check is not None:
            try:
                check(self._scan(live, df.schema).select(*df.columns))
            except Exception:
                for folder in {d.split("/")[0] for d in live}:
                    remove(self.spark, f"{self.data}/{folder}")
                raise
        return self._commit(number, operation, live, df.schema)

    def append(self, df: DataFrame, tag: str | None = None) -> int:
        """K6, K8: add rows.  Columns may be new or absent.

        A second append under one ``tag`` takes the place of the first, so a job that is
        run again adds nothing twice.
        """
        found = self.snapshot()
        number = 1 if found is None else found.version + 1
        kept: tuple[str, ...] = ()
        fields = df.schema.fields
        if found is not None:
            stored = self.spark.createDataFrame([], widened_schema(found.schema, df.schema))
            df = scd.aligned(df, stored)
            fields = scd.merged_schema(stored, df)
            kept = found.live
            if tag is not None:
                same = self.history().filter(F.col("tag") == tag).select("version").collect()
                old = tuple(f"_version={r['version']}-" for r in same)
                kept = tuple(d for d in kept if not d.startswith(old)) if old else kept
        live = kept + self._write(df, number)
        return self._commit(number, "append", live, T.StructType(fields), tag)

    def merge(
        self,
        batch: DataFrame,
        keys: list[str],
        change: Callable[[DataFrame | None, DataFrame], DataFrame],
        operation: str = "merge",
    ) -> int:
        """K3-K6: ``change(stored rows, batch)`` becomes the next version.

        ``change`` must leave rows alone whose key is not in the batch; it then gets only
        the partitions that can be affected.
        """
        absent = [c for c in [*keys, *self.partition_by] if c not in batch.columns]
        if absent:
            raise ValueError(f"the batch lacks key or partition columns {absent}")
        found = self.snapshot()
        if found is None:
            return self.replace(change(None, batch), operation)
        if batch.isEmpty():
            return self._commit(found.version + 1, operation, found.live, found.schema)
        schema = widened_schema(found.schema, batch.schema)
        batch = scd.aligned(batch, self.spark.createDataFrame([], schema))
        touched = self._touched(found, batch, keys)
        stored = self._scan(touched, schema).select(*schema.fieldNames())
        return self._rewrite(found, touched, change(stored, batch), operation)

    def delete(self, condition: str) -> int | None:
        """A version without the rows for which ``condition`` is true."""
        found = self.snapshot()
        if found is None:
            return None
        touched = found.live
        if self.partition_by and found.live:
            hit = self._scan(found.live, found.schema).filter(condition)
            touched = self._folders(found, hit.select(F.col("_metadata.file_path").alias("_file")))
        stored = self._scan(touched, found.schema).select(*found.schema.fieldNames())
        return self._rewrite(found, touched, scd.delete_where(stored, condition), "delete")

    def _rewrite(
        self, found: Snapshot, touched: tuple[str, ...], rows: DataFrame, operation: str
    ) -> int:
        number = found.version + 1
        kept = tuple(d for d in found.live if d not in set(touched))
        live = kept + self._write(rows, number)
        return self._commit(number, operation, live, rows.schema)

    def _touched(
        self, found: Snapshot, batch: DataFrame, keys: list[str]
    ) -> tuple[str, ...]:
        """Directories that hold a key of the batch or a partition of its rows.

        Reads the key and partition columns only, past the broadcast keys of the batch.
        """
        parts = self.partition_by
        if not parts or not found.live:
            return found.live
        names = list(dict.fromkeys([*keys, *parts]))
        stored = self._scan(found.live, found.schema).select(
            *names, F.col("_metadata.file_path").alias("_file")
        )
        by_key = with_keys(stored, batch, keys).select("_file")
        # one row per partition and file before they meet the batch's partitions
        placed = stored.select(*parts, "_file").distinct()
        by_part = with_keys(placed, batch.select(*parts).distinct(), parts).select("_file")
        return self._folders(found, by_key.unionByName(by_part))

    def _folders(self, found: Snapshot, files: DataFrame) -> tuple[str, ...]:
        """The distinct directories of ``files``; there are as many as partitions."""
        path = decode_key("_file")
        folder = F.regexp_extract(path, FOLDER, 1).alias("_folder")
        names = {r["_folder"] for r in files.distinct().select(folder).distinct().collect()}
        if not names <= set(found.live):
            raise ValueError(f"{self.path}: rows in unknown directories {sorted(names - set(found.live))[:3]}")
        return tuple(sorted(names))


class AppendTable:
    """K6, K8: rows that are only added, in one folder with a partition for each batch.

    A batch that is written again takes the place of its first attempt.  The folder is a
    plain partitioned Parquet table, so a catalog entry over it is complete.
    """

    BATCH = "record_batch"

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by or [])

    def schema(self) -> T.StructType | None:
        """Columns of all batches so far, or ``None`` before the first."""
        name = f"{self.path}/_columns.json"
        return T.StructType.fromJson(json.loads(read_text(self.spark, name))) if exists(self.spark, name) else None

    def append(self, df: DataFrame, batch: str) -> None:
        """Add a batch.  Columns may be new or absent."""
        if self.BATCH in df.columns:
            raise ValueError(f"the batch has a column {self.BATCH}")
        before = self.schema()
        fields = df.schema.fields
        if before is not None:
            stored = self.spark.createDataFrame([], widened_schema(before, df.schema))
            df = scd.aligned(df, stored)
            fields = scd.merged_schema(stored, df)
        write_partitioned(df, f"{self.path}/{self.BATCH}={batch}", self.partition_by)
        write_text(self.spark, f"{self.path}/_columns.json", T.StructType(fields).json())

    def replace(self, df: DataFrame, batch: str) -> None:
        """``df``, under the name ``batch``, in place of all batches.  ``df`` must not read this table.

        The new batch is there before the old ones go; a job that dies between can be run again.
        """
        old = [p for p in list_files(self.spark, self.path, ".parquet") if f"/{self.BATCH}={batch}/" not in p]
        self.append(df, batch)
        for folder in sorted({p[: p.index("/", p.index(f"/{self.BATCH}=") + 1)] for p in old}):
            remove(self.spark, folder)

    def read(self) -> DataFrame | None:
        schema = self.schema()
        if schema is None:
            return None
        whole = T.StructType([*schema.fields, T.StructField(self.BATCH, T.StringType())])
        return self.spark.read.schema(whole).parquet(self.path).select(*schema.fieldNames())

    def catalog_entry(self) -> tuple[T.StructType, list[str]] | None:
        """Columns and partition columns of an entry over ``path``."""
        schema = self.schema()
        if schema is None:
            return None
        whole = T.StructType([*schema.fields, T.StructField(self.BATCH, T.StringType())])
        return whole, [self.BATCH, *self.partition_by]


class BucketedTable:
    """A table in which the place of a row is a function of its key.

    A row lies in the partition ``BUCKET``, a hash of its key modulo a number that is fixed with the
    first write.  A merge knows from the batch alone which partitions its keys are in: it
    reads and replaces those and looks at no others, so that it costs what its buckets hold, not what the
    table holds.  The folder is plain partitioned Parquet; the bucket is not a column of
    :meth:`read`.  Keys are hashed as text, so that a key column may become wider.

    Replacing partitions is Spark's dynamic partition overwrite: files are written aside and moved
    when all tasks are done.  One writer at a time.
    """

    BUCKET = "key_bucket"

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str] | None = None,
        buckets: int = 32,
        sort_by: list | None = None,
        max_records_per_file: int | None = None,
        bucket_by: list[str] | None = None,
    ) -> None:
        """``bucket_by`` are the key columns that decide the bucket, if not all: rows that agree in
        these lie together."""
        self.spark = spark
        self.path = path.rstrip("/")
        known = self._description()
        self.keys = list(keys or (known or {}).get("keys") or [])
        if known and keys and list(keys) != known["keys"]:
            raise ValueError(f"{self.path} is bucketed by {known['keys']}, not by {list(keys)}")
        self.buckets = known["buckets"] if known else int(buckets)
        self.bucket_by = (known or {}).get("bucket_by") or list(bucket_by or self.keys)
        if not set(self.bucket_by) <= set(self.keys):
            raise ValueError(f"buckets go by key columns, not by {self.bucket_by}")
        if not self.keys or self.buckets < 1:
            raise ValueError("a bucketed table needs key columns and at least one bucket")
        self.sort_by = list(sort_by or [])
        self.max_records_per_file = max_records_per_file

    @staticmethod
    def is_at(spark: SparkSession, path: str) -> bool:
        return exists(spark, f"{path.rstrip('/')}/_buckets.json")

    # --- reading

    def _description(self) -> dict[str, Any] | None:
        name = f"{self.path}/_buckets.json"
        return json.loads(read_text(self.spark, name)) if exists(self.spark, name) else None

    def schema(self) -> T.StructType | None:
        """The columns of :meth:`read`, or ``None`` before the first write."""
        known = self._description()
        return T.StructType.fromJson(known["schema"]) if known else None

    def version(self) -> int | None:
        """The number of writes so far, ``None`` before the first."""
        known = self._description()
        return known["writes"] if known else None

    def _scan(self, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(self.BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(whole).parquet(self.path)
        if buckets is not None:
            rows = rows.filter(F.col(self.BUCKET).isin(buckets))
        return rows.select(*schema.fieldNames())

    def read(
        self, filter_conditions: str | None = None, partitions: Mapping[str, Any] | None = None
    ) -> DataFrame | None:
        """The rows, ``None`` before the first write."""
        schema = self.schema()
        return None if schema is None else narrow(self._scan(schema), filter_conditions, partitions)

    def near(self, batch: DataFrame) -> DataFrame | None:
        """The rows of the buckets that a batch's keys are in; other buckets are not read."""
        schema = self.schema()
        return None if schema is None else self._scan(schema, self.touched(batch))

    def find(self, keys: Mapping[str, Any]) -> DataFrame | None:
        """The rows of one key; only its bucket is read."""
        schema = self.schema()
        if schema is None:
            return None
        types = {f.name: f.dataType for f in schema.fields}
        wanted = {k: F.lit(keys[k]).cast(types[k]) for k in self.keys}
        number = self._bucket(wanted[k] for k in self.bucket_by)
        rows = self._scan(schema, [self.spark.range(1).select(number).first()[0]])
        for name, value in wanted.items():
            rows = rows.filter(F.col(name).eqNullSafe(value))
        return rows

    def catalog_entry(self) -> tuple[T.StructType, list[str]] | None:
        """Columns and partition columns of an entry over ``path``."""
        schema = self.schema()
        if schema is None:
            return None
        return T.StructType([*schema.fields, T.StructField(self.BUCKET, T.IntegerType())]), [self.BUCKET]

    # --- writing

    def _bucket(self, keys) -> Column:
        return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, writes: int) -> int:
        """Replace the buckets that ``rows`` belong to."""
        placed = rows.withColumn(self.BUCKET, self._bucket(F.col(k) for k in self.bucket_by))
        write_partitioned(
            placed, self.path, [self.BUCKET], self.sort_by, self.max_records_per_file, dynamic=True
        )
        about = {"keys": self.keys, "bucket_by": self.bucket_by, "buckets": self.buckets}
        entry = {**about, "writes": writes, "schema": json.loads(rows.schema.json())}
        write_text(self.spark, f"{self.path}/_buckets.json", json.dumps(entry))
        return writes

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch's keys, of which there are at most ``buckets``."""
        number = self._bucket(F.col(k) for k in self.bucket_by).alias(self.BUCKET)
        return sorted(r[0] for r in batch.select(number).distinct().collect())

    def merge(
        self, batch: DataFrame, keys: list[str], change: Callable[[DataFrame | None, DataFrame], DataFrame], operation: str = "merge"
    ) -> int:
        """K3-K6: ``change(stored rows of the batch's buckets, batch)`` takes the place of those buckets.

        Give a batch that is stored (:func:`staged`): it is read for its buckets and again for its rows.
        """
        if list(keys) != self.keys:
            raise ValueError(f"{self.path} is bucketed by {self.keys}, not by {list(keys)}")
        absent = [c for c in [*keys] if c not in batch.columns]
        if absent:
            raise ValueError(f"the batch lacks key columns {absent}")
        if self.BUCKET in batch.columns:
            raise ValueError(f"the batch has a column {self.BUCKET}")
        known = self._description()
        if known is None:
            return self._write(change(None, batch), 1)
        schema = widened_schema(T.StructType.fromJson(known["schema"]), batch.schema, self.keys)
        batch = scd.aligned(batch, self.spark.createDataFrame([], schema))
        touched = self.touched(batch)
        if not touched:
            return known["writes"]
        return self._write(change(self._scan(schema, touched), batch), known["writes"] + 1)

    def delete(self, condition: str) -> int | None:
        """Take out the rows for which ``condition`` is true; buckets without such a row stay as they are."""
        known = self._description()
        if known is None:
            return None
        schema = T.StructType.fromJson(known["schema"])
        hit = self.touched(self._scan(schema).filter(condition))
        if not hit:
            return known["writes"]
        rows = scd.delete_where(self._scan(schema, hit), condition)
        left = self.touched(rows)
        writes = self._write(rows, known["writes"] + 1) if left else known["writes"] + 1
        for number in sorted(set(hit) - set(left)):  # a bucket without rows is not overwritten
            remove(self.spark, f"{self.path}/{self.BUCKET}={number}")
        return writes


def stored_table(spark: SparkSession, path: str) -> VersionedTable | BucketedTable:
    """The table at ``path``, whichever kind it is."""
    return BucketedTable(spark, path) if BucketedTable.is_at(spark, path) else VersionedTable(spark, path)


def merge_in_place(
    batch: DataFrame,
    table: str,
    keys: list[str],
    order_by: list | None = None,
    strict: bool = False,
) -> None:
    """K3 on a catalog table whose format has MERGE: the format rewrites the files that hold
    a key of the batch and no others.  A Parquet table has none; use :func:`save` there."""
    rows = scd.one_per_key(batch, keys, order_by, strict).alias("_batch")
    name = table.split(".")[-1]
    condition = same_key([f"{name}.{k}" for k in keys], [f"_batch.{k}" for k in keys])
    rows.mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()


@contextmanager
def staged(batch: DataFrame, name: str = "batch", folder: str | None = None) -> Iterator[DataFrame]:
    """The batch, computed once and written to ``folder``, or the shared work folder, for as long as it is used.

    A merge reads its batch several times; from files it is read, not computed, again.
    Their size is also what lets Spark decide whether the batch can be broadcast past
    the table.
    """
    spark = batch.sparkSession
    path = f"{folder}/{uuid.uuid4().hex}" if folder else work_folder(spark, name)
    batch.write.parquet(path)
    try:
        yield spark.read.schema(batch.schema).parquet(path)
    finally:
        remove(spark, path)


def save(
    df: DataFrame,
    output: Mapping[str, Any],
    spark: SparkSession | None = None,
    as_of=None,
    stored: bool = False,
) -> VersionedTable | BucketedTable:
    """K7: store ``df`` as the output's ``store_type`` says (SCD1 when it says nothing).

    An output with ``buckets`` and no partition columns becomes a :class:`BucketedTable`.  ``stored``
    says that ``df`` is read from files, and need not be written for the merge.  With ``batch_id`` in
    the output, rows of the history go by it, so that a run that is repeated adds nothing twice.
    """
    spark = spark or df.sparkSession
    kind = str(output.get("store_type", "SCD1")).upper()
    if kind not in ("SCD1", "SCD2", "SCD3", "SCD4"):
        raise ValueError(f"unsupported store_type {kind!r}")
    if kind == "SCD4" and not output.get("history_path"):
        raise ValueError("SCD4 needs history_path")
    keys = list(output["primary_key"])
    sizes = (output.get("sort_by"), output.get("max_records_per_file"))
    table: VersionedTable | BucketedTable
    if output.get("buckets") and not output.get("partition_by"):
        table = BucketedTable(spark, output["path"], keys, output["buckets"], *sizes)
    else:
        table = VersionedTable(spark, output["path"], output.get("partition_by"), *sizes)
    tracking = list(output.get("tracking_columns") or [])
    choice = {"order_by": output.get("order_by"), "strict": output.get("strict", False)}

    def change(old: DataFrame | None, rows: DataFrame) -> DataFrame:
        if kind == "SCD2":
            return scd.scd2(old, rows, keys, tracking or None, as_of, **choice)
        if kind == "SCD3":
            return scd.scd3(old, rows, keys, tracking, **choice)
        return scd.scd1(old, rows, keys, **choice)

    beside = f"{table.path}/batch" if isinstance(table, VersionedTable) else None
    with nullcontext(df) if stored else staged(df, folder=beside) as batch:
        if kind == "SCD4":
            changes_only = output.get("history_changes_only", False)
            old = table.read() if changes_only else None
            rows = scd.scd4_history(batch, as_of, old, keys, tracking, changes_only)
            history = AppendTable(spark, output["history_path"], output.get("partition_by"))
            history.append(rows, output.get("batch_id") or f"{(table.version() or 0) + 1:08d}")
        table.merge(batch, keys, change, kind)
    return table

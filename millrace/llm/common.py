"""What the operators of this folder share."""

from __future__ import annotations

import os
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import remove, work_folder


ROOT = str(Path(__file__).resolve().parents[2])
#: Has Spark delete the shuffle files of an execution at its end; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables, and their folders, that ``stored`` has written in the innermost ``scratch``.
_written: ContextVar[list[tuple[DataFrame, str]] | None] = ContextVar("written", default=None)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, as they would from
    ``--py-files`` or an installed package."""
    given = spark.sparkContext.environment
    if ROOT not in given.get("PYTHONPATH", "").split(os.pathsep):
        given["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, given.get("PYTHONPATH"))))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    This cuts the lineage: a lost executor costs a read of the files, not the work before, whose shuffle files go.
    """
    spark = df.sparkSession
    path, before = work_folder(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    if (written := _written.get()) is not None:
        written.append((found, path))
    return found


@contextmanager
def scratch():
    """Deletes at its end what ``stored`` has written within, all but the tables given to the function that this yields.

    Nothing that is used later may read the others: what is made of them has to be stored and kept.
    """
    outer, written, kept = _written.get(), [], []
    token = _written.set(written)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        _written.reset(token)
    for df, path in written:
        if not any(df is x for x in kept):
            remove(df.sparkSession, path)
        elif outer is not None:
            outer.append((df, path))


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """As ``stored``, dealt by ``column``: rows that are grouped by it later, or joined, are not shuffled again."""
    spark = df.sparkSession
    table = f"spark_catalog.default.{name}_{uuid4().hex}"
    dealt = df.write.bucketBy(max(partitions(spark), df.rdd.getNumPartitions()), column)
    dealt.saveAsTable(table, format="parquet", path=work_folder(spark, name))
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay
    return found


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (as long), ``text`` (null: empty) and the named columns, no others."""
    importable(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def free(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that ``docs`` has no column of."""
    while name in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def in_slices(batches, rows: int = 256):
    """The batches in slices of so many rows, so that what is made of long texts stays small."""
    for batch in batches:
        for a in range(0, len(batch), rows):
            yield batch.slice(a, rows)


def packed(rows: DataFrame, column: str = "text") -> DataFrame:
    """The rows with a string column compressed, for a shuffle that carries whole texts."""

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in in_slices(batches):
            small = pa.array([squeeze(t) for t in batch[column].cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([small if c == column else batch[c] for c in batch.schema.names], names=batch.schema.names)

    kinds = ", ".join(f"`{c}` {'binary' if c == column else kind}" for c, kind in rows.dtypes)
    return rows.mapInArrow(pack, kinds)


def unpacked(column: pa.Array) -> list[str]:
    """The strings of a compressed column."""
    whole = zstandard.ZstdDecompressor().decompress
    return [whole(x).decode() for x in column.to_pylist()]


def remainder(divisor: int):
    """The crc32 of a document's id, as text, modulo ``divisor``: what to learn from and what to hold out."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def lower_ascii(text):
    """``text`` with A-Z, and no other letters, in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_batches(rows, schema: pa.Schema, size: int = 4096):
    """Record batches of at most ``size`` rows from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)

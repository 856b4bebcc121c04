"""Catalog entries over stored tables: K12, K13."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.sources.tables import AppendTable, BucketedTable, VersionedTable


# Fixed value: the directory name Hive-style partitioning gives a null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS_AT_ONCE = 100


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def _columns(schema: T.StructType, partition_by: list[str]) -> list[str]:
    """Column definitions, partition columns last."""
    fields = {f.name: f for f in schema.fields}
    order = [n for n in fields if n not in partition_by] + list(partition_by)
    return [f"{_quoted(n)} {fields[n].dataType.simpleString()}" for n in order]


def create_or_repair(
    spark: SparkSession,
    database: str,
    table: str,
    schema: T.StructType,
    location: str,
    partition_by: list[str] | None = None,
    partition_dirs: list[str] | None = None,
) -> str:
    """Make sure an external Parquet table stands over ``location``.

    Creates database and table when absent and takes in the partitions found there, or
    those of ``partition_dirs`` where the table's partitions lie in several places.  An
    entry whose place has changed is pointed to the new one; only the catalog is touched,
    never data.
    Returns ``"created"`` or ``"repaired"``.
    """
    parts = list(partition_by or [])
    name = _quoted(database, table)
    existed = spark.catalog.databaseExists(database) and spark.catalog.tableExists(
        f"{database}.{table}"
    )
    if not existed:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
        clause = f"PARTITIONED BY ({', '.join(_quoted(p) for p in parts)})" if parts else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(_columns(schema, parts))}) "
            f"USING parquet {clause} LOCATION {_text(location)}"
        )
    else:
        have = {f.name.lower() for f in spark.table(name).schema.fields}
        new = [c for c, f in zip(_columns(schema, []), schema.fields) if f.name.lower() not in have]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
        if _plain(_location(spark, name)) != _plain(location):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(location)}")
    if partition_dirs is not None:
        _point_partitions(spark, name, parts, partition_dirs)
    elif parts:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(f"{database}.{table}")
    return "repaired" if existed else "created"


#: Rows that one task can group in memory, whatever their keys.
ROWS_A_BUCKET = 500_000


def buckets_for(rows: int, least: int) -> int:
    """So many buckets, ``least`` times a power of two, that a bucket of evenly dealt keys has at most ``ROWS_A_BUCKET`` rows.

    Give the larger of two tables that are to meet, and use the number for both.
    """
    n = least
    while n * ROWS_A_BUCKET < rows:
        n *= 2
    return n


def write_bucketed(
    df: DataFrame,
    database: str,
    table: str,
    keys: list[str],
    buckets: int,
    location: str,
    sort_by: list[str] | None = None,
) -> DataFrame:
    """``df`` as a catalog table whose files are dealt by ``keys``; returns its rows.

    Tables bucketed alike by the columns of a join or grouping meet without a shuffle.  Rows go to their
    buckets in one shuffle, so that there is a file for each bucket and not one for each task and bucket.
    The table is replaced; each write has a directory of its own below ``location``.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    path = f"{location.rstrip('/')}/{uuid.uuid4().hex}"
    writer.option("path", path).saveAsTable(f"{database}.{table}")
    return spark.table(f"{database}.{table}")


def _point_partitions(spark: SparkSession, name: str, parts: list[str], folders: list[str]) -> None:
    """Give each partition its directory; readers find an entry at any time."""
    wanted = {_values(d, parts): d for d in folders}
    shown = spark.sql(f"SHOW PARTITIONS {name}").collect()
    have = {_values(r["partition"], parts) for r in shown}
    placed = _partition_places(spark, name, have & set(wanted))
    for values in sorted(v for v, place in placed.items() if place != _plain(wanted[v])):
        spark.sql(f"ALTER TABLE {name} PARTITION ({values}) SET LOCATION {_text(wanted[values])}")
    added = [f"PARTITION ({v}) LOCATION {_text(d)}" for v, d in sorted(wanted.items()) if v not in have]
    for k in range(0, len(added), PARTITIONS_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[k : k + PARTITIONS_AT_ONCE])}")
    gone = [f"PARTITION ({v})" for v in sorted(have - set(wanted))]
    for k in range(0, len(gone), PARTITIONS_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone[k : k + PARTITIONS_AT_ONCE])}")


def _partition_places(spark: SparkSession, name: str, partitions: set[str]) -> dict[str, str]:
    """Where the catalog has each of some partitions."""
    places = {}
    for values in partitions:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({values})").collect()
        places[values] = next((_plain(r["data_type"]) for r in rows if r["col_name"] == "Location"), "")
    return places


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _values(folder: str, parts: list[str]) -> str:
    """The partition values a directory name stands for."""
    found = dict(p.split("=", 1) for p in folder.split("/") if "=" in p)
    return ", ".join(
        f"{_quoted(p)} = " + ("null" if found[p] == NULL_FOLDER else _text(unquote(found[p])))
        for p in parts
    )


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.filter("col_name = 'Location'").select("data_type").first()[0]


def _plain(location: str) -> str:
    return location.rstrip("/").removeprefix("file://").removeprefix("file:")


def table_name(path: str, store_type: str = "SCD1") -> str:
    """The last path part; for SCD4 the part before ``current``."""
    parts = [p for p in path.rstrip("/").split("/") if p]
    if store_type.upper() == "SCD4" and parts[-1] == "current":
        parts = parts[:-1]
    return parts[-1]


def register_outputs(
    spark: SparkSession,
    database: str,
    outputs: Iterable[Mapping[str, Any]],
    locate: Callable[[Mapping[str, Any]], tuple[str, list[str] | None] | None] | None = None,
) -> dict[str, str]:
    """Register every output of a run, and the history of those that keep one as
    ``<name>_history``.  ``locate`` gives the directory of an output and, if its partitions
    lie apart, theirs; without it outputs are stored tables in their newest version."""
    locate = locate or stored_place(spark)
    done = {}
    for output in outputs:
        absent = [k for k in ("dataframe", "path", "schema") if not output.get(k)]
        if absent:
            raise ValueError(f"output without {absent}")
        place = locate(output)
        if place is None:
            raise ValueError(f"nothing is stored at {output['path']}")
        rows = output["schema"]
        schema = (
            rows
            if isinstance(rows, T.StructType)
            else T.StructType.fromDDL(", ".join(f"{_quoted(r['name'])} {r['type']}" for r in rows))
        )
        name = table_name(output["path"], output.get("store_type", "SCD1"))
        parts = output.get("partition_by")
        if BucketedTable.is_at(spark, place[0]):
            schema, parts = BucketedTable(spark, place[0]).catalog_entry()
        done[name] = create_or_repair(spark, database, name, schema, place[0], parts, place[1])
        if output.get("history_path"):
            history = AppendTable(spark, output["history_path"], output.get("partition_by"))
            entry = history.catalog_entry()
            if entry is not None:
                done[f"{name}_history"] = create_or_repair(
                    spark, database, f"{name}_history", entry[0], history.path, entry[1]
                )
    return done


def stored_place(spark: SparkSession) -> Callable[[Mapping[str, Any]], Any]:
    """For :func:`register_outputs`: outputs that are stored tables, in their newest version."""

    def place(output):
        if BucketedTable.is_at(spark, output["path"]):
            return output["path"], None
        return VersionedTable(spark, output["path"], output.get("partition_by")).place()

    return place

"""Scans: S1, S4-S8, S12."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet")

_LEVELS = {
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
    "OFF_HEAP": StorageLevel.OFF_HEAP,
}


#: Stands for null in CSV files, so that an empty text (in quotes) stays one.
NULL_MARK = r"\N"

#: Columns of an input that keeps what does not fit: the line, and the file it is from.
CORRUPT, ORIGIN = "_corrupt_record", "_input_file"


def read_input(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """The configured scan.

    ``path`` is one path or a list.  A ``schema`` (StructType or DDL) saves the extra
    pass over the data that inference takes.  ``select_columns`` reaches the reader.
    ``repartition`` spreads the rows over that many tasks, or over as many as the scan has if that is more, for few
    and large files that cannot be split (gzip): what a task reads does not grow with an input that can.  With ``rejects`` a CSV or JSON line that does not fit the schema is kept
    as text in :data:`CORRUPT`, with its file in :data:`ORIGIN`; without, what doesn't fit is null.
    """
    kind = config.get("format", "csv")
    if kind not in FORMATS:
        raise ValueError(f"unsupported input format {kind!r}; use one of {FORMATS}")
    options = dict(config.get("options", {}))
    if kind == "csv":
        options.setdefault("nullValue", NULL_MARK)
    reader = spark.read.format(kind).options(**options)
    schema, extra = config.get("schema"), []
    if config.get("rejects"):
        if schema is None or kind == "parquet":
            raise ValueError("rejects need a CSV or JSON input with a schema")
        fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        extra = [CORRUPT, F.col("_metadata.file_path").alias(ORIGIN)]
    if schema is not None:
        reader = reader.schema(schema)
    path = config["path"]
    df = reader.load(list(path) if isinstance(path, (list, tuple)) else path)
    columns = config.get("select_columns", "all")
    if extra:
        df = df.select(*(c for c in df.columns if c != CORRUPT), *extra)
    if columns != "all":
        df = df.select(*columns, *([CORRUPT, ORIGIN] if extra else []))
    if config.get("repartition"):
        df = df.repartition(max(int(config["repartition"]), df.rdd.getNumPartitions()))
    if config.get("cache", False):
        level = config.get("data_persistence", "MEMORY_AND_DISK")
        df = df.persist(_LEVELS.get(level, StorageLevel.MEMORY_AND_DISK))
    return df


def read_dependencies(
    spark: SparkSession, dependencies: Mapping[str, str] | None, needed: list[str] | None = None
) -> dict[str, DataFrame]:
    """Named columnar tables.  A missing map or name is an error, found before any read."""
    if not dependencies:
        raise ValueError("no dependencies are configured")
    absent = [n for n in needed or [] if n not in dependencies]
    if absent:
        raise ValueError(f"dependencies without a path: {absent}")
    return {name: spark.read.parquet(path) for name, path in dependencies.items()}


def read_if_exists(
    spark: SparkSession, path: str, merge_schema: bool = False
) -> DataFrame | None:
    """The Parquet table at ``path``, or ``None`` when there is none."""
    try:
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def narrow(
    df: DataFrame,
    filter_conditions: str | None = None,
    partitions: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Partition values, then a predicate.

    A value is compared in the type of its column, so partition directories are pruned
    rather than cast and compared one by one.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, value in (partitions or {}).items():
        if name not in types:
            raise ValueError(f"unknown partition column {name!r}")
        df = df.filter(F.col(name) == F.lit(value).cast(types[name]))
    return df.filter(filter_conditions) if filter_conditions else df


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, given columns."""
    return spark.createDataFrame([], schema)


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    """The keys that drive the next step, kept distributed for a join."""
    return df.select(*columns).dropna().distinct()

"""Small-file access through Hadoop's FileSystem, so any storage Spark reads will do.

Only metadata passes through here (a listing, one JSON object), never table rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths below ``folder`` that end in ``suffix``, sorted."""
    system, path = _file_system(spark, folder)
    if not system.exists(path):
        return []
    found, names = system.listFiles(path, True), []
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(suffix):
            names.append(name)
    return sorted(names)


def exists(spark: SparkSession, path: str) -> bool:
    system, jvm_path = _file_system(spark, path)
    return system.exists(jvm_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this process has written."""
    system, jvm_path = _file_system(spark, path)
    system.delete(jvm_path, True)


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """Write one small file.  Without ``replace`` it is an error if there is one.

    The text goes to a temporary name first and is then renamed, so that no reader meets
    half of it and a job that dies leaves nothing under ``path``.  Where a store has no
    rename that refuses to replace, two writers can both go on: use one writer there.
    """
    folder, name = path.rsplit("/", 1)
    system, temporary = _file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(temporary, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    given = spark.sparkContext._gateway.new_array(options, 1)
    given[0] = options.OVERWRITE if replace else options.NONE
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(temporary, system.makeQualified(jvm_path), given)
    except Exception:
        system.delete(temporary, False)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    """One small file as a string."""
    system, jvm_path = _file_system(spark, path)
    stream = system.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see.

    It lies below ``spark.checkpoint.dir`` and, where that is unset, below the warehouse,
    which is shared by definition.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

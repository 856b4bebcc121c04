"""Batch folders and their manifests: S2, S3, K1, K15, K16."""

from __future__ import annotations

import copy
import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.files import list_files, read_text, write_text
from millrace.sources.readers import NULL_MARK, read_input


@dataclass(frozen=True)
class Batch:
    """One batch of one raw table, and where its data and manifest lie."""

    root: str
    source: str
    database: str
    table: str
    date: str
    run: int | str

    def _part(self, kind: str) -> str:
        return (
            f"{self.source}/{self.database}/{self.table}/{kind}/"
            f"date_{self.date}/batch_run_timestamp-{self.run}"
        )

    @property
    def data_path(self) -> str:
        return f"{self.root}/{self._part('data')}"

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/{self._part('metadata')}/control_file.json"


def _below(root: str, paths: list[str]) -> list[str]:
    """Paths relative to ``root``; a listing may add a scheme in front of it."""
    plain = root.rstrip("/").split("://")[-1].split("file:")[-1]
    return [p[p.index(plain) + len(plain) :].lstrip("/") for p in paths]


def write_csv_batch(df: DataFrame, batch: Batch) -> None:
    """K1: the batch's rows as CSV with header, replacing a previous attempt."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("nullValue", NULL_MARK)
        .csv(batch.data_path)
    )


def write_raw_manifest(spark: SparkSession, batch: Batch) -> dict[str, Any]:
    """Name the batch's CSV files in its manifest."""
    files = list_files(spark, batch.data_path, ".csv")
    manifest = {
        "event_type": "Raw Data Metadata",
        "date": batch.date,
        "batch_run_timestamp": batch.run,
        "partitions": _below(batch.root, files),
    }
    write_text(spark, batch.manifest_path, json.dumps(manifest, indent=2))
    return manifest


def write_golden_manifest(spark: SparkSession, root: str, table_path: str) -> dict[str, Any]:
    """Name a golden table's Parquet files in ``control.json`` beside them."""
    files = list_files(spark, f"{root}/{table_path}", ".parquet")
    manifest = {
        "event_type": "Golden Data Metadata",
        "dataset": table_path.rstrip("/").split("/")[-1],
        "partitions": _below(root, files),
    }
    write_text(spark, f"{root}/{table_path}/control.json", json.dumps(manifest, indent=2))
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(read_text(spark, path))


def manifest_files(manifest: Mapping[str, Any], root: str) -> list[str]:
    """Full paths of a manifest's files; a manifest without files is an error."""
    files = manifest.get("partitions") or []
    if not files:
        raise ValueError("the manifest names no files")
    return [f"{root}/{f}" for f in files]


def scan_manifest(
    spark: SparkSession, manifest_path: str, root: str, config: Mapping[str, Any]
) -> DataFrame:
    """Every file of the manifest as one frame."""
    files = manifest_files(read_manifest(spark, manifest_path), root)
    return read_input(spark, {**config, "path": files})


def with_manifest(
    spec: Mapping[str, Any], manifest: Mapping[str, Any], root: str, process: str = "r2g"
) -> dict[str, Any]:
    """S3: the spec with its input path replaced by the manifest's files.

    ``g2i`` specs read tables, not batches, and stay as they are.
    """
    if process not in ("r2g", "g2i"):
        raise ValueError(f"unknown process type {process!r}")
    merged = {**spec, "input": copy.copy(spec.get("input", {}))}
    if process == "r2g":
        merged["input"]["path"] = manifest_files(manifest, root)
    return merged

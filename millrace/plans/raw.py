"""Raw zone: response dumps to CSV batches with a manifest."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

from millrace.sources.manifest import Batch, write_csv_batch, write_raw_manifest
from millrace.sources.responses import extract

# The kind of response each raw table comes from, and the key each response
# was fetched for, which is put on its rows.
RAW_TABLES: dict[str, tuple[str, list[str]]] = {
    "categories": ("categories", []),
    "channels_information": ("channels", []),
    "trending_videos": ("videos", []),
    "related_category_videos": ("search", ["category_id"]),
    "comment_threads": ("threads", []),
    "replies": ("comments", ["comment_thread_id"]),
}


def build_raw(spark: SparkSession, dumps: str | list[str], batch: Batch) -> dict[str, Any]:
    """All dumps of ``batch.table`` as one CSV batch; returns the manifest written for it.

    The dumps are read and flattened as one frame, however many there are.
    """
    if batch.table not in RAW_TABLES:
        raise ValueError(f"unknown raw table {batch.table!r}; use one of {sorted(RAW_TABLES)}")
    kind, stamp = RAW_TABLES[batch.table]
    write_csv_batch(extract(spark, dumps, kind, stamp), batch)
    return write_raw_manifest(spark, batch)

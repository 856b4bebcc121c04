"""Operator 1: token ids as flat binary files that can be memory-mapped.

A data set is a folder with, for each shard,

* ``tokens-<shard>.bin``: ids one after the other, unsigned, 2 bytes each where the
  vocabulary has at most 65,536 entries and 4 bytes otherwise, little-endian;
* ``offsets-<shard>.bin``: 64-bit places of the documents in that file, one more than
  documents;
* ``documents-<shard>.bin``: 64-bit document ids (a null id: the smallest 64-bit number);

and ``index.json`` with the shards and their bases, the prefix sums of their token counts.
Shards are ranges of document ids and sorted within, so that shard by shard the ids are those
of all documents in ascending order.  Each task writes its own shard under a temporary name
and renames it, so that a task that runs again, or twice, leaves the same file.

Cases: null text is empty (the end id alone); null ids come first; equal ids lie next to each
other in the order of the text's hash, equal rows in any order, as they can't be told apart;
an empty table gives an index without shards; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import in_batches, partitions, texts
from millrace.llm.encoding import encoder, with_end
from millrace.sources.files import read_text, write_text

NULL_ID = -(2**63)
SHARD = pa.schema([("shard", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64())])
READ = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://"))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text) and write them to the new ``folder``."""
    spark = docs.sparkSession
    ordered = (
        texts(docs)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(partitions(spark), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    width = 2 if encoder(tokenizer).vocabulary <= 65_536 else 4

    def shard(batches):
        context = TaskContext.get()
        number = context.partitionId()
        store, root = _store(folder)
        store.create_dir(root)
        mark = f"{root}/.{number:06d}-{context.taskAttemptId()}"
        ids = encoder(tokenizer)
        offsets, names, place = array("q", [0]), array("q"), 0
        with store.open_output_stream(f"{mark}-tokens") as out:
            for batch in batches:
                for name, found in zip(batch["doc_id"].to_pylist(), ids.documents(batch["text"])):
                    found = with_end(found, end_id)
                    out.write(found.astype(f"<u{width}").tobytes())
                    place += len(found)
                    offsets.append(place)
                    names.append(NULL_ID if name is None else name)
        for kind, values in (("offsets", offsets), ("documents", names)):
            with store.open_output_stream(f"{mark}-{kind}") as out:
                out.write(np.array(values, "<i8").tobytes())
        for kind in ("documents", "offsets", "tokens"):
            store.move(f"{mark}-{kind}", f"{root}/{kind}-{number:06d}.bin")
        yield from in_batches([(number, len(names), place)], SHARD)

    # One row for each shard comes to the driver, never a document.
    found = ordered.mapInArrow(shard, "shard int, documents long, tokens long").collect()
    base, shards = 0, []
    for row in sorted(found):
        if row.documents:
            shards.append({"shard": row.shard, "base": base, "documents": row.documents, "tokens": row.tokens})
        base += row.tokens
    write_text(spark, f"{folder}/index.json", json.dumps({"width": width, "end_id": end_id, "shards": shards}))


def mapped(folder: str, kind: str, shard: int, dtype: str) -> np.ndarray:
    """A file of the data set as an array: mapped from a local or mounted folder, else read."""
    store, root = _store(folder)
    path = f"{root}/{kind}-{shard:06d}.bin"
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), dtype)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document of a data set: its place, length and a check sum of its ids."""
    index = json.loads(read_text(spark, f"{folder}/index.json"))
    width = index["width"]
    rows = [(s["shard"], s["base"]) for s in index["shards"]]
    shards = spark.createDataFrame(rows, "shard int, base long").repartition(max(1, len(rows)))

    def documents(batches):
        for batch in batches:
            for shard, base in zip(batch["shard"].to_pylist(), batch["base"].to_pylist()):
                ids = mapped(folder, "tokens", shard, f"<u{width}")
                offsets = mapped(folder, "offsets", shard, "<i8").tolist()
                names = mapped(folder, "documents", shard, "<i8").tolist()
                yield from in_batches(_read(names, offsets, ids, base), READ)

    return shards.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read(names, offsets, ids, base):
    for name, a, b in zip(names, offsets, offsets[1:]):
        check = zlib.crc32(ids[a:b].astype("<u4").tobytes())
        yield None if name == NULL_ID else name, base + a, b - a, check

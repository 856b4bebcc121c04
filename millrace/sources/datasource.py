"""Response dumps as a Spark data source (S9, S12, U1): ``spark.read.format("responses")``.

    spark.dataSource.register(ResponseSource)
    spark.read.format("responses").option("kind", "threads").option("stamp", "role").load("s3a://lake/dumps/*.json")

A dump is a file of JSON lines, each with a response in ``body`` and the columns of ``stamp`` beside it.
Pages of one answer are dumps whose names differ in ``-page-<n>`` only; they are one chain and read by one
task, in order, so that an item that a later page repeats comes once.  Other dumps are a chain each.

Columns are those of :func:`millrace.sources.responses.flatten`, and ``extra``: what an item has that the schema
does not name, as a Variant, so that a field that drifts into the responses is not lost.

Executors open the dumps through Arrow's file systems (local or mounted, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.sources.responses import ITEM_SCHEMAS, flatten

PAGE = re.compile(r"-page-(\d+)(?=\.[^/]*$|$)")


@dataclass
class Chain(InputPartition):
    """The pages of one answer, in order."""

    pages: tuple[str, ...]

    def __init__(self, pages: tuple[str, ...]) -> None:
        super().__init__(pages)
        self.pages = pages


def chains(paths: list[str]) -> list[tuple[str, ...]]:
    """Dumps that are pages of the same answer, together and by page number."""
    found: dict[str, list[tuple[int, str]]] = {}
    for path in paths:
        page = PAGE.search(path)
        found.setdefault(PAGE.sub("", path), []).append((int(page[1]) if page else 0, path))
    return [tuple(p for _, p in sorted(pages)) for _, pages in sorted(found.items())]


def names(columns: str, mark: str = " ") -> dict:
    """The fields of a column list, as a tree.  Executors have no session that could parse it."""
    found, depth, start = {}, 0, 0
    for place, letter in enumerate(f"{columns},"):
        depth += (letter == "<") - (letter == ">")
        if letter == "," and not depth:
            name, kind = columns[start:place].strip().split(mark, 1)
            inner = kind.removeprefix("struct<").removesuffix(">") if kind.startswith("struct<") else None
            found[name] = names(inner, ":") if inner else None
            start = place + 1
    return found


def unnamed(item, known: dict | None):
    """What an item has that its fields don't name; ``None`` if there is nothing."""
    if known is None or not isinstance(item, dict):
        return None
    rest = {k: v if k not in known else unnamed(v, known[k]) for k, v in item.items()}
    return {k: v for k, v in rest.items() if v is not None} or None


class ResponseSource(DataSource):
    """Rows of ``id``, ``body`` (a response with one item), ``stamp`` columns and ``extra`` as text."""

    @classmethod
    def name(cls) -> str:
        return "responses"

    def stamps(self) -> list[str]:
        return [c for c in (self.options.get("stamp") or "").split(",") if c]

    def schema(self) -> str:
        return ", ".join(["body string", "extra string", *[f"`{c}` string" for c in self.stamps()]])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = self.options.get("kind")
        if kind not in ITEM_SCHEMAS:
            raise ValueError(f"unknown response kind {kind!r}; use one of {sorted(ITEM_SCHEMAS)}")
        return ResponseReader(kind, self.options["path"], self.stamps())


class ResponseReader(DataSourceReader):
    def __init__(self, kind: str, path: str, stamps: list[str]) -> None:
        self.kind, self.path, self.stamps = kind, path, stamps

    def partitions(self) -> list[Chain]:
        """One for each chain of pages."""
        from pyarrow import fs

        system, path = _system(self.path)
        if "*" in path:
            folder, pattern = path.rsplit("/", 1)
            keep = re.compile(re.escape(pattern).replace(r"\*", "[^/]*") + r"\Z")
            infos = [i for i in system.get_file_info(fs.FileSelector(folder)) if keep.match(i.base_name)]
        else:
            info = system.get_file_info(path)
            infos = system.get_file_info(fs.FileSelector(path, recursive=True)) if info.type == fs.FileType.Directory else [info]
        files = [i.path for i in infos if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]
        return [Chain(pages) for pages in chains(files)]

    def read(self, partition: Chain) -> Iterator[tuple]:
        """Each item of the chain once."""
        system, _ = _system(self.path)
        known = names(ITEM_SCHEMAS[self.kind])
        seen: set[str] = set()
        for page in partition.pages:
            with system.open_input_stream(page) as stream:
                for line in _lines(stream):
                    yield from self._items(line, known, seen if len(partition.pages) > 1 else None)

    def _items(self, line: bytes, known: dict, seen: set[str] | None) -> Iterator[tuple]:
        try:
            dump = json.loads(line)
            items = json.loads(dump["body"]).get("items") or []
        except (ValueError, KeyError, TypeError, AttributeError):
            return  # no response
        for item in items:
            text = json.dumps(item, ensure_ascii=False)
            if seen is not None:
                if text in seen:
                    continue
                seen.add(text)
            rest = unnamed(item, known)
            yield (
                json.dumps({"items": [item]}, ensure_ascii=False),
                None if rest is None else json.dumps(rest, ensure_ascii=False),
                *(dump.get(c) for c in self.stamps),
            )


def _lines(stream) -> Iterator[bytes]:
    """The lines of a stream that are not blank."""
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from (x for x in whole if x.strip())
    if rest.strip():
        yield rest


def _system(path: str):
    """The file system of a path, and the path on it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path.rstrip("/")
    system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system, inner.rstrip("/")


def read_responses(spark: SparkSession, path: str, kind: str, stamp: list[str] | None = None) -> DataFrame:
    """All items of the dumps at ``path`` as flat rows, with ``extra`` as a Variant."""
    spark.dataSource.register(ResponseSource)
    rows = spark.read.format("responses").option("kind", kind).option("stamp", ",".join(stamp or [])).load(path)
    return flatten(rows.withColumn("extra", F.parse_json("extra")), kind, "body", [*(stamp or []), "extra"])

"""Operator 5: documents that hold passages of a benchmark.

An item is a run of words (letters and digits in lower case), its shingles of ``SHINGLE`` words are
counted, and a document's window of as many words is compared with it: the similarity is the
sum of the smaller counts over the sum of the larger ones (weighted Jaccard), and from
``SIMILAR`` on the document is linked to the item.

Windows are looked at where a document has enough shingles that some item of that length has,
since without them no window can be similar.  Each such window gets a SimHash over its shingles.
A multi-index finds all items whose SimHash is within ``RADIUS`` bits: of ``BLOCKS`` blocks of the
64 bits, one at least differs in no more than ``RADIUS // BLOCKS`` bits, and for each block all
values that near are looked up.  There is a multi-index for each length, as only items of the window's length are compared
with it, and windows are looked up some at a time, so that candidates stay within ``AT_ONCE``.  They
are verified by the exact similarity.

The index of a benchmark is sent to all executors as long as its texts are within
``SLICE_BYTES``; a larger one is dealt into slices by a hash, with a pass over the documents for
each.

Cases: null and empty texts have no links, and null and empty items link nothing; items of
fewer words than a shingle have one shingle, all their words; a document shorter than an item
is one window; equal items are all named; repeated rows have the same links; an empty table
gives no rows, an empty benchmark no links; ``clean`` keeps all columns, others are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import importable, in_slices, texts

SHINGLE = 5
SIMILAR = 0.8
RADIUS = 20
BLOCKS = 8
SLICE_BYTES = 16 << 20
#: Pairs of window and item that are looked at at once.
AT_ONCE = 1 << 18
WORD = re.compile(r"[^\W_]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

LINK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(words: list[str], size: int) -> list[int]:
    """Hashes of runs of ``size`` words."""
    return [xxhash.xxh64_intdigest(" ".join(words[k : k + size])) for k in range(len(words) - size + 1)]


def _simhash(found: list[int]) -> int:
    bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0) > len(found), bitorder="little").view("<u8")[0])


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of counted shingles."""
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def _near(bits: int, radius: int) -> np.ndarray:
    """All changes of up to ``radius`` of so many bits."""
    found = [sum(1 << k for k in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return np.array(found, np.uint64)


class Index:
    """Items of a benchmark by the hash blocks of their SimHash, and the shingles they have."""

    def __init__(self, items: list[tuple[int, str]]):
        by_words: dict[tuple, list[int]] = {}
        for name, text in items:
            if found := tuple(words_of(text)):
                by_words.setdefault(found, []).append(name)
        self.names = [sorted(n) for n in by_words.values()]
        self.size = np.array([len(w) for w in by_words], np.int64)
        self.numbers = {w: k + 1 for k, w in enumerate(sorted({x for words in by_words for x in words}))}
        self.counts = [Counter(shingles(list(w), min(SHINGLE, len(w)))) for w in by_words]
        self.code = np.array([_simhash(list(c.elements())) for c in self.counts], np.uint64)
        # for each length, the keys of the shingles that items of that length have
        own: dict[int, list[np.ndarray]] = {}
        every: dict[int, list[np.ndarray]] = {}
        for words in by_words:
            size = min(SHINGLE, len(words))
            keys = _keys(np.array([self.numbers[w] for w in words], np.uint64), size)
            own.setdefault(len(words), []).append(keys)
            every.setdefault(size, []).append(keys)
        self.keys = {length: np.unique(np.concatenate(k)) for length, k in own.items()}
        self.all_keys = {size: np.unique(np.concatenate(k)) for size, k in every.items()}
        width = 64 // BLOCKS
        self.near = _near(width, RADIUS // BLOCKS)
        self.blocks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        by_length = np.argsort(self.size, kind="stable")
        for length, items in zip(*_groups(self.size[by_length], by_length)):
            self.blocks[length] = []
            for b in range(BLOCKS):
                value = (self.code[items] >> np.uint64(b * width)) & np.uint64((1 << width) - 1)
                order = np.argsort(value, kind="stable")
                first = np.searchsorted(value[order], np.arange((1 << width) + 1))
                self.blocks[length].append((items[order], first))

    def candidates(self, codes: np.ndarray, length: int):
        """Pairs of window and item of a length within the radius, window by window."""
        width, blocks = 64 // BLOCKS, self.blocks[length]
        wanted = [
            (((codes >> np.uint64(b * width)) & np.uint64((1 << width) - 1))[:, None] ^ self.near[None, :]).astype(np.int64)
            for b in range(BLOCKS)
        ]
        sizes = sum((first[w + 1] - first[w]).sum(axis=1) for w, (_, first) in zip(wanted, blocks))
        part = np.cumsum(sizes) // AT_ONCE
        for start, stop in zip(*_edges(part)):
            found = []
            for near, (order, first) in zip(wanted, blocks):
                here = near[start:stop]
                at, n = first[here].ravel(), (first[here + 1] - first[here]).ravel()
                window = np.repeat(np.repeat(np.arange(start, stop), here.shape[1]), n)
                item = order[np.arange(len(window)) + np.repeat(at - np.cumsum(n) + n, n)]
                close = np.bitwise_count(codes[window] ^ self.code[item]) <= RADIUS
                found.append(window[close] * len(self.size) + item[close])
            pairs = np.unique(np.concatenate(found))
            yield from zip((pairs // len(self.size)).tolist(), (pairs % len(self.size)).tolist())

    def links(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """Each item that the text is linked to, with its best window."""
        if not self.names:
            return []
        words = words_of(text)
        number = np.fromiter(map(self.numbers.get, words, [0] * len(words)), np.uint64, len(words))
        anchors = {}
        for size, keys in self.all_keys.items():
            own = _keys(number, size)
            anchors[size] = own, own[np.isin(own, keys)] if _any_in(own, keys) else None
        best: dict[int, tuple[float, int, int]] = {}
        for length, keys in self.keys.items():
            size = min(SHINGLE, length)
            own, hits = anchors[size]
            if hits is None or not np.isin(hits, keys).any():
                continue
            n = min(length, len(words))
            has = np.concatenate(([0], np.cumsum(np.isin(own, keys))))
            span = n - size + 1
            enough = has[span:] - has[:-span] >= max(1, SIMILAR * (length - size + 1) - 1e-9)
            starts = np.flatnonzero(enough)
            for a in range(0, len(starts), 1024):
                self._verify(words, starts[a : a + 1024], n, size, length, best)
        return [
            (name, *best[item]) for item in sorted(best) for name in self.names[item]
        ]

    def _verify(self, words, starts, n, size, length, best) -> None:
        of = {}
        for s in starts.tolist():
            for k in range(s, s + n - size + 1):
                if k not in of:
                    of[k] = xxhash.xxh64_intdigest(" ".join(words[k : k + size]))
        windows = [[of[k] for k in range(s, s + n - size + 1)] for s in starts.tolist()]
        codes = np.array([_simhash(w) for w in windows], np.uint64)
        for window, item in self.candidates(codes, length):
            value = similarity(Counter(windows[window]), self.counts[item])
            if value >= SIMILAR and value > best.get(item, (0.0,))[0]:
                best[item] = value, int(starts[window]), n


def _keys(number: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of word numbers; zero where a word is no item's."""
    n = len(number) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    key, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(size):
        part = number[k : k + n]
        key = (key + part) * MULTIPLIER
        key ^= key >> np.uint64(29)
        known &= part > 0
    key[~known] = 0
    return key


def _edges(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal values start and stop."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)]).tolist()
    return starts, [*starts[1:], len(values)] if starts else []


def _groups(values: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The different ones of sorted values, and the rows of each."""
    starts, stops = _edges(values)
    return [int(values[a]) for a in starts], [rows[a:b] for a, b in zip(starts, stops)]


def _any_in(own: np.ndarray, keys: np.ndarray) -> bool:
    solid = own[own != 0]
    if not len(solid):
        return False
    row = np.minimum(np.searchsorted(keys, solid), len(keys) - 1)
    return bool((keys[row] == solid).any())


def indexes(benchmark: DataFrame):
    """The benchmark's indexes, of ``SLICE_BYTES`` each, as broadcast variables."""
    importable(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-total // SLICE_BYTES) or 1
    part = F.pmod(F.xxhash64("item_id"), F.lit(slices))
    for k in range(slices):
        rows = items.where(part == k).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(r.item_id, r.text) for r in rows]))


def links(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id`` and ``links``, an array of item, similarity and place, of each row."""
    found = texts(docs).withColumn("links", F.array().cast(T.ArrayType(LINK)))
    for index in indexes(benchmark):

        def add(batches, index=index):
            of = index.value
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))
            for batch in batches:
                rows = []
                for text, before in zip(batch["text"].to_pylist(), batch["links"].to_pylist()):
                    new = [dict(zip(("item_id", "similarity", "first_word", "n_words"), x)) for x in of.links(text)]
                    rows.append(before + new)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["text"], pa.array(rows, kind)], names=["doc_id", "text", "links"]
                )

        found = found.mapInArrow(add, found.schema)
    return found.select("doc_id", "links")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark."""
    for index in indexes(benchmark):

        def keep(batches, index=index):
            of = index.value
            for batch in in_slices(batches):
                yield batch.filter(pa.array([not of.links(t) for t in batch["text"].to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs

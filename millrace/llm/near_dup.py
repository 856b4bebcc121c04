"""Operator 7: near-duplicates by SimHash and a Gray-order hierarchical index.

A fingerprint has a bit set where more than half of the text's shingle hashes have it.  Two
fingerprints are linked if they differ in at most ``RADIUS`` bits; a class is what links reach.

Copies with one fingerprint are one entry of the index.  Its upper nodes are masked bit
patterns: the 64 bits are cut into blocks, and an entry stands below each choice of all but
``RADIUS`` blocks with the bits it has there.  Two linked entries agree in one such pattern
at least, so that each node can be searched by itself.  Below, entries are in the order of
their Gray rank, where neighbours differ in few bits, and runs of them form nodes again,
each with the bits that all of its entries share.  Pairs of nodes are compared from the top:
if the shared bits of two nodes differ in more than ``RADIUS`` places, no pair below can be
linked, and if all places that may differ are ``RADIUS`` or fewer, all of it is linked
without looking at any pair.  What a task finds leaves it as a spanning forest.

An upper node with more than ``PIECE`` entries, as a large group of near copies makes it, is
dealt into parts, and each pair of parts is a task of its own.  The number of blocks grows
with the number of entries, so that nodes stay small.

Cases: null and empty texts, and texts of white space, have the fingerprint zero and form a
class; a null id never is the smallest, and a class of null ids has the id null; repeated rows
are copies of each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import near_copies
from millrace.llm.common import free, partitions, stored, texts
from millrace.llm.components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
PIECE = 1024
FAN = 8
NO_ID = 2**63 - 1


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles, as an unsigned number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    parts = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(seed))
    n = max(1, len(words) - shingle + 1)
    return majority(np.fromiter(hashes, "<u8", n))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes, as an unsigned number; zero if there are none."""
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[a : a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``code``, the fingerprint as a signed long, of each row."""

    def codes(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in batch["text"].to_pylist()), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(found.view(np.int64))],
                names=["doc_id", "text_hash", "code"],
            )

    return (
        texts(docs)
        .select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        .mapInArrow(codes, "doc_id long, text_hash long, code long")
    )


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The places of bit patterns in the Gray order."""
    rank = codes.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    return rank


def blocks(n: int) -> int:
    """So many blocks that an upper node has some dozens of ``n`` even entries at most."""
    b = RADIUS + 1
    while n >> (64 * (b - RADIUS) // b) > 32 and b < 12:
        b += 1
    return b


def masks(b: int) -> list[int]:
    """The bits of each choice of all but ``RADIUS`` of ``b`` blocks."""
    edge = [64 * k // b for k in range(b + 1)]
    block = [(1 << edge[k + 1]) - (1 << edge[k]) for k in range(b)]
    return [sum(c) for c in combinations(block, b - RADIUS)]


def classes(prints: DataFrame) -> DataFrame:
    """``code``, ``component_id`` and ``class``, the code of its root, for each distinct code of ``fingerprints``."""
    entries = stored(
        prints.groupBy("code").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("least")), "codes"
    )
    roots = components(links(entries), "u", "v").select(
        F.col("node.code").alias("linked"), F.col("root.least").alias("root"), F.col("root.code").alias("root_code")
    )
    found = F.coalesce("root", "least")
    return entries.join(roots, F.col("code") == F.col("linked"), "left").select(
        "code", F.when(found < NO_ID, found).alias("component_id"), F.coalesce("root_code", "code").alias("class")
    )


def links(entries: DataFrame) -> DataFrame:
    """A spanning forest of the links between entries (code, least), as structs u and v."""
    spark = entries.sparkSession
    rank = F.col("code")
    for k in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, k))
    patterns = [
        F.struct(F.lit(k).alias("mask"), F.col("code").bitwiseAND(F.lit(m - (1 << 64 if m >> 63 else 0))).alias("bits"))
        for k, m in enumerate(masks(blocks(entries.count())))
    ]
    # ranks are unsigned: with the first bit turned, signed numbers have the same order
    below = entries.withColumn("rank", rank).withColumn("rank", F.expr("rank ^ (-9223372036854775807L - 1L)")).select(
        F.explode(F.array(*patterns)).alias("node"), "rank", "code", "least"
    ).select("node.mask", "node.bits", "rank", "code", "least")
    ranges = F.ceil(F.col("n") / PIECE).cast("int")
    sizes = stored(
        below.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1").select("mask", "bits", ranges.alias("parts")),
        "nodes",
    )
    # a large node is dealt into parts; each row goes to the pairs of parts that its part is in
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda t: F.struct(F.least("part", t).alias("s"), F.greatest("part", t).alias("t")),
    )
    tasks = (
        below.join(sizes, ["mask", "bits"])
        .withColumn("part", F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
        .withColumn("task", F.explode(pairs))
        .select("mask", "bits", "task.s", "task.t", "rank", "code", "least")
    )
    key = ["mask", "bits", "s", "t"]
    found = (
        tasks.repartition(partitions(spark), *key)
        .sortWithinPartitions(*key, "rank")
        .mapInArrow(_search, "u_least long, u_code long, v_least long, v_code long")
    )
    return found.select(
        F.struct(F.col("u_least").alias("least"), F.col("u_code").alias("code")).alias("u"),
        F.struct(F.col("v_least").alias("least"), F.col("v_code").alias("code")).alias("v"),
    )


def _search(batches):
    """Links within each task's rows, which come sorted by task and rank."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= 1 << 16:
            rows = pa.Table.from_batches(held)
            group = _groups(rows)
            cut = int(np.searchsorted(group, group[-1]))  # the last task may go on
            if cut:
                yield from _linked(rows.slice(0, cut), group[:cut])
            held, size = rows.slice(cut).to_batches(), size - cut
    if held:
        rows = pa.Table.from_batches(held)
        yield from _linked(rows, _groups(rows))


def _groups(rows: pa.Table) -> np.ndarray:
    new = np.zeros(len(rows), bool)
    for name in ("mask", "bits", "s", "t"):
        values = rows[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def _linked(rows: pa.Table, group: np.ndarray):
    code, least = rows["code"].to_numpy(), rows["least"].to_numpy()
    order = np.lexsort((code, least))
    first = np.ones(len(order), bool)
    first[1:] = (code[order[1:]] != code[order[:-1]]) | (least[order[1:]] != least[order[:-1]])
    entry = np.empty(len(order), np.int64)  # the smallest id has the smallest number
    entry[order] = np.cumsum(first) - 1
    label = np.arange(first.sum())
    for a, b in near_pairs(code.view(np.uint64), group, RADIUS):
        merge(label, entry[a], entry[b])
    member = np.flatnonzero(label != np.arange(len(label)))
    codes, ids = code[order[first]], least[order[first]]
    if len(member):
        root = label[member]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (ids[member], codes[member], ids[root], codes[root])],
            names=["u_least", "u_code", "v_least", "v_code"],
        )


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the ends of each pair one label, the smallest."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, below := label[label]):
            label[:] = below


def near_pairs(code: np.ndarray, group: np.ndarray, radius: int):
    """Pairs of rows that join all rows of a group that are linked, as arrays of row numbers.

    ``code`` is in Gray order within each group, and groups are runs of rows.
    """
    levels = [(code, code, group, np.arange(len(code) + 1))]
    while True:
        low, high, of, _ = levels[-1]
        start = np.flatnonzero(np.diff(of, prepend=-1))
        if len(start) == len(of):
            break
        within = np.arange(len(of)) - np.repeat(start, np.diff(np.append(start, len(of))))
        edge = np.flatnonzero(within % FAN == 0)
        levels.append(
            (np.bitwise_and.reduceat(low, edge), np.bitwise_or.reduceat(high, edge), of[edge], np.append(edge, len(of)))
        )
    top = np.arange(len(levels[-1][0]))
    yield from _descend(levels, len(levels) - 1, top, top, radius)


def _first_row(levels, level: int, node: np.ndarray) -> np.ndarray:
    for k in range(level, 0, -1):
        node = levels[k][3][node]
    return node


def _descend(levels, level: int, a: np.ndarray, b: np.ndarray, radius: int, at_once: int = 1 << 11):
    low, high, _, edge = levels[level]
    same_a, same_b = ~(low[a] ^ high[a]), ~(low[b] ^ high[b])
    differ = (low[a] ^ low[b]) & same_a & same_b
    near = np.bitwise_count(differ) <= radius
    sure = near & (np.bitwise_count(differ | ~same_a | ~same_b) <= radius)
    if level == 0:
        take = near & (a < b)
        yield a[take], b[take]
        return
    apart = sure & (a != b)
    if apart.any():
        yield _first_row(levels, level, a[apart]), _first_row(levels, level, b[apart])
    whole = a[sure & (a == b)]
    if len(whole):
        start, end = _first_row(levels, level, whole), _first_row(levels, level, whole + 1)
        n = end - start
        first = np.repeat(start, n)
        yield first, first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
    a, b = a[near & ~sure], b[near & ~sure]
    for k in range(0, len(a), at_once):
        x, y = a[k : k + at_once], b[k : k + at_once]
        nx, ny = edge[x + 1] - edge[x], edge[y + 1] - edge[y]
        n = nx * ny
        of = np.repeat(np.arange(len(x)), n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        i, j = edge[x][of] + place // ny[of], edge[y][of] + place % ny[of]
        keep = (x[of] != y[of]) | (i <= j)
        yield from _descend(levels, level - 1, i[keep], j[keep], radius)


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``code``, ``component_id`` and ``class`` of each row."""
    prints = stored(fingerprints(docs), "prints")
    found = stored(classes(prints), "classes")
    return prints.join(found, "code").select("doc_id", "text_hash", "code", "component_id", "class")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of near copies by similarity (``near_copies``), that of its smallest id."""
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = (
        near_copies.duplicate_classes(docs)
        .where(first)
        .groupBy("class")
        .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash")).alias("kept"))
    )
    # the same two keys in both, under names that docs doesn't have
    name, text_hash, number = (free(docs, n) for n in ("id", "hash", "number"))
    kept = kept.select(F.col("kept.id").alias(name), F.col("kept.text_hash").alias(text_hash))
    keyed = docs.withColumns(
        {
            name: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
            text_hash: F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
        }
    )
    # of rows that are equal one stays
    same = Window.partitionBy(name, text_hash).orderBy(name)
    return (
        keyed.join(kept, [name, text_hash], "left_semi")
        .withColumn(number, F.row_number().over(same))
        .where(F.col(number) == 1)
        .select(*docs.columns)
    )

"""Operator 13: repeated byte strings by the common-prefix interval tree of a sparse suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document with a
smaller id, or further left in the same one.  Strings are judged on the input.

* *Anchors.*  Of the places where ``gram`` bytes start in a window of ``LENGTH`` bytes, the one with the
  least hash is the window's anchor.  That depends on the window's bytes alone, so equal windows have
  the same anchor at the same offset, and only windows below equal anchors need be compared.  About one
  byte in 35 is an anchor.
* *Which anchors repeat.*  Anchor hashes and text hashes are shuffled; what repeats within a chunk of texts is
  noted there and sent once, so that a common passage costs one row for each chunk.
* *Contexts.*  For anchors that repeat, the bytes of their windows before and after them are taken from the text.
  Of equal contexts in a chunk the earliest is sent on, the others are repeats at once.
* *Interval tree.*  In each group of anchors the strings after them are sorted: a suffix array of the
  anchors, with the length of the prefix that neighbours share.  One scan with a stack gives every interval, that is
  every repeated string with *all* its occurrences, and the next shorter one around it.  If
  the bytes before the occurrences differ (left-diverse), the same scan over the reversed bytes splits
  them into the groups of each left extension.  All but the earliest of a group are repeats.
* *Large groups* are dealt at random into parts of ``PART`` members.  What is not the earliest of its part goes; members
  of which some window is, go on to the next round, there below a longer string that half of
  their windows share: groups of unlike contexts fall apart, groups of like ones shrink to one member a part.

Hashes choose what is compared; bytes decide.  Exact copies of whole texts are settled by SHA-256 before.

Cases: null text is empty; texts shorter than ``LENGTH`` bytes stay as they are; a null id comes after all
others; of different texts with the same id, the one with the smaller 64-bit hash is the earlier; rows with the same id
and text are the same document and get the same result; an empty table gives no rows; long texts
are cut into overlapping pieces for anchors; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_slices, partitions, stored, texts

LENGTH = 100
GRAM = 32
#: Members of a group that are compared at once.
PART = 16_384
#: Bytes of texts that are compared with each other before the shuffle, and of which anchors are sought at once.
CHUNK = 3_000_000
PIECE = 400_000
#: Halvings of the windows of an anchor until one is left.
LEVELS = 7

KEY = "late boolean, doc long, t long"
MEMBER = f"key long, {KEY}, place int, low int, high int, before binary, after binary"
_MEMBER = pa.schema(
    [("key", pa.int64()), ("late", pa.bool_()), ("doc", pa.int64()), ("t", pa.int64()), ("place", pa.int32()),
     ("low", pa.int32()), ("high", pa.int32()), ("before", pa.binary()), ("after", pa.binary())]
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_RANK = np.uint64(127)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def gram_of(length: int) -> int:
    """The bytes of an anchor: at most 128 of them start in a window."""
    return max(min(GRAM, length), length - 127)


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram`` bytes."""
    hashes, size, factor = data.astype(np.uint64) + np.uint64(1), 1, _FACTOR
    while 2 * size <= gram:
        hashes = hashes[:-size] * factor + hashes[size:]
        size *= 2
        with np.errstate(over="ignore"):
            factor = factor * factor
    if size < gram:
        hashes = _mixed(hashes[: len(data) - gram + 1]) + hashes[gram - size :] * _FACTOR
    return _mixed(hashes)


def anchors(pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Piece, place there, least and greatest offset in its windows, and hash of each anchor, in order."""
    found, first, size = [], 0, 0
    for last, piece in enumerate(pieces):
        size += len(piece)
        if size >= PIECE or last == len(pieces) - 1:
            which, *rest = _anchors(pieces[first : last + 1], length)
            found.append((which + first, *rest))
            first, size = last + 1, 0
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _anchors(pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    if not (sizes >= length).any():
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    gram = gram_of(length)
    width = length - gram + 1
    hashes = _grams(data, gram)
    blocks = np.full((-(-len(hashes) // width), width), 2**64 - 1, np.uint64)
    blocks.ravel()[: len(hashes)] = hashes & ~_RANK
    blocks |= np.arange(width, dtype=np.uint64)  # so the first of equal ones is the least
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.cumsum(sizes) - sizes
    inside = np.zeros(len(data) + 1, np.int8)
    long = sizes >= length
    inside[starts[long]] += 1
    inside[(starts + sizes)[long] - length + 1] -= 1
    window = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    a, b = back[window], ahead[window + width - 1]
    first = (a >> np.uint64(7)) <= (b >> np.uint64(7))
    rank = (np.where(first, a, b) & _RANK).astype(np.int64)
    place = np.where(first, window, window + width - 1) // width * width + rank
    change = np.flatnonzero(np.diff(place, prepend=-1))
    at, until = place[change], np.append(change[1:], len(place)) - 1
    which = np.searchsorted(starts + sizes, at, side="right")
    return which, at - starts[which], at - window[until], at - window[change], hashes[at]


def _chunks(rows, length: int):
    """Lists of (key, offset in its text, bytes) of about ``CHUNK`` bytes; a text longer than ``PIECE`` is cut so that no
    window is lost."""
    held, size = [], 0
    for key, text in rows:
        for a in range(0, max(1, len(text) - length + 1), PIECE):
            piece = text if len(text) <= PIECE else text[a : a + PIECE + length - 1]
            held.append((key, a, piece))
            size += len(piece)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def intervals(shared: list[int]):
    """Value, first and last member, and value of the next shorter one around it, of each interval of a list
    of the lengths that neighbours share; the whole list has -1 around it."""
    stack = [(-1, 0)]
    for i, value in enumerate([*shared, -1]):
        left = i
        while stack[-1][0] > value:
            top, left = stack.pop()
            yield top, left, i, max(value, stack[-1][0])
        if stack[-1][0] < value:
            stack.append((value, left))


def _shared(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


def _sorted(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of strings, and what neighbours share."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    return order, [_shared(strings[a], strings[b]) for a, b in zip(order, order[1:])]


def repeated(orders: list[tuple], before: list[bytes], after: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each member the ranges of offsets whose windows another member, smaller in ``orders``, has as well.

    ``before`` holds the bytes before the members, last first.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in orders]

    def note(group, low, high):
        earliest = min(orders[i] for i in group)
        for i in group:
            if orders[i] != earliest:
                found[i].append((low, high))

    order, shared = _sorted(after)
    for value, i, j, outer in intervals(shared):
        # windows at these offsets end within this string, and beyond the next shorter one
        low, high = max(0, length - value), length - outer - 1
        group = order[i : j + 1]
        high = min(high, max(len(before[k]) for k in group))
        if low > high:
            continue
        if len({before[k][:high] for k in group}) == 1:
            note(group, low, high)
            continue
        inner, left = _sorted([before[k] for k in group])
        for extent, x, y, around in intervals(left):
            if extent >= low and around < high:
                note([group[k] for k in inner[x : y + 1]], max(low, around + 1), min(high, extent))
    return found


def _spans(ranges, place: int, length: int):
    """The bytes that windows at these offsets cover, as spans."""
    return [(place - high, place + length - low) for low, high in ranges]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch, as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _MEMBER)]
    return pa.RecordBatch.from_arrays(columns, schema=_MEMBER)


def _written(members: list[tuple], covers: dict[tuple, list], size: int = 8192):
    """Members, and covered spans as rows without bytes: start in ``place``, end in ``low``."""
    rows = members
    for key, spans in covers.items():
        rows.extend((key[2], *key, start, end, 0, None, None) for start, end in merged(spans))
    for a in range(0, len(rows), size):
        yield _rows(rows[a : a + size])


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and what names a document here: ``late``, ``doc`` and ``t``."""
    return texts(docs).select(
        "doc_id", F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("doc"),
        F.xxhash64("text").alias("t"), "text",
    )


def _first_copies(rows: DataFrame, length: int) -> DataFrame:
    """Key, ``n_bytes`` and whether it is the ``first`` of its copies, for each document of ``length`` bytes or more."""
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    some = rows.where(F.octet_length("text") >= length)
    some = some.select("late", "doc", "t", F.octet_length("text").alias("n_bytes"), digest).distinct()
    least = some.groupBy("digest").agg(F.min(F.struct("late", "doc", "t")).alias("least"))
    return some.join(least, "digest").select(
        "late", "doc", "t", "n_bytes", (F.struct("late", "doc", "t") == F.col("least")).alias("first")
    )


def _wanted(rows: DataFrame, length: int) -> DataFrame:
    """For each text hash ``t`` the upper halves of the anchor hashes that occur elsewhere, or twice there."""

    def gather(batches):
        def pairs():
            for batch in in_slices(batches):
                yield from zip(batch["t"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist())

        for chunk in _chunks(pairs(), length):
            which, place, _, _, hashes = anchors([piece for *_, piece in chunk], length)
            names = np.array([t for t, *_ in chunk], np.int64)
            order = np.lexsort((which, hashes))
            which, hashes = which[order], hashes[order]
            again = np.append(False, (hashes[1:] == hashes[:-1]) & (which[1:] == which[:-1]))
            t = names[which]
            start = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
            if not len(start):
                continue
            many = np.logical_or.reduceat(again, start) | (np.minimum.reduceat(t, start) != np.maximum.reduceat(t, start))
            yield _hashes(hashes[start].view(np.int64), t[start], many.astype(np.int8))
            here = np.repeat(many, np.diff(np.append(start, len(hashes)))) & ~again
            yield _hashes(t[here], hashes[here].view(np.int64), np.full(int(here.sum()), 2, np.int8))

    def detect(batches):
        held = None  # the last hash so far, a text that has it, and whether it is known to repeat
        for batch in batches:
            key, other, flag = (batch[c].to_numpy() for c in ("key", "other", "flag"))
            known = flag == 2
            yield _found(key[known], other[known])
            key, other, many = key[~known], other[~known], flag[~known] == 1
            if held:
                key, other, many = (np.append(np.array([h], x.dtype), x) for h, x in zip(held, (key, other, many)))
            if not len(key):
                continue
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            run = np.minimum.reduceat(other, start) != np.maximum.reduceat(other, start)
            run |= np.logical_or.reduceat(many, start)
            tell = np.repeat(run, np.diff(np.append(start, len(key)))) & ~many
            yield _found(other[tell], key[tell])
            held = (key[-1], other[-1], run[-1])

    n = partitions(rows.sparkSession)
    some = rows.where(F.octet_length("text") >= length).select("t", "text")
    sent = some.mapInArrow(gather, "key long, other long, flag byte")
    sent = sent.repartition(n, "key").sortWithinPartitions("key", "flag")
    return sent.mapInArrow(detect, "t long, half int").groupBy("t").agg(F.collect_list("half").alias("halves"))


def _hashes(key: np.ndarray, other: np.ndarray, flag: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(other), pa.array(flag)], names=["key", "other", "flag"])


def _found(t: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(t), pa.array((hashes >> 32).astype(np.int32))], names=["t", "half"])


def _packed(rows: DataFrame, length: int) -> DataFrame:
    """The rows of ``length`` bytes or more, texts compressed for the shuffle."""

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in in_slices(batches):
            small = pa.array([squeeze(t) for t in batch["text"].cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "late", "doc", "t")), small], names=names)

    names = ["doc_id", "late", "doc", "t", "packed"]
    return rows.where(F.octet_length("text") >= length).mapInArrow(pack, f"doc_id long, {KEY}, packed binary")


def _members(packed: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """Members of groups, and spans that are covered by what is in the same chunk."""

    def take(batches):
        def pairs():
            unpack = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                names = zip(*(batch[c].to_pylist() for c in ("late", "doc", "t")))
                for name, halves, text in zip(names, batch["halves"], batch["packed"]):
                    yield (name, halves.values.to_numpy()), unpack(text.as_py())

        for chunk in _chunks(pairs(), length):
            pieces = [piece for *_, piece in chunk]
            which, place, low, high, hashes = anchors(pieces, length)
            half = (hashes.view(np.int64) >> 32).astype(np.int32)
            ends = np.searchsorted(which, np.arange(len(chunk) + 1))
            seen: dict[tuple, tuple] = {}
            covers: dict[tuple, list] = {}
            for k, ((name, halves), offset, piece) in enumerate(chunk):
                own = slice(ends[k], ends[k + 1])
                keep = np.flatnonzero(np.isin(half[own], halves)) + ends[k]
                columns = (x[keep].tolist() for x in (place, low, high, hashes.view(np.int64)))
                for p, a, b, h in zip(*columns):
                    key = (h, piece[p - b : p], piece[p : p + length - a])
                    row = (name, offset + p, a, b)
                    first = seen.get(key)
                    if first is None or row < first:
                        seen[key], first, row = row, row, first
                    if row and row != first:
                        covers.setdefault(row[0], []).append((row[1] - b, row[1] + length - a))
            yield from _written([(h, *n, p, a, b, x, y) for (h, x, y), (n, p, a, b) in seen.items()], covers)

    return packed.join(asked, ["late", "doc", "t"]).drop("doc_id").mapInArrow(take, MEMBER)


def _scanned(members: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """Covered spans, and of members that were dealt into parts those that go on."""
    deal = F.pmod(F.xxhash64("late", "doc", "t", "place", "low"), F.col("parts"))
    dealt = members.join(parts, "key", "left").withColumn("part", F.coalesce(deal, F.lit(-1).cast("long")))

    def scan(batches):
        def groups():
            key, held, last = None, [], None
            for batch in batches:
                for row in zip(*(batch[c].to_pylist() for c in ("key", "part", *_MEMBER.names[1:]))):
                    if row[:8] == last:
                        continue  # a repeated row's
                    last = row[:8]
                    if row[:2] != key:
                        if held:
                            yield key[1] >= 0, held
                        key, held = row[:2], []
                    held.append((row[0], *row[2:]))
            if held:
                yield key[1] >= 0, held

        rest, covers = [], {}
        for more, rows in groups():
            if len(rows) > 1:
                found = repeated([r[1:5] for r in rows], [r[7][::-1] for r in rows], [r[8] for r in rows], length)
                for row, ranges in zip(rows, found):
                    if ranges:
                        covers.setdefault(row[1:4], []).extend(_spans(ranges, row[4], length))
            else:
                found = [[]]
            if more:
                rest.extend(filter(None, (_left(row, ranges, length) for row, ranges in zip(rows, found))))
            if len(rest) + len(covers) >= 4096:
                yield from _written(rest, covers)
                rest, covers = [], {}
        yield from _written(rest, covers)

    n = partitions(members.sparkSession)
    dealt = dealt.repartition(n, "key", "part").sortWithinPartitions("key", "part", "late", "doc", "t", "place", "low", "high")
    return dealt.select("part", *_MEMBER.names).mapInArrow(scan, MEMBER)


def _left(row: tuple, ranges: list[tuple[int, int]], length: int) -> tuple | None:
    """The member with the windows that no smaller one of its part has."""
    key, late, doc, t, place, low, high, before, after = row
    gone = merged([(a, b + 1) for a, b in ranges])
    first, last = low, high
    for a, b in gone:
        if a <= first < b:
            first = b
    for a, b in reversed(gone):
        if a <= last < b:
            last = a - 1
    if first > last:
        return None
    return key, late, doc, t, place, first, last, before[len(before) - last :], after[: length - first]


def _narrowed(members: DataFrame, level: int, length: int) -> DataFrame:
    """The members below longer strings, each shared by the windows of one of ``2 ** level`` ranges of offsets."""
    width = length - gram_of(length) + 1

    def narrow(batches):
        for batch in batches:
            rows = []
            for _, *name, place, low, high, before, after in zip(*(batch[c].to_pylist() for c in _MEMBER.names)):
                for cell in range(1 << level):
                    least, most = cell * width >> level, ((cell + 1) * width >> level) - 1
                    a, b = max(low, least), min(high, most)
                    if a > b:
                        continue
                    core = before[len(before) - least :] + after[: length - most]
                    key = xxhash.xxh64_intdigest(core, (level << 8) + cell)
                    key -= (key >> 63) << 64
                    rows.append((key, *name, place, a, b, before[len(before) - b :], after[: length - a]))
            if rows:
                yield _rows(rows)

    return members.mapInArrow(narrow, MEMBER)


def covered(rows: DataFrame, length: int = LENGTH, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """Spans of first copies that are covered, by key, and the table of first copies."""
    copies = stored(_first_copies(rows, length), "copies")
    asked = copies.where("first").join(_wanted(rows, length), "t").select("late", "doc", "t", "halves")
    members = stored(_members(_packed(rows, length), asked, length), "members")
    spans, level = [members.where("before IS NULL")], 0
    while True:
        members = members.where("before IS NOT NULL")
        large = members.groupBy("key").count().where(F.col("count") > part)
        parts = stored(large.select("key", F.ceil(F.col("count") / part).alias("parts")), "parts")
        found = stored(_scanned(members, parts, length), "repeats")
        spans.append(found.where("before IS NULL"))
        if parts.isEmpty():
            break
        level = min(level + 1, LEVELS)
        members = stored(_narrowed(found.where("before IS NOT NULL"), level, length), "members")
    every = reduce(DataFrame.union, spans)
    return every.select("late", "doc", "t", F.col("place").alias("start"), F.col("low").alias("end")), copies


def remove(docs: DataFrame, length: int = LENGTH, part: int = PART) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed ``spans`` (maximal, in order) and the ``kept`` bytes of each row."""
    rows = keyed(docs)
    spans, copies = covered(rows, length, part)
    whole = copies.where(~F.col("first")).select("late", "doc", "t", F.lit(0).alias("start"), F.col("n_bytes").alias("end"))
    cut = spans.union(whole).groupBy("late", "doc", "t").agg(F.collect_list(F.struct("start", "end")).alias("cut"))

    def keep(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for a in range(0, len(batch), 256):
                part_ = batch.slice(a, 256)
                sizes, spans_, kept = [], [], []
                for packed, found in zip(part_["packed"], part_["cut"].to_pylist()):
                    text = unpack(packed.as_py())
                    gone = merged([(s["start"], s["end"]) for s in found or ()])
                    edges = [0, *(x for span in gone for x in span), len(text)]
                    sizes.append(len(text))
                    spans_.append([{"start": s, "end": e} for s, e in gone])
                    kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2])))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part_["doc_id"], pa.array(sizes, pa.int64()), pa.array(spans_, kind), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    result = "doc_id long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    long = _packed(rows, length).join(cut, ["late", "doc", "t"], "left").select("doc_id", "packed", "cut").mapInArrow(keep, result)
    short = rows.where(F.octet_length("text") < length).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"), F.col("text").cast("binary").alias("kept"),
    )
    return long.unionByName(short)

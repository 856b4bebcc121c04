"""Operator 4: documents packed into sequences of bounded length.

A document is its ids and an end id; one that is longer than a sequence is cut into pieces of
that length, and only such a one.  The pieces are dealt to groups of about ``GROUP_SEQUENCES``
sequences.  In each group, best fit in descending order gives a first packing, and a local
search mends it: it moves a piece out of a sequence, the emptiest first, exchanges it for a smaller
one elsewhere, or exchanges two for one, always so that the sum of the squared fills rises, until
no sequence has an exchange left, or the free space is less than one sequence, when no packing of
the group can be better.

The number of groups grows with the ids, so a group has about the same size at any input, and
at most about one sequence in ``GROUP_SEQUENCES`` is lost to the borders between groups.
Pieces are dealt by a running number, not by a key, so that no value can make a group large.

Cases: null text is empty, a piece with the end id alone; repeated rows are packed each for
itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_batches, stored, texts
from millrace.llm.encoding import encoder, with_end

GROUP_SEQUENCES = 4096
#: Where texts are so short that this comes first, a group has about so many pieces.
GROUP_PIECES = 1 << 18

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("slot", pa.int64()),
    ]
)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, slot long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """The pieces of each document; ``slot`` numbers them."""

    def cut(batches):
        ids = encoder(tokenizer)

        def rows():
            slot = TaskContext.get().partitionId() << 33
            for batch in batches:
                for name, found in zip(batch["doc_id"].to_pylist(), ids.documents(batch["text"])):
                    found = with_end(found, end_id).astype("<u4").tobytes()
                    for k, a in enumerate(range(0, len(found), 4 * size)):
                        part = found[a : a + 4 * size]
                        yield name, k, a // 4, len(part) // 4, zlib.crc32(part), slot
                        slot += 1

        yield from in_batches(rows(), PIECE)

    return texts(docs).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 2048) -> DataFrame:
    """Each piece with its sequence and its place there."""
    found = stored(pieces(docs, tokenizer, end_id, size), "pieces")
    ids, rows = found.agg(F.sum("length"), F.count("*")).first()
    groups = max(-(-(ids or 0) // (GROUP_SEQUENCES * size)), -(-rows // GROUP_PIECES), 1)
    group = F.pmod(F.xxhash64("slot"), F.lit(groups)).alias("group")

    def place(key, frame):
        frame = frame.sort_values("slot", ignore_index=True)
        bins = fill(frame["length"].to_numpy(), size)
        order = np.array([i for b in bins for i in b], dtype=np.int64)
        sizes = np.array([len(b) for b in bins], dtype=np.int64)
        length = frame["length"].to_numpy()[order]
        ends = np.cumsum(length)
        firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        offset = ends - length - np.repeat((ends - length)[firsts], sizes)
        out = frame.iloc[order][["doc_id", "piece", "start", "length", "ids_crc32"]]
        return out.assign(
            sequence_id=(int(key[0]) << 32) + np.repeat(np.arange(len(bins)), sizes), offset=offset
        )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "slot"]
    return found.select(group, *columns).groupBy("group").applyInPandas(place, PACKED)


def fill(length: np.ndarray, size: int) -> list[list[int]]:
    """Pieces, by number, in sequences of at most ``size``."""
    bins, free = best_fit(length, size)
    if sum(free) >= size:
        bins = exchange(length, size, bins, free)
    return bins


def best_fit(length: np.ndarray, size: int) -> tuple[list[list[int]], list[int]]:
    """Best fit, longest first: a bit set of free sizes finds the tightest sequence at once."""
    bins: list[list[int]] = []
    free: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    present = 0
    lengths = length.tolist()
    for item in np.argsort(-length, kind="stable").tolist():
        need = lengths[item]
        fits = present >> need
        if fits:
            room = need + ((fits & -fits).bit_length() - 1)
            chosen = by_free[room].pop()
            if not by_free[room]:
                present ^= 1 << room
        else:
            room, chosen = size, len(bins)
            bins.append([])
            free.append(size)
        bins[chosen].append(item)
        left = room - need
        free[chosen] = left
        if left:
            if not by_free[left]:
                present |= 1 << left
            by_free[left].append(chosen)
    return bins, free


def exchange(length: np.ndarray, size: int, bins: list[list[int]], free: list[int]) -> list[list[int]]:
    """Local search between sequences that have room; each step raises the sum of squared fills.

    A sequence without an exchange stays a target and a partner of the others, and gets its turn
    again after a change: the search ends when no sequence has an exchange left.
    """
    open_bins = [b for b in range(len(bins)) if free[b]]
    kept = [bins[b] for b in range(len(bins)) if not free[b]]
    held = [list(bins[b]) for b in open_bins]
    room = np.array([free[b] for b in open_bins])
    spare = int(room.sum())
    item = np.array([i for b in held for i in b])
    size_of = length[item].astype(np.int64)
    place = np.repeat(np.arange(len(held)), [len(b) for b in held])
    where = {i: k for k, i in enumerate(item.tolist())}
    waiting = np.ones(len(held), bool)
    changed = False  # since all were put into the queue
    while spare >= size:
        if not waiting.any():
            if not changed:
                break
            waiting, changed = room < size, False
        donor = int(np.argmax(np.where(waiting, room, -1)))
        to = _improve(donor, held, room, size, item, size_of, place, where)
        if to is None:
            waiting[donor] = False
            continue
        changed = waiting[to] = True
        if not held[donor]:
            waiting[donor] = False
            spare -= size
    return kept + [b for b in held if b]


def _improve(donor, held, room, size, item, size_of, place, where) -> int | None:
    """One exchange that takes ids out of ``donor``: the partner's number, or none if there is no exchange.

    The squares rise where the partner has less room afterwards than ``donor`` had before.
    """
    own = int(room[donor])
    mine = sorted(held[donor], key=lambda i: -size_of[where[i]])
    sizes = size_of[[where[i] for i in mine]]
    # a move into the tightest sequence with room
    targets = np.where(room < size, room, -1)
    targets[donor] = -1
    for a, need in zip(mine, sizes.tolist()):
        enough = np.flatnonzero((targets >= need) & (targets - need < own))
        if len(enough):
            to = int(enough[np.argmin(targets[enough])])
            _swap(donor, to, [a], [], held, room, size_of, place, where)
            return to
    # equal pieces in sequences with equal room are one choice
    other = np.flatnonzero((place != donor) & (room[place] > 0))
    _, first = np.unique(size_of[other] * (size + 1) + room[place[other]], return_index=True)
    other = other[first]
    # one for one: a smaller piece, as much smaller as the room allows
    found = _largest(sizes, size_of[other], room[place[other]], own)
    if found:
        given, k = [mine[found[0]]], other[found[1]]
    else:  # two of the donor for one elsewhere
        x, y = np.triu_indices(len(mine), 1)
        both, first = np.unique(sizes[x] + sizes[y], return_index=True)
        found = _largest(both, size_of[other], room[place[other]], own)
        if not found:
            return None
        pair = first[found[0]]
        given, k = [mine[x[pair]], mine[y[pair]]], other[found[1]]
    to = int(place[k])
    _swap(donor, to, given, [int(item[k])], held, room, size_of, place, where)
    return to


def _largest(given, taken, room, own, at_once: int = 1 << 20) -> tuple[int, int] | None:
    """Places in ``given`` and ``taken`` of the exchange that moves most, if there is one."""
    best, found = 0, None
    step = max(1, at_once // max(1, len(taken)))
    for a in range(0, len(given) if len(taken) else 0, step):
        gain = given[a : a + step, None] - taken[None, :]
        gain[(gain > room) | (room - gain >= own)] = 0
        k = int(np.argmax(gain))
        if gain.flat[k] > best:
            best, found = gain.flat[k], (a + k // len(taken), k % len(taken))
    return found


def _swap(donor, to, given, taken, held, room, size_of, place, where) -> None:
    moved = sum(int(size_of[where[i]]) for i in given) - sum(int(size_of[where[i]]) for i in taken)
    for i in given:
        held[donor].remove(i)
        held[to].append(i)
        place[where[i]] = to
    for i in taken:
        held[to].remove(i)
        held[donor].append(i)
        place[where[i]] = donor
    room[donor] += moved
    room[to] -= moved

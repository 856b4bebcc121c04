"""Operator 12: runs of words that repeat with a period, by multi-scale minimizers.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are the same) that no
neighbouring word extends, and at least ``max(LEAST, TIMES * q)`` words long.

* Periods up to ``DIRECT`` are found by comparing the words with themselves at each such lag.
* For each scale ``k``, a power of two, the hashes of all stretches of ``k`` words are taken, and of
  every window of ``k/2`` of them the least is selected.  Inside a run of period ``q``, ``k/2 < q <= k``,
  windows ``q`` apart hold the same words, so what one selects the other selects ``q`` further on; as a
  run has four periods, both windows fit into it.  Stretches of ``k >= q`` words that are less than
  ``q`` apart differ inside a run, so the two are neighbours in the list of selected places of that hash.
  Each such pair of neighbours, ``k/2`` to ``k`` apart, is a seed, and none is missed.
* A seed is extended in both directions by comparing words at its distance, so hashes decide
  where to look and never what is a run.

Of one stretch found with several periods the least counts: the others are its multiples.

Documents are worked on where they are read, many short ones at once with a word between them that is
nowhere else; a scale looks only at those that are long enough for it.  Nothing is shuffled.

Cases: null text is empty and has no words and no runs; a null id stays null; repeated rows give
repeated rows; an empty table gives no rows; a very long text is worked on alone; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import in_slices, texts

LEAST = 6
TIMES = 4
#: Periods that are found by comparing at each lag; the first scale is twice as large.
DIRECT = 8
#: Words that are worked on at once, unless one document has more.
WORDS = 400_000

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads what is close."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or greatest) of each window, from running ones of blocks in both directions."""
    one, fill = (np.minimum, 2**64 - 1) if least else (np.maximum, 0)
    blocks = np.full((-(-len(x) // width), width), fill, np.uint64)
    blocks.ravel()[: len(x)] = x
    ahead = one.accumulate(blocks, axis=1).ravel()
    back = one.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return one(back[: len(x) - width + 1], ahead[width - 1 : len(x)])


def selected(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places whose hash is the least of a window of ``width``."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    least = np.concatenate((np.zeros(width - 1, np.uint64), _sliding(hashes, width, True), np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(_sliding(least, width, False) == hashes)


def seeds(words: np.ndarray, lengths: np.ndarray):
    """Places and distances at which runs of periods above ``DIRECT`` may repeat; longest documents stand first."""
    k, factor = 1, _FACTOR
    hashes = _mixed(words.astype(np.uint64) * _FACTOR + np.uint64(1))
    ends = np.cumsum(lengths + 1)
    while True:
        long = int(np.searchsorted(-lengths, -TIMES * (k // 2 + 1), side="right"))
        stop = int(ends[long - 1]) if long else 0  # shorter documents have no run of this scale
        if stop <= k:
            return
        if k > DIRECT:
            mixed = _mixed(hashes[: stop - k + 1])
            places = selected(mixed, k // 2)
            found = mixed[places]
            order = np.argsort(found, kind="stable")
            apart = places[order][1:] - places[order][:-1]
            pairs = np.flatnonzero((found[order][1:] == found[order][:-1]) & (2 * apart > k) & (apart <= k))
            yield places[order][pairs], apart[pairs]
        hashes = hashes[:-k] * factor + hashes[k:]
        with np.errstate(over="ignore"):
            factor = factor * factor
        k *= 2


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    return edges[::2], edges[1::2] - edges[::2]


def _extended(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The places around ``place`` up to which each word is the same as that ``lag`` further on."""
    stop, step = place, 2 * lag
    while stop + lag < len(words):
        a, b = words[stop : stop + step], words[stop + lag : stop + lag + step]
        differ = np.flatnonzero(a[: len(b)] != b)
        if len(differ):
            stop += int(differ[0])
            break
        stop, step = stop + len(b), 2 * step
    start, step = place, 2 * lag
    while start:
        first = max(0, start - step)
        differ = np.flatnonzero(words[first:start] != words[first + lag : start + lag])
        if len(differ):
            start = first + int(differ[-1]) + 1
            break
        start, step = first, 2 * step
    return start, stop


def runs(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, length and period of every run of the documents, whose words stand one after the other.

    ``words`` are numbers; each document is followed by one that is nowhere else, and has no more words
    than the one before.
    """
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, DIRECT + 1):
        starts, sizes = _stretches(words[:-lag] == words[lag:])
        keep = sizes + lag >= max(LEAST, TIMES * lag)
        for start, size in zip(starts[keep].tolist(), sizes[keep].tolist()):
            found.setdefault((start, size + lag), lag)
    for places, lags in seeds(words, lengths):
        order = np.lexsort((places, lags))
        last, done = 0, 0
        for place, lag in zip(places[order].tolist(), lags[order].tolist()):
            if lag == last and place < done:
                continue  # in a stretch that has been extended
            start, stop = _extended(words, place, lag)
            last, done = lag, stop
            if stop - start + lag >= max(LEAST, TIMES * lag):
                key = (start, stop - start + lag)
                found[key] = min(lag, found.get(key, lag))
    return sorted((start, length, period) for (start, length), period in found.items())


def _worked(held: list[tuple], numbers: dict[bytes, int]) -> pa.RecordBatch:
    """The result rows of some documents."""
    order = sorted(range(len(held)), key=lambda i: -len(held[i][1]))
    lengths = np.array([len(held[i][1]) for i in order], np.int64)
    words = np.empty(int(lengths.sum()) + len(held), np.int64)
    firsts = np.cumsum(lengths + 1) - lengths - 1
    for rank, i in enumerate(order):
        a, n = int(firsts[rank]), len(held[i][1])
        words[a : a + n] = [numbers.setdefault(w, len(numbers)) for w in held[i][1]]
        words[a + n] = -1 - rank
    of: list[list[tuple]] = [[] for _ in held]
    for start, length, period in runs(words, lengths):
        rank = int(np.searchsorted(firsts, start, side="right")) - 1
        of[order[rank]].append((start - int(firsts[rank]), length, period))
    kept = []
    for (_, own), found in zip(held, of):
        if found:
            drop = np.zeros(len(own) + 1, np.int64)
            for start, length, period in found:
                drop[start + period] += 1
                drop[start + length] -= 1
            own = [w for w, gone in zip(own, np.cumsum(drop).tolist()) if not gone]
        kept.append(b" ".join(own).decode())
    flat = [r for found in of for r in found]
    columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
    offsets = np.concatenate(([0], np.cumsum([len(found) for found in of]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
    return pa.RecordBatch.from_arrays(
        [pa.array([name for name, _ in held], pa.int64()), pa.array([len(w) for _, w in held], pa.int64()), lists, pa.array(kept)],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def find(docs: DataFrame, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, the ``runs`` by start and period, and ``collapsed``: the words, joined by
    one space, without those that a run contains after its first period.

    ``prepare`` may change the words of a document before they are looked at.
    """

    def scan(batches):
        held, count, numbers = [], 0, {}
        for batch in in_slices(batches):
            for name, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                words = text.split()
                if prepare:
                    words = prepare(name, words)
                held.append((name, words))
                count += len(words) + 1
                if count >= WORDS:
                    yield _worked(held, numbers)
                    held, count, numbers = [], 0, {}
        if held:
            yield _worked(held, numbers)

    return texts(docs).mapInArrow(scan, f"doc_id long, n_words long, runs {RUNS}, collapsed string")

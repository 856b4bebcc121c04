"""Operator 8: text quality by compression.

Two zstandard dictionaries are built, from pieces of good and of bad labelled texts.  A text is cut
into chunks, as a dictionary helps most at the start, and all chunks are compressed with
either.  The difference of the two compressed sizes, normalised by the root of their sum, so that a long text's
counts for more than a short one's and not in proportion, is turned into a probability by a logistic curve
fitted on labelled texts that are in neither dictionary, weighted by how often each label occurs.

The fit uses a bounded sample: for each label the ``SAMPLE`` labelled documents that come first by a hash
of their id, of a text longer than ``LONGEST`` characters so many from a place that a hash chooses.  Every text
is scored in whole.

Cases: a label all of whose texts are long is learned like any other; null text is empty and has the size of an empty frame; documents with labels that
contradict each other, or null, are not learned from; with one label only the score is its
share, and 0.5 without any; repeated rows have the same score; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import texts

SAMPLE = 1500
LONGEST = 8_000
DICTIONARY = 112 << 10
#: Bytes of the pieces that a dictionary is built from, and of the chunks that are compressed.
PIECE = 512
CHUNK = 2048
LEVEL = 3


@dataclass
class Compression:
    """Two dictionaries and the curve; ``curve`` is None where there is one label at most."""

    good: bytes
    bad: bytes
    curve: list[float] | None
    share: float

    def scorer(self):
        if self.curve is None:
            return lambda text: self.share
        good, bad, curve = _compressor(self.good), _compressor(self.bad), self.curve

        def score(text: str) -> float:
            x = curve[0] + curve[1] * difference(text, good, bad)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))

        return score


def _compressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=zstandard.ZstdCompressionDict(dictionary),
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


def difference(text: str, good, bad) -> float:
    """The normalised difference of compressed sizes, positive for text like the good texts."""
    raw = text.encode()
    chunks = [raw[k : k + CHUNK] for k in range(0, len(raw), CHUNK)] or [b""]
    a, b = (sum(len(c.compress(x)) for x in chunks) for c in (good, bad))
    return (b - a) / math.sqrt(a + b)


def build(samples: list[str]) -> bytes:
    """A dictionary from texts; where they are too few to train one, the texts themselves."""
    import zstandard

    raw = [t.encode() for t in samples]
    chunks = [t[k : k + PIECE] for t in raw for k in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[-DICTIONARY:] or b"\n" * 8


def fit(docs: DataFrame, labels: DataFrame, learn) -> Compression:
    """``labels`` has doc_id and quality; ``learn`` is the condition for a doc_id to learn from."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(learn & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select("doc_id", "quality")
    )
    counts = {r.quality: r["count"] for r in marked.groupBy("quality").count().collect()}
    if not counts:
        return Compression(b"", b"", None, 0.5)
    share = counts.get(1, 0) / sum(counts.values())
    if len(counts) == 1:
        return Compression(b"", b"", None, share)
    order = F.xxhash64("doc_id")
    # a label may have no document; twice as many ids as are wanted, whose number the parameter bounds
    first = [marked.where(F.col("quality") == q).orderBy(order, "doc_id").limit(2 * SAMPLE) for q in (0, 1)]
    length = F.length("text")
    start = F.when(length > LONGEST, F.pmod(F.xxhash64("text", "doc_id"), length - (LONGEST - 1))).otherwise(0)
    found = (
        texts(docs)
        .join(F.broadcast(first[0].union(first[1])), "doc_id")
        .select("doc_id", F.substring("text", (start + 1).cast("int"), F.lit(LONGEST)).alias("text"), "quality")
    )
    best = [found.where(F.col("quality") == q).orderBy(order, "doc_id", "text").limit(SAMPLE) for q in (0, 1)]
    rows = best[0].union(best[1]).collect()
    by = {q: [r.text for r in rows if r.quality == q] for q in (0, 1)}
    if not by[0] or not by[1]:
        return Compression(b"", b"", None, share)
    # two thirds build the dictionaries, the rest fits the curve
    parts = {q: ([t for k, t in enumerate(by[q]) if k % 3], by[q][::3]) for q in by}
    good, bad = build(parts[1][0]), build(parts[0][0])
    compressors = _compressor(good), _compressor(bad)
    x = np.array([[1.0, difference(t, *compressors)] for q in (0, 1) for t in parts[q][1]])
    y = np.repeat([0.0, 1.0], [len(parts[0][1]), len(parts[1][1])])
    weight = np.where(y == 1, share / len(parts[1][1]), (1 - share) / len(parts[0][1])) * len(y)
    return Compression(good, bad, logistic(x, y, weight).tolist(), share)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic curve by Newton's method, with a small penalty on all but the constant."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    z, w = x / scale, np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - penalty @ w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w / scale


def score(docs: DataFrame, model: Compression) -> DataFrame:
    """``doc_id`` and ``score``, higher for text like the good texts, of each row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY bytes at most

    def rate(batches):
        of = shared.value.scorer()
        for batch in batches:
            found = [of(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.float64())], names=["doc_id", "score"])

    return texts(docs).mapInArrow(rate, "doc_id long, score double")

"""Operator 9: exact top-k by inner product with MaxScore.

Vectors are rows of integers; each dimension is a term, and its postings in a shard are the
values of the shard's vectors.  A term's bound is the largest product it can add in the shard
above the smallest one.  With the terms in the order of their bounds, those at the end whose
bounds together cannot lift a vector over the k-th best score so far are non-essential.  The
postings of the essential terms are traversed for all vectors of the shard; then the other
terms are probed one by one for the vectors that can still reach the threshold, until the
vectors left have whole scores.  Bounds are exact integers, and a vector that can tie with the
threshold stays, so the result is that of a full comparison.

Shards are packed runs of rows, and queries packed blocks.  A shard meets a block by a join on
the block's number; blocks are broadcast as long as they are within ``BROADCAST_BYTES``, and
shuffled beyond.  Each pair gives its best k for each query, and these are merged.

Cases: vectors that are null or hold null or non-finite components take no part; shorter
vectors are filled with zeros; where components are so large that a score, or a sum of bounds, may pass
63 bits, :func:`top` fails and says so; rows with the query's own id are no candidates of it; a repeated
query row is answered each for itself, a repeated candidate may fill several ranks; fewer
than k candidates give fewer rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import importable, in_batches, stored

SHARD = 4096
BLOCK = 512
BROADCAST_BYTES = 16 << 20
#: Sums of products up to here, and their differences, fit into 64 bits.
LIMIT = 1 << 61
PACK = "pack long, size int, width int, ids binary, rows binary, vectors binary"


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``vector``: floor(scale * x) of each component; unfit vectors are left out."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(
        whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    ).where(F.coalesce(finite, F.lit(False))).select(
        "vec_id", F.transform(whole, lambda x: F.floor(x * scale).cast("long")).alias("vector")
    )


def packs(vectors: DataFrame, rows: int) -> DataFrame:
    """Runs of at most ``rows`` vectors as arrays of bytes; ``rows`` numbers the vectors."""
    importable(vectors.sparkSession)
    schema = pa.schema(
        [("pack", pa.int64()), ("size", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("vectors", pa.binary())]
    )

    def gather(batches):
        first = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        size = 0

        def pack(table):
            lengths = table["vector"].combine_chunks().value_lengths().to_numpy()
            values = table["vector"].combine_chunks().flatten().to_numpy()
            width = int(lengths.max(initial=0))
            matrix = np.zeros((len(table), width), "<i8")
            row = np.repeat(np.arange(len(table)), lengths)
            matrix[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
            number = np.arange(first, first + len(table), dtype="<i8")
            ids = table["vec_id"].to_numpy().astype("<i8")
            return first, len(table), width, ids.tobytes(), number.tobytes(), matrix.tobytes()

        for batch in batches:
            start = 0
            while start < len(batch):
                part = batch.slice(start, rows - size)
                held.append(part)
                size, start = size + len(part), start + len(part)
                if size == rows:
                    yield from in_batches([pack(pa.Table.from_batches(held))], schema)
                    first, held, size = first + rows, [], 0
        if held:
            yield from in_batches([pack(pa.Table.from_batches(held))], schema)

    return vectors.mapInArrow(gather, PACK)


def top(vectors: DataFrame, queries, k: int, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best for each row that fulfils ``queries``."""
    whole = integers(vectors, scale)
    largest = whole.agg(
        F.max(F.array_max(F.transform("vector", F.abs))).alias("value"), F.max(F.size("vector")).alias("width")
    ).first()
    if largest.value and largest.value**2 * largest.width > LIMIT:
        raise ValueError(f"components up to {largest.value} in {largest.width} dimensions give scores beyond 63 bits")
    shards = packs(whole, SHARD)
    asked = stored(packs(whole.where(queries), BLOCK), "queries")
    total = asked.agg(F.sum(F.length("vectors"))).first()[0] or 0
    # the blocks, one for BLOCK queries, by a running number; each shard meets each block once
    names = sorted(r.pack for r in asked.select("pack").collect())
    numbers = vectors.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "pack long, q_pack long")
    blocks = asked.join(F.broadcast(numbers), "pack")
    blocks = blocks.select("q_pack", *(F.col(c).alias(f"q_{c}") for c in asked.columns if c != "pack"))
    if total <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    every = F.sequence(F.lit(0), F.lit(max(len(names) - 1, 0))).cast("array<long>")
    pairs = shards.withColumn("q_pack", F.explode(every)).join(blocks, "q_pack")
    found = pairs.mapInArrow(_search(k), "query long, query_id long, vec_id long, row long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


FOUND = pa.schema([(name, pa.int64()) for name in ("query", "query_id", "vec_id", "row", "score")])


def _search(k: int):
    def search(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, rows = (np.frombuffer(r[name], "<i8") for name in ("ids", "rows"))
                vectors = np.frombuffer(r["vectors"], "<i8").reshape(r["size"], r["width"])
                q_ids, q_rows = (np.frombuffer(r[f"q_{name}"], "<i8") for name in ("ids", "rows"))
                asked = np.frombuffer(r["q_vectors"], "<i8").reshape(r["q_size"], r["q_width"])
                width = min(r["width"], r["q_width"])
                shard = Shard(ids, vectors[:, :width])

                def best(shard=shard, rows=rows, q_ids=q_ids, q_rows=q_rows, asked=asked, width=width):
                    for number, name, vector in zip(q_rows.tolist(), q_ids.tolist(), asked[:, :width]):
                        for place, score in shard.best(vector, name, k):
                            yield number, name, int(shard.ids[place]), int(rows[place]), score

                yield from in_batches(best(), FOUND)

    return search


class Shard:
    """Postings of a shard: for each term (dimension) the values of all vectors, and their limits."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seeds: int = 64):
        self.ids = ids
        self.postings = np.ascontiguousarray(vectors.T)
        self.high = vectors.max(axis=0, initial=np.iinfo(np.int64).min)
        self.low = vectors.min(axis=0, initial=np.iinfo(np.int64).max)
        # vectors whose whole scores give a first threshold: the longest ones
        length = (vectors.astype(float) ** 2).sum(axis=1)
        self.seeds = np.argsort(-length, kind="stable")[:seeds]

    def best(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """Places and scores of the k best vectors, ties to the smaller id."""
        candidate = self.ids != own
        terms = np.flatnonzero(query)
        top = np.maximum(query * self.high, query * self.low)[terms]
        bottom = np.minimum(query * self.high, query * self.low)[terms]
        # what a term can add above what each vector has of it
        bound = top - bottom
        order = np.argsort(-bound, kind="stable")
        terms, bound = terms[order], bound[order]
        floor = int(bottom.sum())
        seeds = self.seeds[candidate[self.seeds]]
        first = np.sort(query @ self.postings[:, seeds])[::-1]
        threshold = int(first[k - 1]) if len(first) >= k else None
        # the longest tail of terms that cannot lift a vector to the threshold is non-essential
        tail = np.append(np.cumsum(bound[::-1])[::-1], 0)
        essential = len(terms)
        if threshold is not None:
            essential = int(np.argmax(floor + tail < threshold)) if (floor + tail < threshold).any() else len(terms)
        head = terms[:essential]
        places = np.flatnonzero(candidate)
        part = query[head] @ self.postings[head][:, places] if len(head) else np.zeros(len(places), np.int64)
        lows = np.append(np.cumsum(np.minimum(query * self.high, query * self.low)[terms][::-1])[::-1], 0)
        for t in range(essential, len(terms) + 1):
            # whole score: what is known, the least of the terms left, and at most their bounds
            least = part + lows[t]
            if len(least) >= k:
                reached = int(np.partition(least, -k)[-k])
                threshold = reached if threshold is None else max(threshold, reached)
            if threshold is not None:
                keep = least + tail[t] >= threshold
                places, part = places[keep], part[keep]
            if t < len(terms):
                part = part + query[terms[t]] * self.postings[terms[t], places]
        order = np.lexsort((self.ids[places], -part))[:k]
        return [(int(places[o]), int(part[o])) for o in order]

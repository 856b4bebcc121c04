"""Near copies by the exact Jaccard similarity of word shingles, without comparing all pairs.

A text is the set of its shingles of ``SHINGLE`` words (lower-case ASCII, split at white space); a
shorter text is one shingle.  Two texts are linked if their sets' Jaccard similarity is at
least 4/5, and a class is what links reach.  Every link is verified on the whole sets, and no link
is missed:

* With the shingles of all texts in one order, two linked sets of ``n`` and ``m`` shingles have
  one in common among the first ``n - ceil(4n/5) + 1`` and ``m - ceil(4m/5) + 1`` (prefix filter), and
  one more for each by which both prefixes are longer.  Texts meet below the shingles of prefixes that are
  longer by ``more(n)``.  Shingles that a bounded sample of texts shows to be common are last in the order, so that
  they hardly ever stand in a prefix; which ones the sample shows changes the work, not the result.
* A pair is looked at only where both sets have enough left: of two sets with ``n`` and ``m`` shingles, the first
  one in common is at most at place ``n - 4/9 (n + m)`` of the one and ``m - 4/9 (n + m)`` of the other.  Up to
  ``more(n)`` and ``more(m)`` places further they have one more in common for each place of the lesser.  Long texts
  that share a phrase by chance, whose pairs grow with the square of the corpus, share one shingle there, not several.
* Sets with SimHash fingerprints that differ in few bits are compared first: the Gray-order index of ``near_dup``, over
  fingerprints of the shingles here, gives a spanning forest of them.  At a similarity of 4/5 fingerprints differ
  in 10 of 64 bits with a spread of 3, and a radius that misses none would hold a fixed share of all pairs of clean
  texts, so the index alone is not enough.
* Below every shingle the texts are compared with one of them, a hub, and where there are more than ``LARGE``
  texts with up to ``HUBS`` of them, so that a group of ``n`` near copies costs some times ``n`` comparisons.  Shingles that
  are common stand last in a prefix, so the text that has a shingle at the first place has the fewest of its own
  before it: it is in the middle of its group, and near to most.  A text and a hub whose fingerprints differ in more than
  ``ALIKE`` bits are left for later.  What index and hubs link is one class already.  Then
  texts of different classes below a shingle are candidates if what they share up to their
  last shingle in common, and what is left of both after it, still allow the similarity.

A table is deleted when nothing reads it any more, so the disk holds what one step needs and not all of them.

Cases: null and empty texts, and texts of white space, form a class; a null id never is the
smallest, and a class of null ids has the id null; texts with the same set are one entry;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import near_dup
from millrace.llm.common import in_slices, packed, partitions, scratch, stored, texts, unpacked
from millrace.llm.components import components

SHINGLE = 5
LARGE = 64
HUBS = 12
#: Bits in which the fingerprints of a text and a hub may differ; at a similarity of 4/5 they differ in 10, by chance in 32.
ALIKE = 20
#: One more shingle in a prefix for so many of a set.
PER_MORE = 50
#: Texts of the sample for the order of shingles, and the most shingles that it may put last.
SAMPLE = 16_000
COMMON = 200_000
SEED = 42


def shingles(text: str) -> np.ndarray:
    """The hashes of the text's shingles, sorted, each once."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    parts = zip(*(words[k:] for k in range(SHINGLE))) if len(words) >= SHINGLE else [words]
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(SEED))
    return np.unique(np.fromiter(hashes, np.uint64, max(1, len(words) - SHINGLE + 1)))


def code_of(found: np.ndarray) -> int:
    """A signed number for a set."""
    return int(np.array([xxhash.xxh64_intdigest(found.tobytes())], np.uint64).view(np.int64)[0])


def more(n: int) -> int:
    """By how many shingles the prefix of a set is longer than it has to be for one in common."""
    return 1 + n // PER_MORE


def prefix(found: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of which a linked set has ``more`` and one in its own prefix; common ones come last, by rank."""
    n = len(found)
    if not n:
        return found
    late = np.zeros(n, np.int64)
    if len(common):
        row = np.minimum(np.searchsorted(common, found), len(common) - 1)
        late = np.where(common[row] == found, rank[row], 0)
    return found[np.argsort(late, kind="stable")[: n - -(-4 * n // 5) + 1 + more(n)]]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least 4/5."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * shared >= 4 * (len(a) + len(b) - shared)


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample have, sorted, and their ranks from one."""
    rows = docs.count()
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    chosen = texts(docs).distinct().where(place < min(1.0, SAMPLE / max(rows, 1)))

    def each(batches):
        for batch in in_slices(batches):
            for text in batch["text"].to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text).view(np.int64))], names=["shingle"])

    found = chosen.select("text").mapInArrow(each, "shingle long").groupBy("shingle").count().where("count > 1")
    top = found.orderBy(F.desc("count"), "shingle").limit(COMMON).toArrow()
    keys, rank = top["shingle"].to_numpy().view(np.uint64), top["count"].to_numpy()
    order = np.argsort(keys)
    return keys[order], rank[order]


def entries(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``code``, ``print``, the number ``size`` of shingles and the ``prefix`` of each row."""
    order = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))  # bounded by COMMON

    def sets(batches):
        common, rank = order.value
        for batch in in_slices(batches):
            found = [shingles(t) for t in batch["text"].to_pylist()]
            columns = [
                pa.array([code_of(s) for s in found], pa.int64()),
                pa.array(np.fromiter(map(near_dup.majority, found), np.uint64, len(found)).view(np.int64)),
                pa.array([len(s) for s in found], pa.int32()),
                pa.array([prefix(s, common, rank).view(np.int64) for s in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], *columns], names=["doc_id", "text_hash", "code", "print", "size", "prefix"]
            )

    return (
        texts(docs)
        .select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        .mapInArrow(sets, "doc_id long, text_hash long, code long, print long, size int, prefix array<long>")
    )


def members(found: DataFrame) -> DataFrame:
    """``shingle``, its ``place`` in the set, ``code`` and ``size`` for the prefix shingles that more than one set has."""
    one = found.dropDuplicates(["code"]).select(F.posexplode("prefix").alias("place", "shingle"), "code", "size")
    return (
        one.repartition(partitions(found.sparkSession), "shingle")
        .sortWithinPartitions("shingle")
        .mapInArrow(_shared, "place int, shingle long, code long, size int")
    )


def _shared(batches):
    """The rows whose shingle is not alone; rows come sorted by it, and no more than a batch is held."""
    last, told = None, True
    for batch in batches:
        if not len(batch):
            continue
        keys = batch["shingle"].to_numpy()
        again = np.append(False, keys[1:] == keys[:-1])
        again[0] = last is not None and last["shingle"][0].as_py() == keys[0]
        if again[0] and not told:
            yield last
        keep = again.copy()
        keep[:-1] |= again[1:]
        yield batch.filter(pa.array(keep))
        last, told = batch.slice(len(batch) - 1), bool(keep[-1])


def _enough(one: str, other: str, further=lambda size: F.lit(0)):
    """Whether what both sets have from their places on, or from so much further to the front, still allows the similarity."""
    need = 4 * (F.col(f"{one}.size") + F.col(f"{other}.size"))
    left = [9 * (F.col(f"{x}.size") - F.col(f"{x}.place") + further(F.col(f"{x}.size"))) for x in (one, other)]
    return (left[0] >= need) & (left[1] >= need)


def _more(size):
    """``more`` of a column."""
    return 1 + F.floor(size / PER_MORE)


def _indexed(found: DataFrame) -> DataFrame:
    """Pairs ``a`` and ``b`` that join all sets with fingerprints that the index links."""
    sets = stored(found.groupBy("code").agg(F.min("print").alias("print")), "prints")
    entries = stored(sets.groupBy(F.col("print").alias("code")).agg(F.min("code").alias("least")), "fingerprints")
    # sets with one fingerprint are paired with the smallest of them
    same = sets.join(entries.withColumnRenamed("code", "print"), "print").where("code <> least")
    near = near_dup.links(entries).select(F.col("u.least").alias("a"), F.col("v.least").alias("b"))
    pairs = near.union(same.select("code", "least"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _with_hubs(below: DataFrame) -> DataFrame:
    """Pairs ``a`` and ``b`` of a text and a hub of a shingle that may be linked."""

    def hub(k):  # every other one by its place, the rest anywhere
        first = F.lit(0) if k % 2 else F.col("place")
        return F.min(F.struct(first.alias("p"), F.xxhash64("code", F.lit(k)).alias("h"), "code", "size", "place")).alias(f"h{k}")

    one = stored(below.groupBy("shingle").agg(F.count("*").alias("n"), hub(0)), "hubs")
    large = below.join(one.where(F.col("n") > LARGE).select("shingle"), "shingle", "left_semi")
    more = large.groupBy("shingle").agg(*(hub(k) for k in range(1, HUBS)))
    more = more.select("shingle", F.explode(F.array(*(f"h{k}" for k in range(1, HUBS)))).alias("h"))
    hubs = one.select("shingle", F.col("h0").alias("h")).union(more).select("shingle", "h.code", "h.size", "h.place").distinct()
    a, b = below.alias("a"), hubs.alias("b")
    apart = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.code") != F.col("b.code")) & _enough("a", "b")
    return a.join(b, apart).select(F.least("a.code", "b.code").alias("a"), F.greatest("a.code", "b.code").alias("b"))


def _open(below: DataFrame, roots: DataFrame) -> DataFrame:
    """The members with their classes, below the shingles of which several classes are left."""
    classed = below.join(roots, "code", "left")
    classed = stored(classed.select("shingle", "place", "code", "size", F.coalesce("root", "code").alias("root")), "classed")
    several = classed.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return classed.join(several.select("shingle"), "shingle", "left_semi")


def _close(below: DataFrame) -> DataFrame:
    """Pairs ``a`` and ``b`` of texts of different classes (``root``) that may be linked, each once.

    What two sets share up to their last shingle in common here is what is counted; beyond it
    they share at most what is left of the shorter one.  All that they share in the first places of both is
    counted, and linked sets share one there and ``more`` of the lesser, or all that they need.
    """
    a, b = below.alias("a"), below.alias("b")
    sizes = (5 * F.col("a.size") >= 4 * F.col("b.size")) & (5 * F.col("b.size") >= 4 * F.col("a.size"))
    apart = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") < F.col("b.root")) & sizes & _enough("a", "b", _more)
    found = (
        a.join(b, apart)
        .groupBy(F.least("a.code", "b.code").alias("a"), F.greatest("a.code", "b.code").alias("b"))
        .agg(
            F.count("*").alias("shared"), F.max(F.col("a.size") + F.col("b.size")).alias("sum"),
            F.min(F.least("a.size", "b.size")).alias("lesser"),
            F.min(F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place")) - 1).alias("left"),
        )
    )
    several = F.col("shared") >= F.least(F.ceil(4 * F.col("sum") / 9), 1 + _more(F.col("lesser")))
    return found.where(several & (9 * (F.col("shared") + F.col("left")) >= 4 * F.col("sum"))).select("a", "b")


def _sets(docs: DataFrame, found: DataFrame, codes: DataFrame) -> DataFrame:
    """``code`` and ``shingles``, the whole set, of each of ``codes``."""
    wanted = found.join(codes, "code", "left_semi").groupBy("code").agg(F.min("text_hash").alias("h"))
    wanted = stored(wanted.select("h").distinct(), "wanted")

    def sets(batches):
        for batch in in_slices(batches):
            each = [shingles(t) for t in unpacked(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([code_of(s) for s in each], pa.int64()), pa.array([s.tobytes() for s in each], pa.binary())],
                names=["code", "shingles"],
            )

    whole = packed(texts(docs).select(F.xxhash64("text").alias("h"), "text"))
    # written between the two, so that no stage has two Python workers for each task
    chosen = stored(whole.join(wanted, "h", "left_semi").select("text"), "chosen")
    return chosen.mapInArrow(sets, "code long, shingles binary").dropDuplicates(["code"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked."""
    a = sets.select(F.col("code").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("code").alias("b"), F.col("shingles").alias("y"))

    def check(batches):
        for batch in in_slices(batches):
            x, y = batch["x"].to_pylist(), batch["y"].to_pylist()
            keep = [linked(np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)) for s, t in zip(x, y)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _alike(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose fingerprints differ in ``ALIKE`` bits at most; ``_close`` looks at the others."""
    prints = stored(found.groupBy("code").agg(F.min("print").alias("print")), "prints")
    a, b = (prints.select(F.col("code").alias(x), F.col("print").alias(f"{x}_print")) for x in ("a", "b"))
    bits = F.bit_count(F.col("a_print").bitwiseXOR(F.col("b_print")))
    return pairs.distinct().join(a, "a").join(b, "b").where(bits <= ALIKE).select("a", "b")


def _good(docs: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked ones of ``pairs``, stored."""
    with scratch() as keep:
        with scratch() as keep_sets:
            codes = stored(_codes(pairs).distinct(), "codes")
            sets = keep_sets(stored(_sets(docs, found, codes), "sets"))
        return keep(stored(_verified(pairs, sets), "good"))


def links(docs: DataFrame, found: DataFrame, below: DataFrame) -> DataFrame:
    """Linked pairs ``a`` and ``b`` of codes; their components are those of all linked pairs."""
    with scratch() as keep:
        first = keep(stored(_alike(_with_hubs(below), found).union(_indexed(found)).distinct(), "pairs"))
    good = _good(docs, found, first)
    with scratch() as keep:
        roots = stored(components(good, "a", "b"), "roots").withColumnRenamed("node", "code")
        rest = keep(stored(_close(_open(below, roots)).join(first, ["a", "b"], "left_anti"), "rest"))
    return good.union(_good(docs, found, rest))


def _codes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("code")).union(pairs.select("b"))


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``code``, ``component_id`` and ``class``, a code, of each row."""
    with scratch() as keep:
        with scratch() as keep_below:
            made = stored(entries(docs), "entries")
            below = keep_below(stored(members(made), "members"))
            found = keep_below(stored(made.select("doc_id", "text_hash", "code", "print"), "codes"))
        roots = keep(stored(components(links(docs, keep(found), below), "a", "b"), "roots"))
    rows = found.select("doc_id", "text_hash", "code").join(roots, F.col("code") == F.col("node"), "left")
    rows = rows.select("doc_id", "text_hash", "code", F.coalesce("root", "code").alias("class"))
    least = rows.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "class").select("doc_id", "text_hash", "code", "component_id", "class")

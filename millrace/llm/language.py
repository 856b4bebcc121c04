"""Operator 3: language identification by interpolated Kneser-Ney character models.

Each language has a character model of order ``ORDER`` over lower-case letters, all else being
one space.  The n-grams of all languages are kept in one sorted array of hashes for each
order, beside a table with a log-probability for each language; contexts have their back-off
weights in the same way.  A text's language is that of the lowest cross-entropy for each
character, over its whole length.

A part of the sample, not learned from, calibrates two things: the power of the length at
which the cross-entropies become probabilities, and for each language the usual
cross-entropy.  A text whose cross-entropy is far above the usual one is rejected.

The fit uses a bounded sample: of each language ``SAMPLE`` documents, fewer where there are more than
eight languages, chosen by a hash of their id and text; of a text longer than ``LONGEST`` characters, so many from
a place that the hash chooses as well.  Of more than ``ALL_SAMPLES`` languages, the most frequent are learned.

Cases: a language all of whose texts are long is learned like any other; documents without id are chosen by their
texts, and rows that are equal by the order of that hash; null texts and texts without a letter are ``und`` with score 0 and are rejected;
documents without a language are not learned from; without any language everything is
``und``; of equal languages the first by name wins; repeated rows get the same result; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import importable, in_slices

ORDER = 4
SAMPLE = 1000
ALL_SAMPLES = 8_000
LONGEST = 4_000
#: A text is rejected this many spreads above the usual cross-entropy; a spread is at least
#: ``SPREAD``, so that a text in two of the languages stays.
REJECT = 8.0
SPREAD = 0.15
#: The variance of the cross-entropy that one character adds to a short text's.
NOISE = 3.0
UNKNOWN = "und"
OTHER = re.compile(r"[\W\d_]+")
#: An odd multiplier for hashes of n-grams, which are taken modulo 2**64.
MULTIPLIER = 0x9E3779B97F4A7C15
POWERS = (0.25, 0.35, 0.5, 0.65, 0.8, 1.0)


def letters(text: str | None) -> np.ndarray | None:
    """Code points of the letters in lower case, with one space for all else; None without a letter."""
    plain = OTHER.sub(" ", (text or "").lower())
    if not any(map(str.isalpha, plain)):
        return None
    return np.frombuffer(f" {plain.strip()} ".encode("utf-32-le"), np.uint32).astype(np.uint64)


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that end at each place from n - 1 on."""
    multiplier = np.uint64(MULTIPLIER)
    size = len(codes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out *= multiplier
        out += codes[k : k + size] + np.uint64(1)
    return out


def longer(contexts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of contexts followed by one more character."""
    return contexts * np.uint64(MULTIPLIER) + codes + np.uint64(1)


@dataclass
class Languages:
    """``keys[n]`` are sorted hashes of n-grams and ``logp[n]`` their log-probabilities by language;
    ``weights[n]`` are the log back-off weights of the n-grams as contexts, beside ``contexts[n]``."""

    names: list[str] = field(default_factory=list)
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    logp: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    weights: dict[int, np.ndarray] = field(default_factory=dict)
    floor: np.ndarray | None = None
    power: float = 0.5
    usual: np.ndarray | None = None

    def logs(self, codes: np.ndarray) -> np.ndarray:
        """Log-probabilities of all characters but the first, a row each and a column for each language."""
        total = np.zeros((len(codes) - 1, len(self.names)))
        for n in range(2, ORDER + 1):  # the first characters have shorter contexts
            where = np.array([n - 2]) if n < ORDER else np.arange(ORDER - 2, len(codes) - 1)
            self._at(codes, where[where < len(total)], n, total)
        return total

    def _at(self, codes: np.ndarray, where: np.ndarray, n: int, total: np.ndarray) -> None:
        while len(where):
            if n == 0:
                total[where] += self.floor
                return
            all_grams = grams(codes, n)
            row, known = find(self.keys[n], all_grams[where + 2 - n])
            total[where[known]] += self.logp[n][row[known]]
            where = where[~known]
            if n > 1 and len(where):
                context = grams(codes, n - 1)[where + 2 - n]
                row, known = find(self.contexts[n - 1], context)
                total[where[known]] += self.weights[n - 1][row[known]]
            n -= 1

    def entropies(self, codes: np.ndarray, at_once: int = 1 << 17) -> np.ndarray:
        """Cross-entropy for each character by language."""
        total = np.zeros(len(self.names))
        for a in range(0, len(codes) - 1, at_once):
            low = max(0, a - ORDER)
            part = self.logs(codes[low : a + at_once + 1])
            total += part[a - low :].sum(axis=0)
        return -total / (len(codes) - 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability, and whether the text is rejected."""
        codes = letters(text)
        if codes is None or not self.names:
            return UNKNOWN, 0.0, True
        n = len(codes) - 1
        entropy = self.entropies(codes)
        best = int(np.argmin(entropy))
        odds = np.exp(-np.minimum(700, n**self.power * (entropy - entropy[best])))
        mean, spread = self.usual[best]
        wide = (max(spread, SPREAD) ** 2 + NOISE / n) ** 0.5
        return self.names[best], float(1 / odds.sum()), bool(entropy[best] > mean + REJECT * wide)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``wanted`` in the sorted ``keys``, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    row = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return row, keys[row] == wanted


def train(samples: dict[str, list[str]]) -> Languages:
    """A model from texts by language; every fourth text calibrates it."""
    codes = {name: [c for t in texts if (c := letters(t)) is not None] for name, texts in samples.items()}
    names = sorted(name for name in codes if codes[name])
    model = Languages(names)
    if not names:
        return model
    held = {name: codes[name][3::4] or codes[name] for name in names}
    tables = [_counts([c for k, c in enumerate(codes[name]) if k % 4 != 3]) for name in names]
    _tables(model, tables)
    seen = [(k, len(c) - 1, model.entropies(c)) for k, name in enumerate(names) for c in held[name]]
    loss = {}
    for power in POWERS:
        total = 0.0
        for k, n, entropy in seen:
            x = -(n**power) * (entropy - entropy.min())
            total += np.log(np.exp(x).sum()) - x[k]
        loss[power] = total
    model.power = min(POWERS, key=lambda p: loss[p])
    model.usual = np.zeros((len(names), 2))
    for k in range(len(names)):
        own = np.array([entropy[k] for language, _, entropy in seen if language == k])
        model.usual[k] = own.mean(), own.std()
    return model


def _counts(texts: list[np.ndarray]) -> dict[int, tuple]:
    """For each order: n-gram hashes, their context's, suffix's hashes, and Kneser-Ney counts."""
    found = {}
    for n in range(ORDER, 0, -1):
        parts = [(grams(c, n), grams(c, n - 1)[: len(c) - n + 1], grams(c, n - 1)[-(len(c) - n + 1) :]) for c in texts if len(c) >= n]
        if not parts:
            found[n] = tuple(np.empty(0, np.uint64) for _ in range(3)) + (np.empty(0),)
            continue
        keys = np.concatenate([p[0] for p in parts])
        unique, first, count = np.unique(keys, return_index=True, return_counts=True)
        context = np.concatenate([p[1] for p in parts])[first] if n > 1 else np.zeros(len(unique), np.uint64)
        suffix = np.concatenate([p[2] for p in parts])[first] if n > 1 else np.zeros(len(unique), np.uint64)
        count = count.astype(float)
        if n < ORDER:  # how many different characters stand before it
            row, known = find(unique, found[n + 1][2])
            before = np.bincount(row[known], minlength=len(unique)).astype(float)
            count = np.maximum(before, 1)
        found[n] = unique, context, suffix, count
    return found


def _tables(model: Languages, tables: list[dict[int, tuple]]) -> None:
    """Interpolated probabilities of all n-grams for all languages, from the shortest up."""
    width = len(tables)
    alphabet = max(len(np.unique(np.concatenate([t[1][0] for t in tables]))), 1) + 1
    model.floor = np.full(width, -np.log(alphabet))
    for n in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([t[n][0] for t in tables]))
        suffix_of = np.zeros(len(keys), np.uint64)
        context_of = np.zeros(len(keys), np.uint64)
        for t in tables:
            row, _ = find(keys, t[n][0])
            suffix_of[row], context_of[row] = t[n][2], t[n][1]
        contexts = np.unique(context_of)
        lower = np.exp(model.floor)[None, :].repeat(len(keys), 0)
        if n > 1:
            row, known = find(model.keys[n - 1], suffix_of)
            lower[known] = np.exp(model.logp[n - 1][row[known]])
        p = np.zeros((len(keys), width))
        weights = np.zeros((len(contexts), width))
        in_context, _ = find(contexts, context_of)
        for k, t in enumerate(tables):
            unique, context, _, count = t[n]
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            row, _ = find(contexts, context)
            total = np.bincount(row, count, len(contexts))
            kinds = np.bincount(row, minlength=len(contexts))
            share = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            own, _ = find(keys, unique)
            mass = np.zeros(len(keys))
            mass[own] = (count - discount) / total[row]
            p[:, k] = mass + share[in_context] * lower[:, k]
            weights[:, k] = np.log(share)
        model.keys[n], model.logp[n] = keys, np.log(p)
        model.contexts[n - 1], model.weights[n - 1] = contexts, weights
    # a character that no language has: the weight of the empty context and the even share
    model.floor = model.floor + model.weights[0][0]


def fit(docs: DataFrame, learn: Column) -> Languages:
    """Learn from the documents (doc_id, text, lang) that fulfil ``learn`` and have a language."""
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")
    ).where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(ALL_SAMPLES).collect()
    if not counts:
        return Languages()
    size = max(1, min(SAMPLE, ALL_SAMPLES // len(counts)))
    # twice as many as are wanted pass, and of these the first
    # (an Arrow table, which needs no Python worker on the executors)
    wanted = {"lang": [r["lang"] for r in counts], "pass": [2.0 * size / r["count"] for r in counts]}
    passing = docs.sparkSession.createDataFrame(pa.table(wanted))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    length = F.length("text")
    start = F.when(length > LONGEST, F.pmod(F.xxhash64("text", "doc_id"), length - (LONGEST - 1))).otherwise(0)
    some = named.join(F.broadcast(passing), "lang").where(place / (1 << 30) < F.col("pass"))
    some = some.select("doc_id", "lang", F.substring("text", (start + 1).cast("int"), F.lit(LONGEST)).alias("text"), place.alias("place"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "text"))
    chosen = some.withColumn("rank", rank).where(F.col("rank") <= size)
    samples: dict[str, list[str]] = {r["lang"]: [] for r in counts}
    for row in sorted(chosen.collect(), key=lambda r: (r.lang, r["rank"])):
        samples[row.lang].append(row.text)
    return train(samples)


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def name(batches):
        of = shared.value
        for batch in in_slices(batches):
            found = [of.predict(t) for t in batch["text"].to_pylist()]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *columns], names=["doc_id", "lang_pred", "score", "rejected"]
            )

    importable(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        name, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def keep(docs: DataFrame, model: Languages) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(batches):
        of = shared.value
        for batch in in_slices(batches):
            kept = [not of.predict(t)[2] for t in batch["text"].to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    importable(docs.sparkSession)
    return docs.mapInArrow(known, docs.schema)

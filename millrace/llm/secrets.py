"""Operator 2: secrets in texts, with DataFrame functions alone.

Base spans are the matches of three patterns.  Spans of the kind ``random`` are added where a run
of at least ``RUN`` key characters outside base spans is more likely under a character Markov
model of random strings than under one of ordinary words.  The models alone decide, whatever
characters a run has; of a run that a base span cuts, what is left is looked at.

The models are trained on labelled samples from a bounded number of documents, chosen by a
hash of their id: what the base patterns find is random, and the other runs are ordinary.  A
run is reported if the log-likelihood ratio is at least ``TOTAL`` and at least ``MEAN`` for each
character.

Positions are code points, ends exclusive.  Matches of a pattern are found together with the
pieces between them; the lengths of pieces and matches before it are a match's place.

Cases: null and empty texts have no spans; without any labelled sample both models are even,
and nothing is added; repeated rows have the same spans; an empty table gives no rows; other
columns are not read, and ``redact`` keeps them as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free, texts

#: Fixed patterns: kind, pattern, group that the length is of, and least length.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: Found instead of the last two patterns: their matches are whole runs, so the length can be asked for at once.
LONG = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
KEY = "A-Za-z0-9+/_-"
RUN = 16
RANDOM = rf"(?<![{KEY}])[{KEY}]{{{RUN},}}"
ORDINARY = rf"[{KEY}]{{3,}}"
#: The states of the models; zero is the start and what separates the words of an identifier.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
STATES = len(ALPHABET) + 1
SAMPLE = 20_000
TOTAL = 16.0
MEAN = 0.7
SMOOTH = 0.5
MARK = "[SECRET]"

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _found(text: Column, pattern: str, kind: str, rank: int, keep=None, group: int = 0) -> Column:
    """Spans of a pattern's matches, leftmost and without overlap; ``keep`` tests the group's text."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)
    steps = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), groups.alias("part"))

    def add(done, step):
        start = done["place"] + F.length(step["piece"])
        end = start + F.coalesce(F.length(step["match"]), F.lit(0))
        span = F.struct(
            start.cast("long").alias("start"), F.lit(rank).alias("rank"), end.cast("long").alias("end"), F.lit(kind).alias("kind")
        )
        wanted = step["match"].isNotNull() & (F.lit(True) if keep is None else keep(step["part"]))
        spans = F.when(wanted, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("place"), spans.cast(SPAN).alias("spans"))

    nothing = F.array().cast(SPAN)
    begin = F.struct(F.lit(0).alias("place"), nothing.alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(steps, begin, add)["spans"]).otherwise(nothing)


def _at_least(least: int):
    return lambda part: F.length(part) >= least


def base_spans(text: Column) -> Column:
    """The spans of the three patterns by start, then kind."""
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        long = LONG.get(kind)
        keep = None if long else _at_least(least)
        parts.append(_found(text, long or pattern, kind, rank, keep, group))
    return F.array_sort(F.concat(*parts))


def _codes(run: Column) -> Column:
    """The places of a run's characters in the alphabet, from one, after a zero for the start."""
    characters = F.filter(F.split(run, ""), lambda c: c != "")
    return F.concat(F.array(F.lit(0)), F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c)))


def _steps(run: Column) -> Column:
    """A number for each transition of a run."""
    codes = _codes(run)
    after = F.slice(codes, F.lit(2), F.size(codes) - 1)
    before = F.slice(codes, F.lit(1), F.size(codes) - 1)
    return F.zip_with(before, after, lambda a, b: a * STATES + b)


def train(docs: DataFrame, sample: int = SAMPLE) -> list[float]:
    """The log-likelihood ratio of each transition, random against ordinary."""
    rows = docs.count()
    if not rows:
        return [0.0] * (STATES * STATES)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    chosen = texts(docs).where(place < min(1.0, sample / rows))
    values = F.concat(
        *(F.regexp_extract_all("text", F.lit(LONG.get(kind, pattern)), F.lit(group)) for kind, pattern, group, _ in BASE)
    )
    values = F.filter(values, lambda v: F.length(v) >= 8)
    hidden = F.col("text")
    for kind, pattern, _, _ in BASE:
        hidden = F.regexp_replace(hidden, LONG.get(kind, pattern), " ")
    words = F.regexp_extract_all(hidden, F.lit(ORDINARY), F.lit(0))
    runs = F.concat(
        F.transform(values, lambda v: F.struct(F.lit(1).alias("random"), v.alias("run"))),
        F.transform(words, lambda w: F.struct(F.lit(0).alias("random"), w.alias("run"))),
    )
    # at most two rows for each transition come to the driver
    counts = (
        chosen.select(F.explode(runs).alias("r"))
        .select("r.random", F.explode(_steps(F.col("r.run"))).alias("step"))
        .groupBy("random", "step")
        .count()
        .collect()
    )
    found = {0: {}, 1: {}}
    for row in counts:
        found[row.random][row.step] = row["count"]
    if not counts:
        return [0.0] * (STATES * STATES)
    logs = {k: _logs(v) for k, v in found.items()}
    return [a - b for a, b in zip(logs[1], logs[0])]


def _logs(counts: dict[int, int]) -> list[float]:
    total = [0] * STATES
    for step, n in counts.items():
        total[step // STATES] += n if step % STATES else 0
    even = SMOOTH * (STATES - 1)
    return [
        math.log((counts.get(s, 0) + SMOOTH) / (total[s // STATES] + even)) if s % STATES else 0.0
        for s in range(STATES * STATES)
    ]


def random_spans(blanked: Column, ratios: list[float]) -> Column:
    """Spans of runs that are likely random, in a text without its base spans."""
    weights = F.split(F.lit(",".join(f"{x:.6g}" for x in ratios)), ",").cast("array<double>")

    def likely(run):
        total = F.aggregate(_steps(run), F.lit(0.0), lambda sum_, step: sum_ + F.element_at(weights, step + 1))
        return (total >= TOTAL) & (total >= MEAN * F.length(run))

    return _found(blanked, RANDOM, "random", len(BASE), likely)


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with as many spaces in place of what the spans, sorted by start, hold."""

    def blank(done, span):
        start, end = (F.greatest(span[k].cast("int"), done["place"]) for k in ("start", "end"))
        before = F.substr(text, done["place"] + 1, start - done["place"])
        return F.struct(F.concat(done["out"], before, F.repeat(F.lit(" "), end - start)).alias("out"), end.alias("place"))

    done = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("place")), blank)
    rest = F.concat(done["out"], F.substr(text, done["place"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def find(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """``doc_id`` with ``base`` and ``spans``, all of them, as arrays of spans."""
    found = _with_spans(texts(docs), ratios, "base", "blanked", "spans")
    return found.select("doc_id", "base", "spans")


def _with_spans(docs: DataFrame, ratios: list[float], base: str, blanked: str, spans: str) -> DataFrame:
    """``docs`` with columns of the base spans, the text without them and all spans, each worked out once."""
    found = docs.withColumn(base, base_spans(F.col("text"))).withColumn(blanked, _blanked(F.col("text"), F.col(base)))
    return found.withColumn(spans, F.array_sort(F.concat(base, random_spans(F.col(blanked), ratios))))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, ratios: list[float], mark: str = MARK) -> DataFrame:
    """``docs`` with each span, or group of spans that overlap, replaced by ``mark``."""
    text = F.col("text")
    names = [free(docs, n) for n in ("base", "blanked", "spans")]
    found = _with_spans(docs, ratios, *names)
    spans = F.col(names[-1])

    def cut(done, span):
        start, end = span["start"].cast("int"), span["end"].cast("int")
        before = F.substr(text, done["place"] + 1, F.greatest(start - done["place"], F.lit(0)))
        told = F.concat(done["out"], before, F.lit(mark))
        out = F.when(start >= done["place"], told).otherwise(done["out"])
        return F.struct(out.alias("out"), F.greatest(done["place"], end).alias("place"))

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("place"))
    done = F.aggregate(spans, begin, cut)
    clean = F.concat(done["out"], F.substr(text, done["place"] + 1, F.length(text)))
    changed = F.size(spans) > 0
    new = {"text": F.when(changed, clean).otherwise(text)}
    if "n_chars" in docs.columns:
        size = F.length(clean).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return found.withColumns(new).select(*docs.columns)

"""What near copies of the pipeline leave on disk, and how few pairs they compare whole."""

import os
import random
import time
from itertools import combinations

import pytest

from millrace.llm import near_copies, near_dup
from millrace.llm.common import importable, scratch, stored


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return {
        name for top in env.blockManager().diskBlockManager().localDirsString() for _, _, names in os.walk(top)
        for name in names if name.startswith("shuffle_")
    }


def folders(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return set(os.listdir(base)) if os.path.exists(base) else set()


def members(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = stored(near_copies.entries(docs), "entries")
    return found, stored(near_copies.members(found), "members")


def test_stored_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    kept = stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)  # Spark deletes them from a thread of its own
    assert not left
    assert kept.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_scratch_deletes_what_is_not_kept(spark):
    before = folders(spark)
    with scratch() as keep:
        with scratch() as keep_inner:
            gone = stored(spark.range(3), "gone")
            inner = keep_inner(stored(gone.selectExpr("id + 1 AS id"), "inner"))
        assert {x.split("-")[0] for x in folders(spark) - before} == {"inner"}
        last = keep(stored(inner.selectExpr("id + 1 AS id"), "last"))
    assert {x.split("-")[0] for x in folders(spark) - before} == {"last"}
    assert sorted(r.id for r in last.collect()) == [2, 3, 4]


def test_near_copies_leave_only_what_is_read(spark):
    importable(spark)
    drawn = random.Random(3)
    texts = [" ".join(f"w{drawn.randrange(50)}" for _ in range(40)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts + [t + " end" for t in texts])), "doc_id long, text string")
    before = folders(spark)
    kept = near_dup.keep_one(docs)
    assert sorted(x.split("-")[0] for x in folders(spark) - before) == ["codes", "roots"]
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))


def test_phrases_shared_by_chance_make_no_candidates(spark, monkeypatch):
    """Each two of 120 long texts share a phrase of five words and nothing else."""
    monkeypatch.setattr(near_copies, "COMMON", 0)  # a bounded sample of a large corpus doesn't show such phrases
    texts = [
        " ".join([*(f"t{k}x{i}" for i in range(400)), *(f"phrase{k // 2}y{i}" for i in range(5)), *(f"t{k}z{i}" for i in range(400))])
        for k in range(120)
    ]
    found, below = members(spark, texts)
    none = spark.createDataFrame([], "code long, root long")
    assert near_copies._open(below, none).count() > 0
    assert near_copies._close(near_copies._open(below, none)).count() == 0
    hubs = near_copies._with_hubs(below)
    assert hubs.count() > 0 and near_copies._alike(hubs, found).count() == 0


@pytest.mark.parametrize("common", [0, near_copies.COMMON])
def test_candidates_miss_no_linked_pair(spark, monkeypatch, common):
    """Pairs just above and below the similarity, of all sizes, with words changed, put in and left out."""
    monkeypatch.setattr(near_copies, "COMMON", common)
    drawn = random.Random(5)
    texts = []
    for n in [*range(1, 60), *range(60, 700, 16)]:
        words = [f"n{n}w{k}" for k in range(n + 4)]
        texts.append(" ".join(words))
        texts.append(" ".join(words[: -max(1, n // 5)]))
        texts.append(" ".join(words + [f"n{n}v{k}" for k in range(n // 4)]))
        for k in drawn.sample(range(n + 4), min(n + 4, max(1, n // 45))):
            words[k] = "changed"
        texts.append(" ".join(words))
    sets = {near_copies.code_of(s): s for s in map(near_copies.shingles, texts)}
    linked = {
        tuple(sorted((a, b))) for (a, s), (b, t) in combinations(sets.items(), 2)
        if 0.79 < len(s) / len(t) < 1.26 and near_copies.linked(s, t)
    }
    _, below = members(spark, texts)
    none = spark.createDataFrame([], "code long, root long")
    found = {(r.a, r.b) for r in near_copies._close(near_copies._open(below, none)).collect()}
    assert len(linked) > 150 and linked <= found

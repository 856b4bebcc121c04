"""Near copies of the pipeline against brute force over all pairs."""

import random
import tracemalloc

import numpy as np
import pytest

import corpus_pipeline
from conftest import SMALL
from millrace.llm import near_copies, near_dup


def brute(texts):
    """The smallest id of each text's class."""
    sets = []
    for text in texts:
        words = (text or "").lower().split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    near = [
        (a, b) for b in range(len(sets)) for a in range(b)
        if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    label = np.arange(len(sets))
    near_dup.merge(label, *np.array(near).T)
    return label


def changed(drawn, words, n):
    words = list(words)
    for _ in range(n):
        words[drawn.randrange(len(words))] = f"w{drawn.randrange(10**6)}"
    return words


@pytest.mark.parametrize("large", [64, 4])
def test_stage_equals_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(near_copies, "LARGE", large)
    drawn = random.Random(7)
    texts = ["", None, "one two", "One  two", "a b c d e"]
    for _ in range(25):
        base = [f"w{drawn.randrange(3000)}" for _ in range(drawn.randrange(8, 150))]
        texts += [" ".join(changed(drawn, base, drawn.randrange(5))) for _ in range(drawn.randrange(1, 12))]
    base = [f"v{k}" for k in range(120)]  # a large group in which only some are near each other
    texts += [" ".join(changed(drawn, base, drawn.randrange(1, 8))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    label = brute(texts)
    assert len(set(label)) < len(texts) - 60
    kept = corpus_pipeline.drop_near_copies(spark, docs, None)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label.tolist()))


def test_stage_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    label = brute([t for _, t in rows])
    kept = near_dup.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({rows[k][0] for k in label})


def test_a_group_of_near_copies_does_not_meet_pair_by_pair(spark):
    """Texts that differ from one in up to three places, and hardly any two of them are near each other."""
    drawn = random.Random(11)
    base = [f"b{k}" for k in range(150)]
    texts = [" ".join(base)] + [" ".join(changed(drawn, base, 3)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_copies.stored(near_copies.entries(docs), "entries")
    below = near_copies.stored(near_copies.members(found), "members")
    first = near_copies._verified(near_copies._with_hubs(below).distinct(), near_copies._sets(docs, found, found.select("code").distinct()))
    roots = near_copies.components(first, "a", "b").withColumnRenamed("node", "code")
    assert near_copies._close(near_copies._open(below, roots)).count() < len(texts)
    assert len(set(brute(texts).tolist())) == near_dup.keep_one(docs).count() == 1


def test_index_links_are_candidates(spark):
    base = [f"b{k}" for k in range(400)]
    texts = [" ".join(base), " ".join([*base[:-1], "x"]), " ".join(base[::-1])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_copies.stored(near_copies.entries(docs), "entries")
    code = {r.doc_id: r.code for r in found.collect()}
    pairs = {(r.a, r.b) for r in near_copies._indexed(found).collect()}
    assert pairs == {(min(code[0], code[1]), max(code[0], code[1]))}


def test_descent_holds_little_at_once():
    """64 nodes of 1,024 codes that share some of their bits, as upper nodes of the index are."""
    drawn = np.random.default_rng(1)
    group = np.repeat(np.arange(64), 1024)
    code = drawn.integers(0, 1 << 40, 1 << 16, dtype=np.uint64) | group.astype(np.uint64) << np.uint64(50)
    code = code[np.lexsort((near_dup.gray_rank(code), group))]
    tracemalloc.start()
    for _ in near_dup.near_pairs(code, group, near_dup.RADIUS):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6

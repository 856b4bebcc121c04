"""Conversation tries, periodic runs and repeated bytes against brute force, and their odd cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_edges import documents, ids, none, odd  # noqa: F401

from millrace.llm import periodic, prefix_trie, repeats
from millrace.llm.queries import QUERIES, periodic_words


def trie(paths):
    """Nodes by brute force; ``paths`` has lists of (symbol, words) by conversation."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for node, own in members.items():
        below = [v for v in members if v[: len(node)] == node]
        children = [v for v in below if len(v) == len(node) + 1]
        leaves = [v for v in below if not any(len(x) == len(v) + 1 and x[: len(v)] == v for x in below)]
        ends = ",".join(str(c) for c in sorted(c for c in own if len(paths[c]) == len(node)))
        rows.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children), len(leaves),
            sum((len(members[v]) - 1) * (v[-1][1] if v else 0) for v in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def found_nodes(spark, paths, shard):
    rows = [(c, [s.encode().ljust(16) for s, _ in turns], [w for _, w in turns]) for c, turns in paths.items()]
    df = spark.createDataFrame(rows, "conv_id long, symbols array<binary>, words array<long>")
    return sorted(map(tuple, prefix_trie.nodes(df, shard).collect()), key=str)


@pytest.mark.parametrize("shard", [1, 7, 50_000])
def test_trie_with_hot_beginnings(spark, shard):
    draw = random.Random(shard)
    stem = [("hot", 3), ("stem", 2), ("of", 1), ("five", 0), ("turns", 4)]
    paths = {}
    for c in range(-5, 60):
        tail = [(draw.choice("abc"), 2) for _ in range(draw.randint(0, 5))]
        paths[c] = (stem[: draw.randint(3, 5)] if draw.random() < 0.6 else []) + tail
        if draw.random() < 0.2:
            paths[c] = paths.get(c - 1, [])
    assert found_nodes(spark, paths, shard) == trie(paths)


def test_double_array_holds_exactly_its_paths():
    draw = random.Random(3)
    paths = sorted({tuple(draw.randint(1, 40) for _ in range(draw.randint(1, 6))) for _ in range(400)})
    base, check, order = prefix_trie.double_array([list(p) for p in paths])
    nodes = {p[:k] for p in paths for k in range(len(p) + 1)}
    assert len(order) == len(nodes) and sum(c >= 0 for c in check) == len(nodes)
    states = set()
    for node in nodes:
        state = 0
        for c in node:
            assert check[base[state] + c] == state
            state = base[state] + c
        states.add(state)
    assert states == set(order)


def conversations(spark, rows):
    filled = [(*r, 1, b"x", "key") for r in rows]
    return spark.createDataFrame(filled, "conv_id long, turn long, role string, text string, n int, symbol binary, cut string")


def test_conversations_with_nulls(spark, tmp_path):
    rows = [
        (0, 1, "user", "b c"), (0, None, "user", "first of all"), (0, 2, None, None), (7, 0, "user", ""), (7, 1, "user", "x"),
        (7, 1, "user", "x"), (7, 1, "bot", "x"), (None, 0, "user", "of nobody"), (45, 0, "a", "b"), (3, 0, "u", "long " * 40_000),
    ]
    conversations(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            symbol = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append((turn is not None, turn or 0, symbol, len(text.split())))
    own = {c: [(s, w) for *_, s, w in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    got = QUERIES["op11_prefix_trie"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == trie(paths)


def test_no_conversations(spark, tmp_path):
    conversations(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op11_prefix_trie"](spark, str(tmp_path)).count() == 0


def all_runs(x):
    found, n = {}, len(x)
    for q in range(1, n // periodic.TIMES + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(periodic.LEAST, periodic.TIMES * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted((a, length, q) for (a, length), q in found.items())


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_all_periods(seed):
    draw, documents_ = random.Random(seed), []
    for _ in range(4):
        words = []
        for _ in range(draw.randint(0, 6)):
            letters = draw.choice([1, 2, 3, 50])
            p = draw.choice([1, 2, 5, 8, 9, 15, 16, 17, 32, 33, 64, 65, 100])
            block = [draw.randrange(letters) for _ in range(p)]
            words += (block * 8)[: int(draw.choice([0, 2, 3.9, 4, 4.2, 7]) * p)]
            words += [draw.randrange(letters) for _ in range(draw.choice([0, 1, 5]))]
        documents_.append(words)
    documents_.sort(key=lambda d: -len(d))
    flat, want = [], []
    for k, words in enumerate(documents_):
        want += [(a + len(flat), length, q) for a, length, q in all_runs(words)]
        flat += [*words, -1 - k]
    got = periodic.runs(np.array(flat, np.int64), np.array([len(d) for d in documents_], np.int64))
    assert got == sorted(want)


def test_selected_are_the_minima_of_windows():
    hashes = np.random.default_rng(5).integers(0, 9, 200).astype(np.uint64)
    want = {j + k for j in range(191) for k in range(10) if hashes[j + k] == hashes[j : j + 10].min()}
    assert set(periodic.selected(hashes, 10).tolist()) == want
    assert len(periodic.selected(hashes[:5], 10)) == 0


def test_runs_of_odd_documents(spark, odd, none):  # noqa: F811
    found = periodic.find(odd)
    assert ids(found) == ids(odd) and periodic.find(none).count() == 0
    for r in found.collect():
        assert r.doc_id is not None or r.n_words in (0, 20)
        assert (r.n_words > 0) == bool(r.collapsed)
    rows = documents(spark, [(1, "a b " * 30_000 + "c", "x"), (2, "la la la la la la, la", "x"), (2, "one", None)])
    got = {(r.doc_id, r.n_words): (tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic.find(rows).collect()}
    assert got[1, 60_001] == (((0, 60_000, 2),), "a b c")
    assert got[2, 7] == ((), "la la la la la la, la") and got[2, 1] == ((), "one")


def test_words_made_periodic():
    assert periodic_words(None, [b"a"]) == [b"a"] and periodic_words(3, []) == []
    name = next(i for i in range(1000) if zlib.crc32(b"%d" % i) % 10 == 0)
    words = [b"%d" % k for k in range(97)]
    g = zlib.crc32(b"%d" % name) // 10
    a, p = g % 97, 1 + (97 - g % 97) // (3 + g % 8)
    assert periodic_words(name, words) == [words[i if i < a else a + (i - a) % p] for i in range(97)]


def removed(docs, length):
    """For each document its spans and what is left; strings are looked at in order."""
    seen, found = set(), {}
    for name, text in sorted(docs):
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            string = data[s : s + length]
            if string in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(string)
        edges = [i for i in range(len(data) + 1) if (0 < i <= len(data) and gone[i - 1]) != (i < len(data) and gone[i])]
        spans = list(zip(edges[::2], edges[1::2]))
        found[name] = (len(data), spans, bytes(x for x, g in zip(data, gone) if not g))
    return found


@pytest.mark.parametrize(("letters", "length", "part"), [("ab", 40, 2), ("abé ", 100, 3), ("a", 100, 2), ("abcdefgh ", 200, 16_384)])
def test_repeated_bytes(spark, letters, length, part):
    draw = random.Random(length + part)
    common = ["".join(draw.choice(letters) for _ in range(draw.choice([20, 99, 100, 130, 400]))) for _ in range(4)]
    docs = []
    for i in range(40):
        parts = [draw.choice(common) if draw.random() < 0.5 else "".join(draw.choice(letters) for _ in range(60)) for _ in range(draw.randint(0, 7))]
        docs.append((3 * i, "".join(parts) if not docs or draw.random() < 0.8 else draw.choice(docs)[1]))
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in repeats.remove(rows, length, part).collect()}
    assert got == removed(docs, length)


def test_pieces_of_long_texts(spark, monkeypatch):
    draw = random.Random(8)
    base = "".join(draw.choice("abcdef ") for _ in range(3000))
    docs = [(1, base), (2, base[500:2900] + "x" + base[:700]), (3, "y" + base * 2)]
    monkeypatch.setattr(repeats, "CHUNK", 900)
    monkeypatch.setattr(repeats, "PIECE", 300)
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in repeats.remove(rows, 100, 2).collect()}
    assert got == removed(docs, 100)


def test_repeated_bytes_of_odd_documents(spark, odd, none):  # noqa: F811
    found = repeats.remove(odd)
    assert ids(found) == ids(odd) and repeats.remove(none).count() == 0
    got = {r.doc_id: r for r in found.collect()}
    assert got[3].kept == b"" and got[5].n_bytes == 4 and got[8].spans == []
    text = "what one document says is said again, word by word and at some length, by another one that has a greater id. "
    rows = documents(spark, [(None, text, "x"), (4, text, "x"), (9, text + "!", "x"), (4, text, "x"), (4, text + "?", None)])
    kept = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.kept).decode()) for r in repeats.remove(rows).collect())
    assert (False, 9, "!") in kept and kept[-1] == (True, 0, "")
    assert sum(len(k) > 99 for *_, k in kept) in (1, 2)  # rows with the same id and text are one document


def test_intervals_of_a_suffix_array():
    text = b"abracadabra mississippi abracadabra"
    order, shared = repeats._sorted([text[i:] for i in range(len(text))])
    for value, i, j, around in repeats.intervals(shared):
        own = {text[k : k + value] for k in order[i : j + 1]}
        assert len(own) == 1 and value > around
        assert sum(text[k : k + value] == next(iter(own)) for k in range(len(text))) == j - i + 1


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_periodic_runs", "op13_repeated_bytes"])
def test_rows_of_queries(spark, name):
    table = "conversations" if name.startswith("op11") else "documents"
    found = QUERIES[name](spark, SMALL)
    if table == "documents":
        assert ids(found) == ids(spark.read.parquet(f"{SMALL}/documents.parquet"))
    else:
        assert found.where(F.col("depth") == 0).count() == 1

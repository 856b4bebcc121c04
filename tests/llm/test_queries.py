"""The registered queries over whole test tables, against plain computations."""

import hashlib
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SMALL, rows
from oracle import connect, differences

import corpus_pipeline
from millrace.llm import decontaminate, near_dup
from millrace.llm.encoding import Encoder
from millrace.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(docs):
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    return {i: np.frombuffer(encoder.whole(t or ""), "<u4") for i, t in docs.items()}


def remainder(name, divisor):
    return zlib.crc32(str(name).encode()) % divisor


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) == []


def test_token_files(spark, docs, ids):
    place, want = 0, []
    for name in sorted(docs):
        found = np.append(ids[name], np.uint32(2))
        want.append((name, place, len(found), zlib.crc32(found.astype("<u4").tobytes())))
        place += len(found)
    assert sorted(map(tuple, QUERIES["op1_token_files"](spark, SMALL).collect())) == want


def test_secrets(spark, docs):
    patterns = (
        ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
        ("access", "AKIA[A-Z0-9]+", 0, 16),
        ("hex", "[0-9a-f]+", 0, 32),
    )
    for r in QUERIES["op2_secrets"](spark, SMALL).collect():
        spans = sorted(
            (m.start(), rank, m.end(), kind)
            for rank, (kind, pattern, group, least) in enumerate(patterns)
            for m in re.finditer(pattern, docs[r.doc_id] or "")
            if len(m[group]) >= least
        )
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        counts = Counter(s[3] for s in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(counts[p[0]] for p in patterns)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_language(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op3_language"](spark, SMALL).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(truth) and all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in found)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_packing(spark, ids):
    found = QUERIES["op4_packing"](spark, SMALL).toPandas()
    total = 0
    for name, part in found.sort_values("piece").groupby("doc_id"):
        whole = np.append(ids[name], np.uint32(0))
        total += len(whole)
        assert part.length.sum() == len(whole) and part.start.tolist() == [2048 * k for k in range(len(part))]
        for r in part.itertuples():
            assert zlib.crc32(whole[r.start : r.start + r.length].astype("<u4").tobytes()) == r.ids_crc32
    sequences = found.groupby("sequence_id").length.sum()
    assert (sequences <= 2048).all() and len(sequences) <= -(-total // 2048) + 1


def test_benchmark_links(spark, docs):
    items = {r.item_id: decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    counts = {i: Counter(zip(*(w[k:] for k in range(5)))) for i, w in items.items()}
    for r in QUERIES["op5_benchmark_links"](spark, SMALL).collect():
        words = decontaminate.words_of(docs[r.doc_id])
        shingles = list(zip(*(words[k:] for k in range(5))))
        there, want = set(shingles), []
        for item, own in counts.items():
            n = sum(own.values())
            if there & set(own) and any(
                decontaminate.similarity(Counter(shingles[k : k + n]), own) >= 0.8 for k in range(max(1, len(shingles) - n + 1))
            ):
                want.append(item)
        assert (r.n_items, r.item_ids) == (len(want), sorted(want))


def test_suffix_tree(spark, docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), None] for i, t in docs.items()}
    counts = Counter(x for i, t in tokens.items() if remainder(i, 5) != 1 for x in t)
    n, below = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    found = QUERIES["op6_suffix_tree"](spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.train_tokens) == (len(own), n) and r.held_out == (remainder(r.doc_id, 5) == 1)
        assert r.n_known == sum(counts[x] > 0 for x in own)
        assert r.base_score == pytest.approx(sum(log10((counts[x] + 0.5) / below) for x in own), rel=1e-9)
        assert r.score < 0
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_simhash_classes(spark, docs):
    names = sorted(docs)
    codes = []
    for name in names:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), docs[name] or ""))
        parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        codes.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    codes = np.array(codes, np.uint64)
    label = np.arange(len(names))
    near_dup.merge(label, *np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3))
    want = [(n, f"{int(c):016x}", names[k]) for n, c, k in zip(names, codes, label)]
    assert sorted(map(tuple, QUERIES["op7_simhash_classes"](spark, SMALL).collect())) == want


def test_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    found = QUERIES["op8_quality"](spark, SMALL).collect()
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and r.predicted == int(r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.85


def test_main_text(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in QUERIES["op10_main_text"](spark, SMALL).collect():
        article = re.search(r"(?s)<article>(.*?)(</article>|<footer>)", pages[r.page_id])[1]
        plain = re.sub(r"<[^>]*>", " ", article)
        assert re.sub(r"\s+", "", __import__("html").unescape(plain)) == re.sub(r"\s+", "", r.text)
        assert r.n_chars == len(r.text)


def test_pipeline(spark, docs):
    packed = corpus_pipeline.run(spark, SMALL)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    classes = {r.doc_id: r.component_id for r in QUERIES["op7_simhash_classes"](spark, SMALL).collect()}
    linked = {r.doc_id for r in QUERIES["op5_benchmark_links"](spark, SMALL).where("n_items > 0").collect()}
    assert not kept & linked
    assert len({classes[i] for i in kept}) == len(kept)
    assert len(kept) >= 0.95 * len({i for i, c in classes.items() if i == c} - linked)
    assert len(rows(packed.select("sequence_id").distinct())) >= 1

"""Inner parts against brute force on drawn cases."""

import random
from math import exp

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import components, decontaminate, html_text, language, near_dup, packing, secrets
from millrace.llm.encoding import Encoder
from millrace.llm.topk import Shard


def test_encoder_equals_the_library():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"), kept=50, slice_bytes=64)
    texts = ["", " ", "ΑΣ ας Σ!", "İstanbul İ", "été café!!", "it's don't 's", "a<|endoftext|>b <|startoftext|>", "x" * 300,
             "ab\x1ccd", "ab\xa0cd　ef", "12345 a1b2", "한 한", "\x00 ﻿ x", "ﬁ ß ẞ Ǆ", "?" * 200,
             "한국어 日本語, русский!", "The the THE the, the. the!"]
    drawn = random.Random(3)
    texts += ["".join(drawn.choice("aAbéÉΣ .,'’1\n\t\x85") for _ in range(40)) for _ in range(200)]
    found = [x.astype("<u4").tobytes() for x in encoder.documents(pa.array(texts))]
    assert found == [encoder.whole(t) for t in texts]


@pytest.mark.parametrize("low, high", [(1, 2048), (400, 1200), (1, 60), (1000, 1049), (2048, 2049)])
def test_fill(low, high):
    length = np.random.default_rng(low).integers(low, high, 1500)
    bins = packing.fill(length, 2048)
    assert sorted(i for b in bins for i in b) == list(range(1500))
    assert max(sum(length[i] for i in b) for b in bins) <= 2048
    assert len(bins) <= len(packing.best_fit(length, 2048)[0])


def test_near_pairs():
    drawn = np.random.default_rng(0)
    codes = []
    for base in drawn.integers(0, 2**63, 40, dtype=np.uint64):
        for _ in range(drawn.integers(1, 90)):
            code = int(base)
            for k in drawn.choice(14, drawn.integers(0, 6), replace=False):
                code ^= 1 << int(k * 4)
            codes.append(code)
    codes = np.unique(np.array(codes, np.uint64))
    for groups in (1, 50):
        group = np.sort(drawn.integers(0, groups, len(codes)))
        order = np.lexsort((near_dup.gray_rank(codes), group))
        own = codes[order]
        label = np.arange(len(own))
        for a, b in near_dup.near_pairs(own, group, 3):
            near_dup.merge(label, a, b)
        want = np.arange(len(own))
        near = np.bitwise_count(own[:, None] ^ own[None, :]) <= 3
        near_dup.merge(want, *np.nonzero(near & (group[:, None] == group[None, :])))
        assert (label == want).all()


def test_a_node_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "PIECE", 16)
    drawn = random.Random(5)
    codes = sorted({sum(1 << b for b in drawn.sample(range(48), drawn.randint(0, 3))) for _ in range(300)} | {2**63 + 5})
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    prints = spark.createDataFrame([(k, 0, c) for k, c in enumerate(signed)], "doc_id long, text_hash long, code long")
    got = {r.code: r.component_id for r in near_dup.classes(prints).collect()}
    label = np.arange(len(codes))
    array = np.array(codes, np.uint64)
    near_dup.merge(label, *np.nonzero(np.bitwise_count(array[:, None] ^ array[None, :]) <= 3))
    assert got == dict(zip(signed, label.tolist()))


def test_components(spark):
    drawn = random.Random(2)
    links = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 40)] + [(drawn.randrange(200, 400), drawn.randrange(200, 400)) for _ in range(120)]
    label = np.arange(400)
    near_dup.merge(label, *np.array(links).T)
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components.components(frame, "a", "b").collect()}
    assert got == {n: int(label[n]) for pair in links for n in pair if pair[0] != pair[1] or n in got}
    assert components.components(frame.limit(0), "a", "b").count() == 0


def test_language_probabilities_sum_to_one():
    model = language.train({"a": ["the cat sat on the mat"] * 8, "b": ["le chat est sur la table"] * 8})
    codes = language.letters("the ca")
    # all letters of either language, and one that stands for all others
    alphabet = {ord("q")} | {int(c) for t in ("the cat sat on the mat", "le chat est sur la table") for c in language.letters(t)}
    for k in range(2):
        total = sum(exp(model.logs(np.append(codes[:-1], np.uint64(c)))[-1][k]) for c in alphabet)
        assert total == pytest.approx(1, abs=1e-6)
    assert model.predict("sat on the mat")[0] == "a" and model.predict("sur la table")[0] == "b"
    assert model.predict(None) == model.predict("12") == ("und", 0.0, True)


def test_near_passages_are_found():
    item = [f"word{k}" for k in range(40)]
    index = decontaminate.Index([(1, " ".join(item))])
    changed = item[:-1] + ["other"]
    assert index.links("x y " + " ".join(changed) + " z")[0][0] == 1
    assert index.links(" ".join(item[:20] + ["other"] + item[21:])) == []  # similarity 0.76
    assert index.links(" ".join(item).upper().replace(" ", ",\n"))[0][1:] == (1.0, 0, 40)


def test_random_strings(spark):
    docs = spark.createDataFrame(
        [(k, f"plain words and other_names_in_code of the ordinary kind {k} password = {random.Random(k).randbytes(12).hex()}") for k in range(300)],
        "doc_id long, text string",
    )
    ratios = secrets.train(docs)
    case = spark.createDataFrame(
        [(1, "key Xk39dQz7Lp0aQw83mZt1 x"), (2, "the-plain-words-and-ordinary-names-2nd-code"), (3, "1234567890123456789012")],
        "doc_id long, text string",
    )
    found = {r.doc_id: r.s for r in secrets.find(case, ratios).select("doc_id", secrets.written(F.col("spans")).alias("s")).collect()}
    assert found == {1: "random:4:24", 2: "", 3: ""}


@pytest.mark.parametrize("page, text", [
    ("<html><body><header>H</header><div id=main><div class='sidebar'>S</div><p>Long text, here it is. And more.</p><p>Short</p>"
     "<ul><li>A<li>B</ul></div><div id='comments'><p>A long comment, by a reader, that goes on.</p></div><footer>f</footer></body></html>",
     "Long text, here it is. And more.\nShort\nA\nB"),
    ("<body><div class=menu><a>x</a></div><div><h2>T</h2><p>Hello there, world. How are you?</p></div><form><p>sign up</p></form>",
     "T\nHello there, world. How are you?"),
    ("<script>a('<p>')</script><p>&lt;x&gt; &amp;amp; &#65;&nbsp;b</p>", "<x> &amp; A b"),
    ("<p>One <b>tw</b>o<br>three<p>four", "One two three\nfour"),
    ("<article><h1>T</h1><p>Text, is.</p><section class='comments'><p>c</p></section></article>", "T\nText, is."),
    ("<p>a <!-- x", "a"), ("<style>p{}</style>", ""), (None, ""),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("end, more", [
    ("<ul><li>A<li><p>B</p><ol><li>C</ol></ul>", "\nA\nB\nC"), ("<dl><dt>A<dd>B</dl>", "\nA\nB"),
    ("<ul><li><a href=x>More</a><li><a href=y>News</a></ul>", ""),
])
def test_lists_at_the_end_of_the_text(end, more):
    text = "Long text, here it is, with a good many words. And more of it, as is fit."
    page = f"<div><div><p>{text}</p><p>{text}</p>{end}</div><div><ul><li>Off<li>Out</ul></div></div>"
    assert html_text.main_text(page) == f"{text}\n{text}{more}"


def test_shard():
    drawn = np.random.default_rng(0)
    for trial in range(60):
        n, width, most = int(drawn.integers(1, 300)), int(drawn.integers(1, 20)), int(drawn.integers(1, 40))
        vectors, names = drawn.integers(-most, most, (n, width)), drawn.permutation(2 * n)[:n]
        shard = Shard(names, vectors)
        for _ in range(8):
            query = drawn.integers(-most, most, width) if trial % 3 else np.zeros(width, int)
            own = int(names[drawn.integers(n)])
            want = sorted((-int(s), int(i)) for s, i in zip(vectors @ query, names) if i != own)[:5]
            assert [(-s, int(names[p])) for p, s in shard.best(query, own, 5)] == want

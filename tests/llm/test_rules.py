"""What the operators must not lose: long texts of a language or label, rows without id, article text, large benchmarks."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, html_text, language, packing, quality, topk

P = "This is a long paragraph, with several sentences. It says much; and it goes on, and on, for quite some time. "
WORDS = {
    "en": "the and of to in that is was for with from this have are which their would there been".split(),
    "de": "der und die das nicht ein mit von den sich des auf ist dem eine wurde werden auch nach".split(),
}


def prose(draw, lang, n):
    return " ".join(draw.choice(WORDS[lang]) for _ in range(n))


def test_a_language_of_long_texts_only_is_learned(spark):
    draw = random.Random(1)
    rows = [(i, prose(draw, "en", 60), "en") for i in range(60)] + [(100 + i, prose(draw, "de", 4000), "de") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    assert model.names == ["de", "en"]
    found = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert all(found[i] == lang for i, _, lang in rows)


def test_the_sample_is_bounded_without_ids_and_with_one_hot_row(spark, monkeypatch):
    draw, seen = random.Random(2), {}
    monkeypatch.setattr(language, "SAMPLE", 20)
    monkeypatch.setattr(language, "train", lambda samples: seen.update(samples) or language.Languages())
    rows = [(None, prose(draw, "en", 30), "en") for _ in range(300)] + [(7, "one hot row", "en")] * 200 + [(1, prose(draw, "de", 5), "de")]
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert len(seen["en"]) == 20 and len(seen["de"]) == 1
    monkeypatch.setattr(language, "ALL_SAMPLES", 30)
    seen.clear()
    many = [(i, f"text {i}", f"l{i % 100}") for i in range(500)]
    language.fit(spark.createDataFrame(many, "doc_id long, text string, lang string"), F.lit(True))
    assert len(seen) == 30 and all(len(v) <= 1 for v in seen.values())


def test_a_label_of_long_texts_only_is_learned(spark):
    draw = random.Random(3)
    junk = "!!## $$%% *** "
    rows = [(i, prose(draw, "en", 80), 1) for i in range(60)] + [(100 + i, junk * 1500 + prose(draw, "en", 10), 0) for i in range(30)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    assert model.curve and len(model.curve) == 2  # the difference alone
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert min(scores[i] for i, _, q in rows if q) > max(scores[i] for i, _, q in rows if not q)


def test_score_is_the_curve_of_the_difference():
    import zstandard

    good, bad = quality.build([prose(random.Random(k), "en", 200) for k in range(40)]), quality.build(["!!## $$%% *** " * 50] * 40)
    model = quality.Compression(good, bad, [0.3, 0.2], 0.5)

    def size(dictionary, data):
        c = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary),
                                     write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(c.compress(data[k : k + quality.CHUNK])) for k in range(0, max(1, len(data)), quality.CHUNK))

    for text in ("", "x", prose(random.Random(9), "en", 900), "!!## " * 999):
        a, b = size(good, text.encode()), size(bad, text.encode())
        want = 1 / (1 + np.exp(-(0.3 + 0.2 * (b - a) / np.sqrt(a + b))))
        assert model.scorer()(text) == pytest.approx(want)


PAGES = {
    "nested": (f"<main><h1>Title</h1><p>Lead</p><article><p>{P * 3}</p><p>{P * 2}</p><p>End.</p></article></main><div>Copyright</div>",
               ["Title", "Lead", P * 3, P * 2, "End."]),
    "siblings": (f"<article><p>{P * 2}</p></article><article><p>{P * 4}</p></article>", [P * 2, P * 4]),
    "classes": (f"<article><p>{P * 3}</p><p class='ad-free'>We are ad free.</p><div class='related-work'>Related work.</div>"
                f"<p id='comments-on-policy'>On policy.</p><div class='cookie-notice'>Cookies!</div>"
                f"<div class='ad-slot-1'>Buy, now.</div><p>{P}</p></article>",
                [P * 3, "We are ad free.", "Related work.", "On policy.", P]),
    "links in the article": (f"<article><p>{P * 3}</p><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li>"
                             f"<li><a>More news</a></li></ul><p>{P * 3}</p><p>By <a href=x>one author</a>.</p></article>",
                             [P * 3, P * 3, "By one author."]),
    "no article": (f"<div><a href=/>Home</a> <a href=/a>About</a></div><div>Subscribe today</div><div><h1>Head</h1><p>{P * 3}</p>"
                   f"<p>Short one.</p><h2>Next</h2><p>{P * 2}</p><ul><li>first</li><li>second</li></ul><p>{P}</p><p>End.</p></div><div>Copyright</div>",
                   ["Head", P * 3, "Short one.", "Next", P * 2, "first", "second", P, "End."]),
    "flat": (f"<p>{P}</p><p>{P * 2}</p>", [P, P * 2]),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_article_text_is_kept_and_the_rest_is_not(name):
    page, want = PAGES[name]
    assert html_text.main_text(f"<body>{page}</body>").split("\n") == [w.strip() for w in want]


def test_the_ratios_decide(monkeypatch):
    before = {n: html_text.main_text(f"<body>{page}</body>") for n, (page, _) in PAGES.items()}
    monkeypatch.setattr(html_text, "_fused", lambda found, solid: [True] * len(solid))
    changed = {n for n, (page, _) in PAGES.items() if html_text.main_text(f"<body>{page}</body>") != before[n]}
    assert changed == {"links in the article", "no article"}


@pytest.mark.parametrize("part", ["<div class=a>", "<b>", "<div></section>", "<a href=\"x>t</a>", "<b \"", "<p title='>x", "<i></b>", "<li><b>"])
def test_time_grows_with_the_page(part):
    def seconds(n):
        start = time.process_time()
        html_text.main_text(f"<p>{P}" + part * n)
        return time.process_time() - start

    seconds(100)
    assert seconds(24_000) < 16 * seconds(4_000) + 0.2


def test_a_large_benchmark_is_indexed_once_for_each_length():
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(20_000)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 40)))) for i in range(8_000)]
    start = time.process_time()
    index = decontaminate.Index(items)
    assert time.process_time() - start < 15
    words = [re.findall(r"\w+", t) for _, t in items]
    text = " ".join(["zz", *words[17], "zz", *words[4711][:-1], "other"])
    got = {name for name, *_ in index.links(text)}
    assert {17} <= got and all(set(words[i]) & set(text.split()) for i in got)


def test_candidates_are_all_items_within_the_radius(monkeypatch):
    draw = np.random.default_rng(6)
    index = decontaminate.Index([(i, " ".join(f"{x}" for x in draw.integers(0, 50, n))) for i in range(300) for n in (5 + i % 3,)])
    codes = np.concatenate([index.code[:20] ^ np.uint64(0b1011 << k) for k in range(0, 60, 7)])
    for at_once in (1, 1 << 18):
        monkeypatch.setattr(decontaminate, "AT_ONCE", at_once)
        for length in set(index.size.tolist()):
            own = np.flatnonzero(index.size == length)
            close = np.bitwise_count(codes[:, None] ^ index.code[None, own]) <= decontaminate.RADIUS
            want = {(int(w), int(own[i])) for w, i in zip(*np.nonzero(close))}
            assert set(index.candidates(codes, length)) == want


def test_scores_beyond_63_bits_are_refused(spark):
    rows = [(0, [3e7, 3e7]), (50, [3e7, -1.0])]
    with pytest.raises(ValueError, match="beyond 63 bits"):
        topk.top(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 5)
    near = [(0, [3e6, 3e6]), (50, [3e6, -1.0])]
    got = topk.top(spark.createDataFrame(near, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 5).collect()
    assert {r.score for r in got} == {768_000_000**2 - 256 * 768_000_000}


def test_every_block_of_queries_meets_every_shard(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 3)
    monkeypatch.setattr(topk, "SHARD", 5)
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(40, 6)).round(2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)
    whole = np.floor(256 * vectors).astype(np.int64)
    for limit in (1 << 20, 0):
        monkeypatch.setattr(topk, "BROADCAST_BYTES", limit)
        got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top(df, F.col("vec_id") % 4 == 0, 3).collect()}
        for q in range(0, 40, 4):
            order = sorted((-int(whole[q] @ whole[c]), c) for c in range(40) if c != q)
            assert [got[q, k + 1] for k in range(3)] == [(c, -score) for score, c in order[:3]]


def test_groups_of_very_short_pieces_have_a_bound(spark, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "GROUP_PIECES", 100)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).toPandas()
    sizes = found.groupby("sequence_id").length.sum()
    assert len(found) == 1000 and 8 <= len(sizes) <= 10 and (sizes < 250).all()

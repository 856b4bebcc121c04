"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import random

import duckdb
import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm import decontaminate, html_text, language, near_dup, packing, quality
from millrace.llm import secrets, suffix_tree, token_files, topk
from millrace.sources.files import work_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, code int, component_id string, "
    "links int, spans string, id int, hash int, number int, block int, start int, rejected int"
)


def documents(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    filled = [(i, t, g, "s", None if t is None else len(t), 1, "c", 2, "x", 3, 4, 5, 6, 7, 8) for i, t, g in rows]
    return spark.createDataFrame(filled, COLUMNS)


PROSE = "the cat sat on the mat and looked at the old grey house across the river, then went to sleep. "


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(random.Random(1).choice(PROSE.split()) for _ in range(60_000))
    rows = [
        (1, PROSE * 3, "en"), (2, PROSE * 3, "en"), (2, PROSE * 3, "en"), (3, None, None), (4, "", "en"),
        (5, " \n\t ", None), (6, long, "en"), (None, PROSE, "en"), (None, None, None), (7, "x", "en"),
        (8, "12 34 !!", None), (9, PROSE.upper() * 3, "en"), (10, "naïve café — 日本語 token: 'abcd1234efgh'", "fr"),
    ]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def ids(df):
    return sorted((r.doc_id is not None, r.doc_id or 0) for r in df.select("doc_id").collect())


def test_one_row_for_each_row(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (7, None, 0), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "sat on the mat and looked"), (2, None), (3, "")], "item_id long, text string")
    model = language.fit(odd, F.lit(True))
    quality_model = quality.fit(odd, labels, F.lit(True))
    ratios = secrets.train(odd)
    for docs in (odd, none):
        for found in (
            language.predict(docs, model),
            quality.score(docs, quality_model),
            secrets.find(docs, ratios),
            decontaminate.links(docs, benchmark),
            suffix_tree.score(docs, F.lit(True)),
            near_dup.duplicate_classes(docs),
        ):
            assert ids(found) == ids(docs)


def test_models_from_nothing(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.lang_pred for r in language.predict(odd, language.fit(none, F.lit(True))).collect()} == {"und"}
    assert {r.score for r in quality.score(odd, quality.fit(odd, labels, F.lit(True))).collect()} == {0.5}
    assert set(secrets.train(none)) == {0.0}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.links(odd, empty).where(F.size("links") > 0).count() == 0
    assert {r.score for r in suffix_tree.score(odd, F.lit(False)).collect()} == {0.0}


def test_tokens(spark, odd, none):
    for docs in (odd, none):
        folder = work_folder(spark, "tokens")
        token_files.write_tokens(docs, folder, VOCABULARY, 2)
        rows = token_files.read_tokens(spark, folder).orderBy("start").collect()
        assert ids(spark.createDataFrame(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")) == ids(docs)
        names = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
        assert names == sorted(names)
        place = 0
        for r in rows:
            assert r.start == place
            place += r.n_tokens
        assert all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 4, 5))


def test_packing(spark, odd, none):
    assert packing.pack(none, VOCABULARY).count() == 0
    found = packing.pack(odd, VOCABULARY).toPandas()
    assert found[found.piece == 0].shape[0] == 13
    for _, part in found.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 2048
    assert (found[found.doc_id == 6].sort_values("piece").length[:-1] == 2048).all()


def test_stages_keep_columns(spark, odd, none):
    model = language.fit(odd, F.lit(True))
    benchmark = spark.createDataFrame([(1, "sat on the mat and looked at the old grey house across the river then went")], "item_id long, text string")
    benchmark = benchmark.unionAll(spark.createDataFrame([(2, "nothing of the kind is anywhere")], "item_id long, text string"))
    ratios = secrets.train(odd)
    for docs in (odd, none):
        for kept in (
            language.keep(docs, model), near_dup.keep_one(docs), decontaminate.clean(docs, benchmark), secrets.redact(docs, ratios)
        ):
            assert kept.dtypes == docs.dtypes
            kept.collect()
    assert {r.doc_id for r in language.keep(odd, model).collect()} >= {1, 2, 6, 9}
    assert not {r.doc_id for r in language.keep(odd, model).collect()} & {3, 4, 5, 8}
    one = [r.doc_id for r in near_dup.keep_one(odd).collect()]
    assert len(one) == len(set(one)) and {1, 3, 6, 7, 10} <= set(one) and not {2, 4, 5, 9} & set(one)
    clean = {r.doc_id for r in decontaminate.clean(odd, benchmark).collect()}
    assert not clean & {1, 2, 9} and {3, 4, 5, 7, 8, 10} <= clean
    hidden = {r.doc_id: r.text for r in secrets.redact(odd, ratios).collect()}
    assert hidden[10].startswith("naïve café — 日本語 [SECRET]") and hidden[1] == PROSE * 3 and hidden[3] is None


def test_pages(spark):
    rows = [(1, "u", None, 1), (2, None, "", 1), (3, "u", "<p>a", 1), (3, "u", "<p>a", 1), (4, "u", "<b " * 20_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(pages).orderBy("page_id").collect()]
    assert found[:4] == [(1, "", 0), (2, "", 0), (3, "a", 1), (3, "a", 1)] and found[4][0] == 4
    assert html_text.extract(pages.limit(0)).count() == 0


def test_vectors(spark):
    kind = "vec_id long, embedding array<float>, rank int"
    rows = [(0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, None, 0), (3, [None, 1.0], 0), (4, [float("nan"), 1.0], 0),
            (5, [float("inf"), 1.0], 0), (6, [-0.001, 0.25], 0), (1, [1.0, 0.5], 0), (50, [0.0, 0.0], 0), (7, [2.0], 0)]
    vectors = spark.createDataFrame(rows, kind)
    got = {}
    for r in topk.top(vectors, F.col("vec_id") % 50 == 0, 3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got[0]) == [(1, 7, 131072), (2, 1, 81920), (3, 1, 81920)]
    assert sorted(got[50]) == [(1, 0, 0), (2, 1, 0), (3, 1, 0)]
    assert topk.top(vectors.limit(0), F.col("vec_id") % 50 == 0, 3).count() == 0
    assert topk.top(vectors.where("vec_id = 2"), F.lit(True), 3).count() == 0

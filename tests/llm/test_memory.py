"""What Python workers hold, and how many there are, in the stages of the pipeline."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import language, near_copies
from millrace.llm.common import importable, stored
from millrace.llm.encoding import Encoder


def test_encoder_holds_few_words_and_small_slices():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array([" ".join(["some", "short", "words"] * 4000)] * 64)  # 4 MB
    expected = encoder.whole(texts[0].as_py())
    tracemalloc.start()
    for ids in encoder.documents(texts):
        assert ids.tobytes() == expected
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 24 << 20, most
    for k in range(120_000):
        encoder.keep(f"w{k}", b"")
    assert len(encoder.words) <= 100_000


def test_language_sample_starts_no_other_workers(spark, monkeypatch):
    # rows of an RDD would be read by Python workers of another daemon than that of Arrow functions
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "the cat and the dog").otherwise("der Hund und die Katze").alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
    )

    def refuse(*_, **__):
        raise AssertionError("an RDD of Python rows")

    monkeypatch.setattr(spark.sparkContext, "parallelize", refuse)
    model = language.fit(docs, F.lit(True))
    assert model.names == ["de", "en"]
    assert model.predict("the dog")[0] == "en" and model.predict("die Katze")[0] == "de"


def test_sets_are_made_in_a_stage_of_their_own(spark):
    importable(spark)
    docs = stored(spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, "x")], "doc_id long, text string"), "docs")
    found = stored(near_copies.entries(docs), "entries")
    codes = found.where("doc_id < 3").select("code").distinct()
    sets = near_copies._sets(docs, found, codes)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1, plan
    assert {(r.code, bytes(r.shingles)) for r in sets.collect()} == {
        (near_copies.code_of(s), s.tobytes()) for s in [near_copies.shingles("a b c d e f")]
    }

"""Random keys of letters alone, and what a base span leaves of a run."""

import random

from pyspark.sql import functions as F

from conftest import SMALL
from millrace.llm import secrets


def test_the_models_alone_decide(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    drawn = random.Random(4)
    drawn_keys = ["".join(drawn.choice(secrets.ALPHABET[:52]) for _ in range(24)) for _ in range(40)]
    values = [f"password = {drawn.randbytes(12).hex()} token={''.join(drawn.choice(secrets.ALPHABET) for _ in range(20))}" for _ in range(40)]
    more = spark.createDataFrame([(-1 - k, v) for k, v in enumerate(values)], table.schema)
    ratios = secrets.train(table.unionAll(more))
    hexed = "0f" * 16
    cases = [f"key {k} x" for k in drawn_keys] + [
        f"é {hexed}/{drawn_keys[0]} x",  # the base span ends within the run
        "the-plain-words-and-ordinary-names-in-code information/communication", "1234567890123456789012",
    ]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r.doc_id: r.s for r in secrets.find(docs, ratios).select("doc_id", secrets.written(F.col("spans")).alias("s")).collect()}
    assert [found[k] for k in range(40)] == ["random:4:28"] * 40
    assert found[40] == "hex:2:34,random:34:59"
    assert found[41] == found[42] == ""
    hidden = {r.doc_id: r.text for r in secrets.redact(docs, ratios).collect()}
    assert hidden[0] == "key [SECRET] x" and hidden[40] == "é [SECRET][SECRET] x" and hidden[41] == cases[41]

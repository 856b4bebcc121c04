"""SCD functions and stored tables against a row-by-row model, on random batches."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import scd
from millrace.sources.tables import AppendTable, save

KIND = "k int, p string, v int"
DAYS = [f"2024-01-0{i} 00:00:00" for i in range(1, 6)]


def draw_batches(seed, count=4):
    draw = random.Random(seed)
    keys = [None, *range(12)]
    return [
        [
            (k, draw.choice(["a", "b", "c", None]), draw.choice([1, 2, None]))
            for k in draw.sample(keys, draw.randint(1, 9))
        ]
        for _ in range(count)
    ]


def model1(batches):
    table = {}
    for batch in batches:
        table.update({row[0]: row for row in batch})
    return sorted(table.values(), key=str)


def model2(batches):
    table = []
    for day, batch in zip(DAYS, batches):
        for row in batch:
            current = [r for r in table if r["row"][0] == row[0] and r["end"] is None]
            if current and current[0]["row"] == row:
                continue
            for old in current:
                old["end"] = day
            table.append({"row": row, "start": day, "end": None})
    return sorted(((*r["row"], r["start"], r["end"], r["end"] is None) for r in table), key=str)


def model3(batches):
    table = {}
    for batch in batches:
        for k, p, v in batch:
            _, old, before = table.get(k, (None, v, None))
            table[k] = (p, v, old if old != v else before)
    return sorted(((k, *row) for k, row in table.items()), key=str)


def found(df):
    days = [c for c in ("start_date", "end_date") if c in df.columns]
    return sorted((tuple(r) for r in df.withColumns({d: F.col(d).cast("string") for d in days}).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_functions(spark, seed):
    batches = draw_batches(seed)
    frames = [spark.createDataFrame(b, KIND) for b in batches]
    one = two = three = None
    for frame, day in zip(frames, DAYS):
        one = scd.scd1(one, frame, ["k"])
        two = scd.scd2(two, frame, ["k"], None, day)
        three = scd.scd3(three, frame, ["k"], ["v"])
    assert found(one) == model1(batches)
    assert found(two) == model2(batches)
    assert found(three) == model3(batches)


@pytest.mark.parametrize("kind", ["SCD1", "SCD2", "SCD3", "SCD4"])
def test_stored_and_partitioned(spark, tmp_path, kind):
    """Keys move between partitions, partitions empty, nulls are keys and partitions."""
    batches = draw_batches(11, 5)
    output = {
        "path": str(tmp_path / "t"),
        "history_path": str(tmp_path / "h"),
        "store_type": kind,
        "primary_key": ["k"],
        "partition_by": ["p"],
        "tracking_columns": ["v"] if kind == "SCD3" else [],
    }
    for i, batch in enumerate(batches):
        stored = save(spark.createDataFrame(batch, KIND), output, as_of=DAYS[i])
        model = {"SCD2": model2, "SCD3": model3}.get(kind, model1)
        assert found(stored.read()) == model(batches[: i + 1])
    if kind == "SCD4":
        from millrace.sources.tables import VersionedTable

        history = AppendTable(spark, output["history_path"]).read()
        assert len(rows(history)) == sum(len(b) for b in batches)

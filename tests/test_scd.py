"""K3-K8, K11 on four batches: unchanged, changed, null to value, value to null, new key,
absent key, new column, duplicate key."""

import datetime as dt

import pytest
from conftest import rows

from millrace.operators import scd

T1, T2, T3 = (f"2024-01-0{i} 00:00:00" for i in (1, 2, 3))
D1, D2, D3 = (dt.datetime(2024, 1, i) for i in (1, 2, 3))


@pytest.fixture()
def batches(spark):
    make = lambda data, kind="k string, a string, b int": spark.createDataFrame(data, kind)
    return [
        make([("k1", "x", 1), ("k2", "y", 2), ("k3", None, 3)]),
        make([("k1", "x", 1), ("k2", "z", 2), ("k3", "w", 3), ("k4", "q", 4)]),
        make([("k2", None, 2, 9)], "k string, a string, b int, c int"),
        make([("k4", "q", 4), ("k4", "r", 5)]),
    ]


def test_scd1(batches):
    one, two, three, four = batches
    first = scd.scd1(None, one, ["k"])
    second = scd.scd1(first, two, ["k"])
    assert rows(second) == rows(two)
    assert rows(scd.scd1(second, two, ["k"])) == rows(two)  # idempotent
    third = scd.scd1(second, three, ["k"])
    assert rows(third) == [
        ("k1", "x", 1, None), ("k2", None, 2, 9), ("k3", "w", 3, None), ("k4", "q", 4, None),
    ]
    fourth = scd.scd1(third, four, ["k"], ["b desc"])
    assert ("k4", "r", 5, None) in rows(fourth) and fourth.count() == 4


def test_batch_takes_the_stored_types(spark, batches):
    text = batches[1].withColumn("b", batches[1]["b"].cast("string"))
    for out in (
        scd.scd1(batches[0], text, ["k"]),
        scd.scd2(scd.scd2(None, batches[0], ["k"]), text, ["k"]),
        scd.scd3(scd.scd3(None, batches[0], ["k"], ["b"]), text, ["k"], ["b"]),
        scd.append(batches[0], text),
    ):
        assert dict(out.dtypes)["b"] == "int" and out.filter("k = 'k4' AND b = 4").count() == 1


def test_scd1_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, "x", 1)], "k string, a string, b int")
    assert scd.scd1(df, df, ["k"]).count() == 1


def test_strict_refuses_duplicates(batches):  # D8
    *_, three, four = batches
    assert scd.scd1(three, four.limit(1), ["k"], strict=True).count() == 2
    with pytest.raises(Exception, match="duplicate key in batch"):
        scd.scd1(three, four, ["k"], strict=True).collect()
    with pytest.raises(ValueError):
        scd.scd1(None, four, [])


def test_scd2(batches):  # D3
    one, two, three, four = batches
    first = scd.scd2(None, one, ["k"], ["a", "b"], T1)
    assert first.columns == ["k", "a", "b", "start_date", "end_date", "is_current"]
    second = scd.scd2(first, two, ["k"], ["a", "b"], T2)
    assert rows(second) == [
        ("k1", "x", 1, D1, None, True),
        ("k2", "y", 2, D1, D2, False),
        ("k2", "z", 2, D2, None, True),
        ("k3", None, 3, D1, D2, False),
        ("k3", "w", 3, D2, None, True),
        ("k4", "q", 4, D2, None, True),
    ]
    third = scd.scd2(second, three, ["k"], None, T3)
    new = third.filter("k = 'k2' AND is_current").select("a", "b", "c", "start_date")
    assert rows(new) == [(None, 2, 9, D3)]
    assert third.count() == 7
    # closed rows stay closed, at most one open row per key, intervals join up
    open_rows = third.filter("is_current").groupBy("k").count()
    assert all(r["count"] == 1 for r in open_rows.collect()) and open_rows.count() == 4
    again = scd.scd2(third, three, ["k"], None, "2024-01-04 00:00:00")
    assert rows(again) == rows(third)
    fourth = scd.scd2(third, four, ["k"], ["a", "b"], T3, ["b desc"])
    assert ("r", 5) in rows(fourth.filter("k = 'k4' AND is_current").select("a", "b"))


def test_scd2_tracks_only_what_it_is_told(batches):
    one, two, *_ = batches
    first = scd.scd2(None, one, ["k"], ["b"], T1)
    assert rows(scd.scd2(first, two, ["k"], ["b"], T2).filter("k <> 'k4'")) == rows(first)


def test_scd3(batches):  # D4
    one, two, three, _ = batches
    first = scd.scd3(None, one, ["k"], ["a"])
    assert rows(first) == [("k1", "x", 1, None), ("k2", "y", 2, None), ("k3", None, 3, None)]
    second = scd.scd3(first, two, ["k"], ["a"])
    assert rows(second) == [
        ("k1", "x", 1, None), ("k2", "z", 2, "y"), ("k3", "w", 3, None), ("k4", "q", 4, None),
    ]
    third = scd.scd3(second, three, ["k"], ["a"])
    assert third.columns == ["k", "a", "b", "prev_a", "c"]
    assert ("k2", None, 2, "z", 9) in rows(third) and third.count() == 4
    # an unchanged value keeps its previous one
    assert rows(scd.scd3(third, three, ["k"], ["a"])) == rows(third)
    with pytest.raises(ValueError):
        scd.scd3(None, one, ["k"], [])


def test_history(batches):
    one, two, three, _ = batches
    whole = scd.append(scd.scd4_history(one, T1), scd.scd4_history(two, T2))
    assert whole.count() == 7 and set(rows(whole.select("record_timestamp"))) == {(D1,), (D2,)}
    some = scd.scd4_history(two, T2, one, ["k"], ["a", "b"], True)
    assert rows(some.select("k")) == [("k2",), ("k3",), ("k4",)]
    wide = scd.append(whole, scd.scd4_history(three, T3))
    assert wide.columns[-1] == "c" and wide.filter("c = 9").count() == 1
    new_column = scd.scd4_history(three, T3, two, ["k"], ["a", "c"], True)
    assert rows(new_column.select("k")) == [("k2",)]


def test_delete_where(batches):
    assert rows(scd.delete_where(batches[0], "a = 'x'").select("k")) == [("k2",), ("k3",)]


def test_table_is_not_shuffled_for_a_small_batch(spark, batches, tmp_path):
    table, batch = str(tmp_path / "t"), str(tmp_path / "b")
    scd.scd2(None, batches[0], ["k"], None, T1).write.parquet(table)
    batches[1].write.parquet(batch)
    out = scd.scd2(spark.read.parquet(table), spark.read.parquet(batch), ["k"], None, T2)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line and f"[file:{table}]" in line:
            above = "\n".join(lines[max(0, i - 4) : i])
            assert "Exchange hashpartitioning" not in above

"""Q1-Q9."""

import datetime as dt

import pytest
from conftest import rows

from millrace.operators import quality as q

NOW = "2024-01-10 00:00:00"


def result(df, *configs):
    out = q.validate(df, q.parse_rules(list(configs)), "t", NOW).collect()
    return {(r["column"], r["check"]): (r["violations"], r["passed"]) for r in out}


@pytest.fixture()
def df(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 9)] + [dt.datetime(2025, 1, 1), None]
    return spark.createDataFrame(
        [(n, s, d) for n, s, d in zip((1, -1, None, 90), ("a1", "b", None, "a1"), days)],
        "n int, s string, d timestamp",
    )


def test_numeric_minimum_counts(df):  # D2
    got = result(df, {"column": "n", "type": "numeric", "min_value": 0, "max_value": 50,
                      "null_allowed": False, "unique": True})
    assert got == {
        ("n", "null"): (1, False),
        ("n", "unique"): (0, True),
        ("n", "min_value"): (1, False),
        ("n", "max_value"): (1, False),
    }


def test_string_without_pattern(df):  # D11
    assert result(df, {"column": "s", "type": "string", "unique": True}) == {
        ("s", "unique"): (1, False)
    }
    assert result(df, {"column": "s", "type": "string", "pattern": "[0-9]"}) == {
        ("s", "pattern"): (1, False)
    }


def test_two_nulls_are_one_value(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "s string")
    assert result(df, {"column": "s", "type": "string", "unique": True})[("s", "unique")][0] == 1
    empty = df.limit(0)
    assert result(empty, {"column": "s", "type": "string", "unique": True}) == {
        ("s", "unique"): (0, True)
    }


def test_timestamp(df):  # D2
    rule = {"column": "d", "type": "timestamp", "max_age_days": 5, "null_allowed": False}
    assert result(df, rule) == {
        ("d", "null"): (1, False), ("d", "max_age_days"): (1, False), ("d", "future"): (1, False),
    }
    assert ("d", "future") not in result(df, {**rule, "allow_future": True})


def test_two_rules_on_one_column(df):  # D12
    got = result(
        df,
        {"column": "n", "type": "numeric", "min_value": 0},
        {"column": "n", "type": "numeric", "max_value": 10},
    )
    assert set(got) == {("n", "min_value"), ("n", "max_value")}


def test_missing_column(df):  # D23
    assert result(df, {"column": "zz", "type": "numeric", "min_value": 0}) == {
        ("zz", "column missing"): (4, False)
    }


def test_no_rules(df):
    assert q.validate(df, [], "t").count() == 0


def test_one_aggregate_for_all_rules(df):
    rules = q.parse_rules(
        [
            {"column": "n", "type": "numeric", "min_value": 0},
            {"column": "s", "type": "string", "pattern": "a", "null_allowed": False},
            {"column": "d", "type": "timestamp"},
        ]
    )
    plan = q.validate(df, rules, "t", NOW)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_parse():
    with pytest.raises(ValueError, match="unknown rule type"):
        q.parse_rule({"column": "a", "type": "regex"})
    with pytest.raises(ValueError, match="parameters"):
        q.parse_rule({"column": "a", "type": "numeric", "minimum": 1})
    assert q.parse_rule({"column": "a", "type": "numeric", "parameters": {"min_value": 2}}).min_value == 2


def test_rule_book():  # D13
    book = q.RuleBook.from_config(
        {
            "shop.items": {"rules": [{"column": "a", "type": "string"}]},
            "join_validations": [{"source_table": "a", "target_table": "b", "keys": ["k"]}],
        }
    )
    assert len(book.rules("shop.items")) == 1 and book.rules("other") == [] and len(book.joins) == 1


def test_summary(df):
    report = q.validate(
        df, q.parse_rules([{"column": "n", "type": "numeric", "min_value": 0, "max_value": 99}]), "t"
    )
    assert rows(q.summarise(report)) == [("t", 4, 2, 1, 1, "n.min_value", False)]


def test_schema(df):
    assert q.schema_difference(df, {"n": "int", "s": "string", "d": "timestamp"}) == []
    assert q.schema_difference(df, {"n": "bigint", "s": "string", "x": "int"}) == [
        ("extra", "d", "timestamp"), ("extra", "n", "int"),
        ("missing", "n", "bigint"), ("missing", "x", "int"),
    ]
    assert q.check_schema(df, df.schema)
    assert not q.check_schema(df, {"n": "int"})
    assert not q.check_schema(df, {"n": "int"}, strict=True)
    with pytest.raises(ValueError, match="schema differs"):
        q.check_schema(df, {"n": "string"}, strict=True)


def test_orphans(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",), (None,), (None,)], "k string")
    got = q.orphan_check(left, right, ["k"], 0.7).first()
    assert tuple(got) == (3, 3, 2, 2, 2 / 3, 2 / 3, True)
    nothing = q.orphan_check(left.limit(0), right.limit(0), ["k"]).first()
    assert tuple(nothing) == (0, 0, 0, 0, 0.0, 0.0, True)


def test_join_rules(spark):
    frames = {
        "a": spark.createDataFrame([("x",), ("y",)], "k string"),
        "b": spark.createDataFrame([("x",), ("z",), ("w",)], "k string"),
    }
    rule = {"source_table": "a", "target_table": "b", "keys": ["k"], "max_orphaned_ratio": 0.5}
    assert rows(q.check_joins(frames, [rule])) == [("a", "b", "k", 2, 1, 0.5, True)]
    assert q.check_joins(frames, []) is None

"""P, J, A, O, U, N rows and the registry."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import STEPS, StepRegistry
from millrace.operators import columns as c
from millrace.operators import joins as j
from millrace.operators import normalise as n
from millrace.operators import rows as r


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(
        [("k1", "7", 1.0), ("k2", "x", None), ("k2", None, 3.0)], "k string, v string, w double"
    )


def test_registry():
    steps = StepRegistry()

    @steps.register()
    def twice(df):
        return df

    @steps.register("other", frames=("df2",))
    def joined(df, df2):
        return df

    assert steps.names() == ["other", "twice"] and steps.get("twice") is twice
    assert steps.frame_parameters("other") == ("df2",)
    with pytest.raises(ValueError, match="unknown step"):
        steps.get("absent")
    with pytest.raises(ValueError, match="already"):
        steps.register("twice")(joined)
    with pytest.raises(ValueError, match="no parameters"):
        steps.register("third", frames=("nope",))(joined)


def test_all_steps_are_registered():
    assert STEPS.names() == [
        "add_columns",
        "cast_columns",
        "drop_columns",
        "drop_duplicates",
        "extract_df",
        "extract_transitive_dependencies",
        "extract_unique_entities",
        "filter_rows",
        "group_and_aggregate",
        "join_dataframes",
        "rename_columns",
        "select_columns",
        "sort_dataframe",
        "split_column_to_rows",
    ]


def test_rename(df):
    assert c.rename(df, {"k": "key", "absent": "x"}).columns == ["key", "v", "w"]
    for bad in ({"k": "v"}, {"k": "v", "v": "w2"}, {"k": "z", "v": "z"}):
        with pytest.raises(ValueError):
            c.rename(df, bad)


def test_cast_bad_value_is_null(df):
    assert rows(c.convert(df, {"v": "int"}).select("v")) == [(None,), (None,), (7,)]


def test_derive_in_order(df):
    out = c.derive(df, {"a": "w + 1", "b": "try_divide(a, 0)"})
    assert rows(out.select("a", "b")) == [(None, None), (2.0, None), (4.0, None)]


def test_drop_and_project(df):
    assert c.discard(df, ["v", "absent"]).columns == ["k", "w"]
    assert c.project(df, ["w", "k"]).columns == ["w", "k"]
    assert c.prefixed(df, "p_", ["k"]).columns == ["p_k", "v", "w"]
    assert c.stamp(df, {"s": 1}).first()["s"] == 1


def test_filter_null_drops(df):
    assert r.where(df, "w > 1").count() == 1


def test_deduplicate(df):
    assert rows(r.deduplicate(df, ["k"], ["w desc"])) == [("k1", "7", 1.0), ("k2", None, 3.0)]
    # without order: by the other columns, nulls first, the same row in every run
    assert rows(r.deduplicate(df, ["k"])) == [("k1", "7", 1.0), ("k2", None, 3.0)]
    assert r.deduplicate(df.union(df)).count() == 3
    assert r.deduplicate(df, ["k", "v", "w"]).count() == 3


def test_deduplicate_with_map_column(spark):
    df = spark.sql("SELECT 1 AS k, map('a', x) AS m FROM VALUES (2), (1) AS t(x)")
    assert r.deduplicate(df, ["k"]).first()["m"] == {"a": 1}


def test_deduplicate_cuts_before_the_shuffle(df):
    plan = r.deduplicate(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_ordering_is_checked(df):
    with pytest.raises(ValueError):
        r.ordering(["k sideways"])
    assert len(r.ordering(["k", ("v", "desc"), F.col("w")])) == 3


def test_sort_null_order(df):
    up = [x["w"] for x in r.sort(df, ["w"]).collect()]
    down = [x["w"] for x in r.sort(df, ["w"], ascending=False).collect()]
    assert up == [None, 1.0, 3.0] and down == [3.0, 1.0, None]


def test_sort_spreads_one_hot_value(spark):
    df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("v"), (F.col("id") % 3).alias("copy"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = r.sort(df, ["v"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(s["count"] for s in sizes) < 20_000


def test_aggregate(df):
    out = r.aggregate(df, ["k"], {"n": "count(*)", "s": "sum(w)", "d": "count(DISTINCT v)"})
    assert rows(out) == [("k1", 1, 1.0, 1), ("k2", 2, 3.0, 1)]


def test_split_to_rows(spark):
    df = spark.createDataFrame([(1, "a|b||c"), (2, None), (3, "")], "i int, t string")
    assert rows(r.split_to_rows(df, "t", "|")) == [
        (1, ""), (1, "a"), (1, "b"), (1, "c"), (3, ""),
    ]
    assert (2, None) in rows(r.split_to_rows(df, "t", "|", keep_empty=True))
    spaced = spark.createDataFrame([(1, "a , b")], "i int, t string")
    assert rows(r.split_to_rows(spaced, "t", trim=True)) == [(1, "a"), (1, "b")]


def test_preview_and_union(df):
    assert rows(r.preview(df, ["k desc"], 1)) == [("k2", None, 3.0)]
    assert r.union_all([df, df.select("w", "v", "k")]).count() == 6
    assert r.union_all([df, df.drop("w")], allow_missing=True).filter("w IS NULL").count() == 4


def test_joins(spark, df):
    names = spark.createDataFrame([("k1", "one"), ("k1", "uno"), (None, "none")], "k string, n string")
    assert j.join_using(df, names, ["k"]).count() == 2
    assert j.join_using(df, names, ["k"], "left").count() == 4
    assert rows(j.left_join_fanout(df, names, ["k"])) == rows(df.join(names, "k", "left"))
    assert rows(j.orphans(names, df, ["k"])) == [(None,)]
    assert rows(j.without_keys(names, names.filter("k IS NULL"), ["k"]).select("k")) == [
        ("k1",), ("k1",),
    ]
    assert j.with_keys(names, names, ["k"]).count() == 3


def test_lookup_join_gives_no_hint(spark, df):
    names = spark.createDataFrame([("k1", "one"), ("k2", "two")], "key string, n string")
    joined = j.lookup_join(df, names, {"k": "key"})
    assert joined.count() == 3
    assert "broadcast" not in joined._jdf.queryExecution().logical().toString().lower()


def test_split_values_keeps_records_without_values(spark):  # D7
    df = spark.createDataFrame(
        [("v1", "t", "a,b"), ("v1", "t", "b,c"), ("v2", "u", None)], "id string, t string, tags string"
    )
    records, values = n.split_values(df, "tags", ["id"], ["id"], key_column="key")
    assert rows(records) == [("v1", "t"), ("v2", "u")]
    assert rows(values.select("id", "value")) == [("v1", "a"), ("v1", "b"), ("v1", "c")]
    assert values.select("key").distinct().count() == 3


def test_entities_keep_null(spark):  # D6
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "x")], "i int, e string")
    facts, entities = n.extract_entities(df, ["e"], "e_id")
    back = facts.join(entities, "e_id").select("i", "e")
    assert rows(back) == rows(df) and entities.count() == 2
    kept, natural = n.extract_entities(df, ["i", "e"], "i", False, ["e"])
    assert kept.columns == ["i"] and natural.columns == ["i", "e"]


def test_dependencies(spark):
    df = spark.createDataFrame(
        [(1, "b1", "y", 2), (2, "b1", "x", 9), (3, "b2", "z", 1), (4, None, "q", 0)],
        "i int, b string, t string, s int",
    )
    facts, lookup = n.extract_dependencies(df, ["b"], ["t", "s"], "brand", variants_column="n")
    assert rows(lookup.select("b", "t", "s", "n")) == [
        (None, "q", 0, 1), ("b1", "x", 9, 2), ("b2", "z", 1, 1),
    ]
    assert facts.columns == ["i", "b", "brand_id"]
    assert facts.join(lookup, "brand_id").count() == 4
    assert rows(n.extract_dependencies(df, ["b"], ["t", "s"], "brand")[1]) == rows(
        lookup.drop("n")
    )

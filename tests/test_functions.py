"""F1-F17."""

import datetime as dt
import hashlib

from conftest import rows
from pyspark.sql import functions as F

from millrace import functions as f
from millrace.functions.metrics import as_timestamp, days_before


def one(spark, value, column, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column).first()[0]


def test_clean_text(spark):
    assert one(spark, "\n a\r\nb\u3000\x1f", f.clean_text("x")) == "a  b"
    assert one(spark, None, f.clean_text("x")) == "N/A"
    assert one(spark, None, f.clean_text("x", missing=None)) is None
    assert one(spark, "", f.clean_text("x")) == ""


def test_clean_text_quotes_are_an_option(spark):  # D20
    assert one(spark, 'a "b"', f.clean_text("x")) == 'a "b"'
    assert one(spark, 'a "b"', f.clean_text("x", escape_quotes=True)) == 'a ""b""'


def test_clean_text_agrees_with_python_strip(spark):
    given = [chr(c) + "x y" + chr(c) for c in range(1, 0x3100) if chr(c) not in "\n\r"]
    df = spark.createDataFrame([(g,) for g in given], "x string")
    got = df.select("x", f.clean_id("x").alias("y")).collect()
    assert [r.y for r in got] == [r.x.strip() for r in got]


def test_clean_number(spark):
    cases = {"7": 7, " -8\t": -8, "N/A": None, "1.5": None, "": None, None: None, "9" * 30: None}
    for given, wanted in cases.items():
        assert one(spark, given, f.clean_number("x")) == wanted


def test_duration(spark):  # D19
    cases = {
        "PT1H2M3S": 3723.0,
        "PT45S": 45.0,
        "PT0S": 0.0,
        "PT1.5S": 1.5,
        "P1DT2H": 93600.0,
        "P2W": 1209600.0,
        "2024-09-29T06:00": 1727589600.0,
        "2024-13-29T06:00": None,
        "garbage": None,
        "P": None,
        "PT": None,
        "": None,
        None: None,
    }
    for given, wanted in cases.items():
        assert one(spark, given, f.duration_seconds("x")) == wanted, given


def test_join_values(spark):
    assert one(spark, ["a", "b"], f.join_values("x"), "array<string>") == "a,b"
    assert one(spark, None, f.join_values("x"), "array<string>") == ""


def test_entity_key(spark):  # D5
    df = spark.createDataFrame(
        [("a", "bc"), ("ab", "c"), (None, "x"), ("~", "x"), ("a", "bc")], "x string, y string"
    )
    keys = [r[0] for r in df.select(f.entity_key("x", "y")).collect()]
    assert len(set(keys)) == 4 and keys[0] == keys[4]
    assert keys[0] == hashlib.sha256(b"1:a2:bc").hexdigest()
    assert keys[2] == hashlib.sha256(b"~1:x").hexdigest()


def test_ratio(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(f.ratio("a", "b", 100)).collect()] == [150.0, None, None]


def test_clock(spark):
    moment = "2024-03-01 00:00:00"
    df = spark.createDataFrame([(dt.datetime(2020, 12, 31),)], "x timestamp")
    assert df.select(f.years_between("x", moment)).first()[0] == 4
    assert df.select(days_before(1, moment)).first()[0] == dt.datetime(2024, 2, 29)
    aware = dt.datetime(2024, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert df.select(as_timestamp(aware)).first()[0] == dt.datetime(2024, 1, 1)
    assert df.select(as_timestamp(None).isNotNull()).first()[0]


def test_decode_key(spark):
    cases = {"a%2Fb+c%20d": "a/b+c d", "50%": "50%", "%zz%41": "%zzA", "%E4%BD%A0": "你"}
    for given, wanted in cases.items():
        assert one(spark, given, f.decode_key("x")) == wanted


def test_paths(spark):
    assert one(spark, "s3a://b/x/current/", f.last_segment("x")) == "current"
    assert one(spark, "s3a://b/x/current", f.parent_path("x")) == "s3a://b/x"
    assert one(spark, "x", f.parent_path("x")) == ""
    assert one(spark, "a/b", f.path_part("x", 1)) == "b"
    assert one(spark, "a/b", f.path_part("x", 2)) is None


def test_rows_helper(spark):
    assert rows(spark.range(2).select(F.col("id"))) == [(0,), (1,)]

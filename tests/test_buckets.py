"""Bucketed tables, wider types, inputs read once, rules measured in passing, rejected lines."""

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import quality as q
from millrace.operators import scd
from millrace.plans import runner
from millrace.plans.golden import ENTITY_BUCKETS, GOLDEN, RAW_SCHEMAS
from millrace.sources.catalog import register_outputs
from millrace.sources.ledger import Ledger
from millrace.sources.tables import AppendTable, BucketedTable, VersionedTable, save, stored_table


def people(spark, first, last, name="n", extra=None):
    df = spark.range(first, last).select(F.col("id").cast("int").alias("k"), F.concat(F.lit(name), "id").alias("name"))
    return df.withColumn("note", F.lit(extra)) if extra else df


def files(path):
    return {str(f.relative_to(path)): f.stat().st_ino for f in Path(path).rglob("*.parquet")}


def buckets_of(names):
    return {n.split("/")[0] for n in names}


def output(path, kind="SCD1", **more):
    return {"path": str(path), "store_type": kind, "primary_key": ["k"], "buckets": 8, **more}


def test_a_merge_replaces_only_its_buckets(spark, tmp_path):
    path = tmp_path / "people"
    table = save(people(spark, 0, 400), output(path))
    before = files(path)
    assert len(buckets_of(before)) == 8
    batch = people(spark, 7, 8, "new ")
    touched = {f"{BucketedTable.BUCKET}={n}" for n in table.touched(batch)}
    assert len(touched) == 1
    # what lies in the other buckets is never opened, not even for its keys
    for name in before:
        if name.split("/")[0] not in touched:
            (path / name).write_bytes(b"not parquet")
            (path / name).with_name(f".{Path(name).name}.crc").unlink(missing_ok=True)
    save(batch, output(path))
    after = files(path)
    changed = {n for n in before.keys() | after.keys() if before.get(n) != after.get(n)}
    assert buckets_of(changed) == touched
    assert rows(BucketedTable(spark, str(path)).find({"k": 7})) == [(7, "new 7")]
    assert BucketedTable(spark, str(path)).version() == 2


@pytest.mark.parametrize("kind", ["SCD1", "SCD2", "SCD3", "SCD4"])
def test_the_same_rows_as_without_buckets(spark, tmp_path, kind):
    days = [people(spark, 0, 60), people(spark, 50, 70, "m"), people(spark, 55, 58, "p", "late"), people(spark, 0, 0)]
    for place, more in (("plain", {"buckets": None}), ("bucketed", {})):
        for number, day in enumerate(days, 1):
            spec = output(tmp_path / place, kind, tracking_columns=["name"], history_path=str(tmp_path / f"{place}-history"), **more)
            save(day, spec, as_of=f"2024-01-0{number} 00:00:00")
    plain, bucketed = (stored_table(spark, str(tmp_path / p)) for p in ("plain", "bucketed"))
    assert isinstance(plain, VersionedTable) and isinstance(bucketed, BucketedTable)
    assert rows(plain.read()) == rows(bucketed.read().select(*plain.read().columns))
    assert BucketedTable.BUCKET not in bucketed.read().columns
    if kind == "SCD4":
        histories = [rows(AppendTable(spark, str(tmp_path / f"{p}-history")).read()) for p in ("plain", "bucketed")]
        assert histories[0] == histories[1]


def test_delete_and_empty_buckets(spark, tmp_path):
    path = tmp_path / "t"
    assert BucketedTable(spark, str(path), ["k"]).delete("k = 1") is None
    table = save(people(spark, 0, 20), output(path))
    before = files(path)
    gone = table.touched(people(spark, 3, 4))[0]
    own = [r.k for r in table.read().collect() if table.touched(people(spark, r.k, r.k + 1)) == [gone]]
    table.delete(f"k IN ({', '.join(map(str, own))})")
    assert sorted(r.k for r in table.read().collect()) == sorted(set(range(20)) - set(own))
    after = files(path)
    assert buckets_of(before) - buckets_of(after) == {f"{BucketedTable.BUCKET}={gone}"}
    assert all(before[n] == inode for n, inode in after.items())
    assert table.delete("k = 999") == table.version()
    assert table.read(partitions={"k": own[0]}).count() == 0


def test_null_and_repeated_keys(spark, tmp_path):
    kind = "k int, name string"
    save(spark.createDataFrame([(None, "a"), (1, "b")], kind), output(tmp_path / "t"))
    table = save(spark.createDataFrame([(None, "c"), (None, "d"), (1, "e")], kind), output(tmp_path / "t", order_by=["name"]))
    assert rows(table.read()) == [(None, "c"), (1, "e")]
    assert rows(table.find({"k": None})) == [(None, "c")]


def test_faults(spark, tmp_path):
    with pytest.raises(ValueError, match="at least one bucket"):
        BucketedTable(spark, str(tmp_path / "x"))
    table = save(people(spark, 0, 3), output(tmp_path / "t"))
    with pytest.raises(ValueError, match="not by"):
        BucketedTable(spark, str(tmp_path / "t"), ["name"])
    with pytest.raises(ValueError, match="not by"):
        table.merge(people(spark, 0, 3), ["name"], lambda old, new: new)
    with pytest.raises(ValueError, match="lacks key columns"):
        table.merge(people(spark, 0, 3).drop("k"), ["k"], lambda old, new: new)
    with pytest.raises(ValueError, match="has a column"):
        table.merge(people(spark, 0, 3).withColumn(BucketedTable.BUCKET, F.lit(1)), ["k"], lambda old, new: new)
    assert BucketedTable(spark, str(tmp_path / "t"), buckets=99).buckets == 8  # fixed by the first write
    assert BucketedTable(spark, str(tmp_path / "none"), ["k"]).read() is None


def test_catalog_entry(spark, tmp_path):
    spec = output(tmp_path / "folk", dataframe="df")
    save(people(spark, 0, 30), spec)
    register_outputs(spark, "bucketed", [{**spec, "schema": people(spark, 0, 1).schema}])
    assert spark.table("bucketed.folk").count() == 30
    save(people(spark, 25, 45), spec)
    register_outputs(spark, "bucketed", [{**spec, "schema": people(spark, 0, 1).schema}])
    assert spark.table("bucketed.folk").select("k", "name").distinct().count() == 45


# --- wider types


def test_what_is_wider():
    d = T.DecimalType
    assert scd.wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert scd.wider(T.LongType(), T.IntegerType()) == T.LongType()
    assert scd.wider(T.LongType(), d(10, 2)) == d(22, 2)
    assert scd.wider(d(10, 2), d(12, 6)) == d(14, 6)
    assert scd.wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert scd.wider(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    for a, b in ((T.LongType(), T.DoubleType()), (T.StringType(), T.IntegerType()), (d(38, 0), d(38, 10)), (T.DateType(), T.TimestampType())):
        assert scd.wider(a, b) is None and scd.wider(b, a) is None


@pytest.mark.parametrize("make", ["bucketed", "versioned", "appended"])
def test_three_batches_ever_wider(spark, tmp_path, make):
    batches = [
        spark.createDataFrame([(1, 5, 1.5), (2, 6, 2.5)], "k int, v int, f float"),
        spark.createDataFrame([(2, 1 << 40, 0.1)], "k bigint, v bigint, f double"),
        spark.sql("SELECT 3 AS k, 12345678901234567890.25BD AS v, 4.0D AS f"),
    ]
    want = [(1, 5, 1.5), (2, 1 << 40, 0.1), (3, 12345678901234567890.25, 4.0)]
    if make == "appended":
        table = AppendTable(spark, str(tmp_path / "t"))
        for n, batch in enumerate(batches):
            table.append(batch, str(n))
        want.insert(1, (2, 6, 2.5))
        wrong = lambda df: table.append(df, "x")
    else:
        spec = output(tmp_path / "t", **({} if make == "bucketed" else {"buckets": None}))
        for batch in batches:
            table = save(batch, spec)
        wrong = lambda df: save(df, spec)
    got = table.read()
    assert dict(got.dtypes) == {"k": "bigint", "v": "decimal(22,2)", "f": "double"}
    assert [(r.k, float(r.v), r.f) for r in got.orderBy("k", "v").collect()] == want
    with pytest.raises(ValueError, match="does not fit"):
        wrong(spark.createDataFrame([(4, 1.5, 1.0)], "k int, v double, f float"))


# --- one pass


class Counted:
    """Inputs whose rows are counted as often as they are read."""

    def __init__(self, spark, monkeypatch):
        self.count = spark.sparkContext.accumulator(0)
        count, read = self.count, runner.read_input

        def counted(spark, config):
            df = read(spark, config)

            def pass_by(batches):
                for batch in batches:
                    count.add(len(batch))
                    yield batch

            return df.mapInPandas(pass_by, df.schema)

        monkeypatch.setattr(runner, "read_input", counted)


def raw_rows(spark, dataset, n=40):
    fields = T.StructType.fromDDL(RAW_SCHEMAS[dataset]).fields
    columns = []
    for f in fields:
        value = F.concat(F.lit(f"{f.name} "), F.col("id") % 7)
        if f.name in ("video_id", "comment_thread_id", "comment_id") or (f.name == "channel_id" and dataset.startswith("channels")):
            value = F.concat(F.lit("x"), "id")
        elif f.name.endswith("count"):
            value = (F.col("id") * 10).cast("string")
        elif f.name.endswith("_at"):
            value = F.lit("2024-02-03T00:00:00Z")
        elif f.name in ("category_id",):
            value = (F.col("id") % 3).cast("string")
        elif f.name == "tags":
            value = F.lit('["a", "b"]')
        columns.append(value.cast(f.dataType).alias(f.name) if f.dataType == T.StringType() else F.lit(None).cast(f.dataType).alias(f.name))
    return spark.range(n).select(*columns)


@pytest.mark.parametrize("dataset", sorted(set(GOLDEN) - {"categories"}))
def test_a_run_reads_its_input_once(spark, tmp_path, monkeypatch, dataset):
    raw_rows(spark, dataset).write.option("header", True).option("escape", '"').csv(str(tmp_path / "raw"))
    spec = GOLDEN[dataset](str(tmp_path / "golden"))
    spec["input"]["path"] = str(tmp_path / "raw")
    frame = spec["output"][0]["dataframe"]
    key = spec["output"][0]["primary_key"][0]
    spec["quality"] = {frame: [{"column": key, "type": "string", "null_allowed": False, "unique": True}]}
    counted = Counted(spark, monkeypatch)
    result = runner.execute(spark, spec)
    assert len(spec["output"]) > 1 and counted.count.value == 40
    assert {(r["check"], r["violations"], r["row_count"]) for r in result.quality.collect()} == {("null", 0, 40), ("unique", 0, 40)}
    for out in result.outputs:
        assert stored_table(spark, out["path"]).read().count() == result.frames[out["dataframe"]].count()
        assert BucketedTable.is_at(spark, out["path"]) == (out.get("buckets") == ENTITY_BUCKETS)


def test_shared_steps():
    step = lambda name, **more: {"name": name, "params": {}, **more}
    assert runner.shared_steps([step("rename_columns"), step("filter_rows"), step("extract_df", multi_output=True)]) == 2
    assert runner.shared_steps([step("select_columns", output_names=["other"]), step("filter_rows")]) == 0
    assert runner.shared_steps([step("filter_rows"), step("join_dataframes", params={"df2": "other"})]) == 1
    assert runner.shared_steps([]) == 0


def test_rules_measured_in_passing_are_those_of_a_pass(spark, tmp_path):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'a', TIMESTAMP'2024-01-01'), (1, null, TIMESTAMP'2030-01-01'), (null, 'bb', null), (9, 'a', null) AS t(i, s, at)"
    )
    rules = q.parse_rules([
        {"column": "i", "type": "numeric", "null_allowed": False, "unique": True, "min_value": 2, "max_value": 8},
        {"column": "s", "type": "string", "pattern": "^a$", "unique": True},
        {"column": "at", "type": "timestamp", "max_age_days": 10},
        {"column": "absent", "type": "string"},
    ])
    for some in (df, df.limit(0)):
        watch = q.Watch(some, rules, "t", "2024-06-01 00:00:00")
        path = str(tmp_path / str(some.count()))
        watch.frame.write.parquet(path)
        got = watch.report(spark.read.parquet(path))
        want = q.validate(some, rules, "t", "2024-06-01 00:00:00")
        assert got.dtypes == want.dtypes and rows(got) == rows(want)


def test_a_blocking_rule_stops_every_output(spark, tmp_path):
    raw_rows(spark, "replies").write.option("header", True).csv(str(tmp_path / "raw"))
    spec = GOLDEN["replies"](str(tmp_path / "golden"))
    spec["input"]["path"] = str(tmp_path / "raw")
    spec["quality_blocking"], spec["quality_path"] = ["min_value"], str(tmp_path / "report")
    spec["quality"] = {"replies_df": [{"column": "reply_likes", "type": "numeric", "min_value": 1}]}
    book = Ledger(spark, str(tmp_path / "ledger"))
    with pytest.raises(ValueError, match="blocking quality rules"):
        runner.execute(spark, spec, book)
    assert not (tmp_path / "golden").exists()
    assert spark.read.parquet(str(tmp_path / "report")).first()["violations"] == 1
    work = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(work.glob("batch-*")) and not list(work.glob("input-*"))


# --- rejected lines


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_good_and_rejected_rows_are_all_lines(spark, tmp_path, kind):
    good = [{"k": i, "name": f"n{i}", "v": i / 2} for i in range(5)]
    if kind == "json":
        lines = [json.dumps(g) for g in good] + ['{"k": "x", "name": "n"}', "{broken", '"a text"']
    else:
        lines = ["k,name,v", *(f"{g['k']},{g['name']},{g['v']}" for g in good), "x,n,1.0", "7,too,1.0,many", "8,few"]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / f"a.{kind}").write_text("\n".join(lines) + "\n")
    spec = {
        "batch_id": "b1",
        "input": {"format": kind, "path": str(tmp_path / "raw"), "schema": "k int, name string, v double",
                  "options": {"header": "true"} if kind == "csv" else {}, "rejects": str(tmp_path / "rejects")},
        "transformations": [{"name": "select_columns", "params": {"columns": ["k", "name"]}}],
        "output": [{"dataframe": "input_df", "path": str(tmp_path / "t"), "primary_key": ["k"], "buckets": 2}],
    }
    for _ in range(2):  # a run that is repeated rejects nothing twice
        runner.execute(spark, spec)
    kept, out = stored_table(spark, str(tmp_path / "t")).read(), spark.read.parquet(str(tmp_path / "rejects"))
    assert rows(kept) == [(i, f"n{i}") for i in range(5)]
    assert sorted(r.line for r in out.collect()) == sorted(lines[-3:])
    assert all(r.file.endswith(f"a.{kind}") and r.batch == "b1" for r in out.collect())


def test_rejects_need_a_schema(spark):
    for config in ({"format": "parquet", "schema": "a int"}, {"format": "csv"}):
        with pytest.raises(ValueError, match="rejects need"):
            runner.read_input(spark, {**config, "path": "x", "rejects": "y"})

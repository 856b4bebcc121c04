"""Files, manifests, stored tables, catalog and ledger."""

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.sources import catalog, files, ledger
from millrace.operators import scd
from millrace.sources import manifest as m
from millrace.sources import readers as rd
from millrace.sources.tables import AppendTable, VersionedTable, merge_in_place, save, write_partitioned


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(
        [(1, "a,b", 2020), (2, 'say "x"', 2021), (3, None, 2021)], "i int, t string, year int"
    )


# --- readers

def test_read_input(spark, df, tmp_path):
    path = str(tmp_path / "j")
    df.write.json(path)
    config = {"format": "json", "path": path, "schema": "i int, year int"}
    assert rd.read_input(spark, config).columns == ["i", "year"]
    narrow = rd.read_input(spark, {**config, "select_columns": ["year"], "path": [path]})
    assert narrow.columns == ["year"] and narrow.count() == 3
    spread = rd.read_input(spark, {**config, "repartition": 5})
    assert spread.rdd.getNumPartitions() == 5
    with pytest.raises(ValueError, match="unsupported input format"):
        rd.read_input(spark, {"format": "xml", "path": path})


@pytest.mark.parametrize("level", ["MEMORY_ONLY", "DISK_ONLY", "no such level"])
def test_persisted_input(spark, df, tmp_path, level):
    df.write.parquet(str(tmp_path / "p"))
    config = {"format": "parquet", "path": str(tmp_path / "p"), "cache": True}
    cached = rd.read_input(spark, {**config, "data_persistence": level})
    assert cached.is_cached and cached.count() == 3
    assert cached.storageLevel.useDisk == (level != "MEMORY_ONLY")
    cached.unpersist()


def test_dependencies(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "p"))
    frames = rd.read_dependencies(spark, {"d": str(tmp_path / "p")}, ["d"])
    assert frames["d"].count() == 3
    with pytest.raises(ValueError):
        rd.read_dependencies(spark, {})
    with pytest.raises(ValueError, match="absent"):
        rd.read_dependencies(spark, {"d": "x"}, ["absent"])


def test_read_if_exists(spark, tmp_path):
    assert rd.read_if_exists(spark, str(tmp_path / "none")) is None


def test_narrow_prunes_partitions(spark, df, tmp_path):
    write_partitioned(df, str(tmp_path / "p"), ["year"])
    out = rd.narrow(spark.read.parquet(str(tmp_path / "p")), "i > 1", {"year": "2021"})
    assert rows(out.select("i")) == [(2,), (3,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 2021)" in plan
    assert "PushedFilters: [IsNotNull(i), GreaterThan(i,1)]" in plan
    with pytest.raises(ValueError):
        rd.narrow(df, partitions={"nope": 1})


def test_small_readers(spark, df):
    assert rd.empty_frame(spark, "a int").count() == 0
    assert rows(rd.distinct_keys(df, "year")) == [(2020,), (2021,)]
    assert rows(rd.distinct_keys(df, "t")) == [("a,b",), ('say "x"',)]


# --- manifests

def test_manifest(spark, df, tmp_path):
    root = str(tmp_path)
    batch = m.Batch(root, "src", "raw", "t", "20240101", 17)
    m.write_csv_batch(df, batch)
    written = m.write_raw_manifest(spark, batch)
    assert written["event_type"] == "Raw Data Metadata" and written["batch_run_timestamp"] == 17
    assert all(p.startswith("src/raw/t/data/date_20240101/batch_run_timestamp-17/") for p in written["partitions"])
    assert all(p.endswith(".csv") for p in written["partitions"])
    assert json.load(open(batch.manifest_path)) == written
    config = {"schema": df.schema, "options": {"header": "true", "escape": '"'}}
    assert rows(m.scan_manifest(spark, batch.manifest_path, root, config)) == rows(df)
    assert rows(df) == rows(
        rd.read_input(spark, m.with_manifest({"input": config}, written, root)["input"])
    )


def test_manifest_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="names no files"):
        m.manifest_files({"partitions": []}, "x")
    with pytest.raises(ValueError, match="process"):
        m.with_manifest({}, {}, "x", "other")
    spec = {"input": {"path": "keep"}}
    assert m.with_manifest(spec, {"partitions": ["f"]}, "r", "g2i") == spec
    assert m.with_manifest(spec, {"partitions": ["f"]}, "r")["input"]["path"] == ["r/f"]
    assert spec["input"]["path"] == "keep"


def test_golden_manifest(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "src/golden/t"))
    written = m.write_golden_manifest(spark, str(tmp_path), "src/golden/t")
    assert written["dataset"] == "t" and written["partitions"]
    assert all(p.startswith("src/golden/t/") and p.endswith(".parquet") for p in written["partitions"])


def test_files(spark, tmp_path):
    assert files.list_files(spark, str(tmp_path / "none"), "") == []
    files.write_text(spark, str(tmp_path / "a/b.txt"), "ü\n2")
    assert files.read_text(spark, str(tmp_path / "a/b.txt")) == "ü\n2"
    assert files.exists(spark, str(tmp_path / "a"))
    assert files.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- stored tables

def test_versions(spark, df, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "t"), ["year"], ["i desc"])
    assert stored.version() is None and stored.read() is None and stored.delete("i = 1") is None
    assert stored.replace(df) == 1
    # the next version reads the one in force
    assert stored.replace(stored.read().filter("i < 3"), "cut") == 2
    assert stored.version() == 2 and stored.read().count() == 2
    assert stored.read(version=1).count() == 3
    assert stored.delete("t = 'a,b'") == 3
    assert rows(stored.read("i > 0", {"year": 2021}).select("i")) == [(2,)]
    assert rows(stored.history().select("version", "operation")) == [
        (1, "overwrite"), (2, "cut"), (3, "delete"),
    ]


def test_unfinished_version_is_not_seen(spark, df, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "t"))
    stored.replace(df)
    df.limit(1).write.parquet(f"{stored.data}/_version=2-00000000")  # died before its log entry
    assert stored.read().count() == 3
    assert stored.replace(df.filter("i = 2")) == 2 and stored.read().count() == 1


def test_two_writers_of_one_version(spark, df, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "t"))
    stored.replace(df)
    other = VersionedTable(spark, stored.path)
    other.version = lambda: None  # a writer that looked before the first write
    with pytest.raises(Exception, match="already exists"):
        other.replace(df.limit(1))
    assert stored.read().count() == 3


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    kind = "k int, p string, v int"
    odd = ["001", "a/b c", None, "%25:", "x=y"]
    base = spark.createDataFrame([(i, odd[i % 5], i) for i in range(20)], kind)
    stored = VersionedTable(spark, str(tmp_path / "a b" / "t"), ["p"])
    stored.replace(base)
    before = stored.snapshot()
    assert len(before.live) == 5 and rows(stored.read()) == rows(base)  # "001" stays text
    # key 0 moves from "001" to a new partition, key 3 stays, "x=y" gets a new key
    batch = spark.createDataFrame([(0, "new", 100), (3, "%25:", 103), (99, "x=y", 99)], kind)
    stored.merge(batch, ["k"], lambda old, new: scd.scd1(old, new, ["k"]))
    after = stored.snapshot()
    kept = set(before.live) & set(after.live)
    assert {d.split("/", 1)[1] for d in kept} == {"p=a%2Fb c", "p=__HIVE_DEFAULT_PARTITION__"}
    assert rows(stored.read()) == rows(scd.scd1(base, batch, ["k"]))
    assert rows(stored.read(version=1)) == rows(base)
    # a partition all of whose rows leave is gone
    everyone = base.filter("p = 'a/b c'").withColumn("p", F.lit("new"))
    stored.merge(everyone, ["k"], lambda old, new: scd.scd1(old, new, ["k"]))
    assert not any("a%2Fb" in d for d in stored.snapshot().live)
    assert stored.read().count() == 21 and stored.read("p = 'new'").count() == 5
    stored.delete("p IS NULL OR v = 103")
    assert set(rows(stored.read("p = '%25:'").select("k"))) == {(8,), (13,), (18,)}
    assert stored.read().count() == 16


def test_merge_adds_a_column(spark, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "t"), ["p"])
    stored.replace(spark.createDataFrame([(1, 1), (2, 2)], "k int, p int"))
    batch = spark.createDataFrame([(2, 2, "n")], "k int, p int, c string")
    stored.merge(batch, ["k"], lambda old, new: scd.scd1(old, new, ["k"]))
    assert rows(stored.read()) == [(1, 1, None), (2, 2, "n")]


def test_merge_of_odd_batches(spark, tmp_path):
    kind = "k int, p int, v string"
    change = lambda old, new: scd.scd1(old, new, ["k"])
    stored = VersionedTable(spark, str(tmp_path / "t"), ["p"])
    stored.merge(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], kind), ["k"], change)
    live = stored.snapshot().live
    stored.merge(spark.createDataFrame([], kind), ["k"], change)
    assert stored.version() == 2 and stored.snapshot().live == live
    with pytest.raises(ValueError, match=r"\['p'\]"):
        stored.merge(spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], change)
    # keys and partitions given as text are compared and stored in the table's types
    text = spark.createDataFrame([("2", "1", "c")], "k string, p string, v string")
    stored.merge(text, ["k"], change)
    assert rows(stored.read()) == [(1, 1, "a"), (2, 1, "c")]
    assert dict(stored.read().dtypes) == {"k": "int", "p": "int", "v": "string"}


def test_append(spark, tmp_path):
    log = VersionedTable(spark, str(tmp_path / "t"), ["p"])
    one = spark.createDataFrame([(1, "01")], "k int, p string")
    two = spark.createDataFrame([("01", 2, True)], "p string, k int, c boolean")
    log.append(one, "batch 1")
    log.append(two, "batch 2")
    log.append(two, "batch 2")  # the same batch once more
    assert rows(log.read()) == [(1, "01", None), (2, "01", True)]
    log.append(one)
    assert log.read().count() == 3 and log.version() == 4


def test_empty_table(spark, df, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "t"), ["year"])
    stored.replace(df.limit(0))
    assert stored.read().count() == 0 and stored.read().columns == df.columns
    stored.merge(df, ["i"], lambda old, new: scd.scd1(old, new, ["i"]))
    assert stored.read().count() == 3


def test_partition_values_with_most_rows_are_split(spark, tmp_path):
    hot = spark.range(0, 60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).alias("p"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        write_partitioned(hot, str(tmp_path / "t"), ["p"], ["x"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    parts = [f for f in os.listdir(tmp_path / "t" / "p=1") if f.endswith(".parquet")]
    assert len(parts) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_rows_per_file(spark, tmp_path):
    write_partitioned(spark.range(0, 95, 1, 1), str(tmp_path / "t"), max_records_per_file=10)
    names = [f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")]
    assert len(names) == 10
    assert max(spark.read.parquet(str(tmp_path / "t" / f)).count() for f in names) == 10


def test_save_dispatch(spark, tmp_path):
    one = spark.createDataFrame([("k1", "x"), ("k2", None)], "k string, a string")
    two = spark.createDataFrame([("k1", "y"), ("k3", "z")], "k string, a string")
    base = {"primary_key": ["k"], "tracking_columns": ["a"]}
    results = {}
    for kind in ("scd1", "SCD2", "SCD3", "SCD4"):
        output = {**base, "path": str(tmp_path / kind), "store_type": kind}
        output["history_path"] = str(tmp_path / f"{kind}-history")
        for batch, day in ((one, "2024-01-01"), (two, "2024-01-02")):
            results[kind] = save(batch, output, as_of=f"{day} 00:00:00").read()
    assert os.listdir(tmp_path / "SCD2" / "batch") == []
    assert rows(results["scd1"]) == rows(results["SCD4"]) == [
        ("k1", "y"), ("k2", None), ("k3", "z"),
    ]
    assert results["SCD2"].count() == 4 and results["SCD2"].filter("is_current").count() == 3
    assert ("k1", "y", "x") in rows(results["SCD3"])
    assert AppendTable(spark, str(tmp_path / "SCD4-history")).read().count() == 4
    with pytest.raises(ValueError, match="unsupported"):
        save(one, {**base, "path": "x", "store_type": "SCD9"})
    with pytest.raises(ValueError, match="history_path"):
        save(one, {**base, "path": "x", "store_type": "SCD4"})
    default = save(one, {"path": str(tmp_path / "d"), "primary_key": ["k"]})
    assert default.version() == 1


def test_merge_in_place_needs_a_format_with_merge(spark, df):
    df.write.saveAsTable("plain_parquet")
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge_in_place(df, "plain_parquet", ["i"])


# --- catalog

def test_catalog(spark, df, tmp_path):
    path = str(tmp_path / "plain")
    write_partitioned(df, path, ["year"])
    make = lambda: catalog.create_or_repair(
        spark, "lake", "plain", df.schema, path, ["year"]
    )
    assert make() == "created"
    assert rows(spark.table("lake.plain").select(*df.columns)) == rows(df)
    assert spark.table("lake.plain").columns[-1] == "year"
    # a partition that appears later is taken in
    df.withColumn("year", F.lit(1999)).write.mode("append").partitionBy("year").parquet(path)
    assert make() == "repaired" and spark.table("lake.plain").count() == 6


def test_catalog_follows_a_stored_table(spark, tmp_path):
    kind = "k int, p string"
    base = spark.createDataFrame([(1, "it's"), (2, None), (3, "a/b")], kind)
    stored = VersionedTable(spark, str(tmp_path / "t"), ["p"])
    stored.replace(base)

    def make():
        location, folders = stored.place()
        return catalog.create_or_repair(
            spark, "lake", "items", base.schema, location, ["p"], folders
        )

    assert make() == "created" and rows(spark.table("lake.items")) == rows(base)
    batch = spark.createDataFrame([(1, "z")], kind)
    stored.merge(batch, ["k"], lambda old, new: scd.scd1(old, new, ["k"]))
    assert make() == "repaired"
    assert rows(spark.table("lake.items")) == [(1, "z"), (2, None), (3, "a/b")]


def test_register_outputs(spark, df, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "things/current"))
    stored.replace(df)
    output = {
        "dataframe": "d",
        "path": stored.path,
        "store_type": "SCD4",
        "schema": [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields],
    }
    assert catalog.register_outputs(spark, "lake", [output]) == {"things": "created"}
    assert spark.table("lake.things").count() == 3
    stored.replace(df.limit(1))
    assert catalog.register_outputs(spark, "lake", [output]) == {"things": "repaired"}
    assert spark.table("lake.things").count() == 1
    with pytest.raises(ValueError, match="schema"):
        catalog.register_outputs(spark, "lake", [{"dataframe": "d", "path": "x"}])
    with pytest.raises(ValueError, match="nothing is stored"):
        catalog.register_outputs(spark, "lake", [{**output, "path": str(tmp_path / "no")}])
    assert catalog.table_name("s3a://b/x/", "SCD1") == "x"


def test_catalog_of_appended_tables(spark, df, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "v"))
    stored.append(df)
    stored.append(df)
    with pytest.raises(ValueError, match="several directories"):
        stored.place()
    history = AppendTable(spark, str(tmp_path / "h"), ["year"])
    history.append(df, "1")
    history.append(df.limit(1), "2")
    history.append(df.withColumn("more", F.lit(1)), "2")  # again, with a further column
    assert history.read().count() == 2 * df.count()
    schema, parts = history.catalog_entry()
    assert catalog.create_or_repair(spark, "lake", "kept", schema, history.path, parts) == "created"
    assert rows(spark.table("lake.kept").select("i", "more")) == rows(history.read().select("i", "more"))


def test_two_writers_and_half_a_text(spark, tmp_path):
    path = str(tmp_path / "log/1.json")
    files.write_text(spark, path, "{}", replace=False)
    with pytest.raises(Exception):
        files.write_text(spark, path, "[]", replace=False)
    assert files.read_text(spark, path) == "{}"
    files.write_text(spark, path, "[]")
    assert files.read_text(spark, path) == "[]"
    assert files.list_files(spark, str(tmp_path / "log"), "") == [f for f in files.list_files(spark, str(tmp_path / "log"), "1.json")]


# --- ledger and events

def test_ledger(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    run = book.start("d1")
    assert ledger.status_of(book.rows(), "d1") == "RUNNING"
    book.finish(run, "d1", "SUCCESS")
    book.note("task_event", "e1", "DONE", details={"a": 1})
    assert ledger.status_of(book.rows(), "d1") == "SUCCESS"
    assert ledger.status_of(book.rows(), "other") is None
    book.finish(book.start("d2"), "d2", "FAILED")
    tables = spark.createDataFrame(
        [("a", "d1"), ("b", "d1"), ("b", "d2"), ("c", "none")], "target string, dataset string"
    )
    assert rows(ledger.dependencies_ready(book.rows(), tables)) == [
        ("a", True), ("b", False), ("c", False),
    ]
    with pytest.raises(ValueError):
        book.note("nothing", "x", "DONE")


def test_latest_status_settles_ties_by_id(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("d", "2", "SUCCESS", at), ("d", "1", "RUNNING", at), ("e", "3", "FAILED", at)],
        "dataset string, id string, status string, at timestamp",
    )
    assert rows(ledger.latest_status(df, ["dataset"])) == [("d", "SUCCESS"), ("e", "FAILED")]


def test_finish_event(spark, tmp_path):
    ledger.send_finish_event(spark, str(tmp_path), {"finish_event": "e", "dataset": "d"})
    got = spark.read.schema(ledger.EVENT_SCHEMA).json(str(tmp_path)).first()
    assert (got["finish_event"], got["dataset"], got["status"]) == ("e", "d", "COMPLETED")


def test_missing_paths_raise(spark):
    with pytest.raises(AnalysisException):
        rd.read_input(spark, {"format": "parquet", "path": "/no/such/place"})


def test_an_input_is_never_put_into_fewer_tasks(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(600).repartition(6).write.parquet(path)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(256 << 20))  # a task for each file
    try:
        few, more = (rd.read_input(spark, {"format": "parquet", "path": path, "repartition": n}) for n in (2, 9))
        assert (few.rdd.getNumPartitions(), more.rdd.getNumPartitions()) == (6, 9)
        assert few.count() == more.count() == 600
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)

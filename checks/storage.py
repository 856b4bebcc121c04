"""Files, manifests, stored tables and the catalog.

Each query writes the given tables below the shared work folder and reads them back.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import functions as F

from checks import insights, normal, pipelines
from checks.insights import figures
from checks.normal import thread_responses
from checks.pipelines import raw_trending
from checks.tables import table
from millrace.functions import clean_text
from millrace.operators.normalise import split_values
from millrace.operators.quality import RuleBook
from millrace.plans.golden import GOLDEN
from millrace.plans import insights as insight_jobs
from millrace.plans.insights import publish
from millrace.plans.raw import build_raw
from millrace.plans.runner import execute
from millrace.sources import manifest as m
from millrace.sources.catalog import create_or_repair, register_outputs
from millrace.sources.datasource import read_responses
from millrace.sources.files import work_folder, write_text
from millrace.sources.ledger import Ledger, run_messages
from millrace.sources.readers import distinct_keys, empty_frame, read_dependencies, read_if_exists, read_input
from millrace.sources.tables import AppendTable, VersionedTable, save, stored_table, write_partitioned
from millrace.streaming.notifications import CREATED, read_events
from millrace.streaming.readiness import load_mapping, mapping_rows, ready_targets
from millrace.streaming.runs import Runs


def _part_batch(spark, d):
    root = work_folder(spark, "raw")
    batch = m.Batch(root, "shop", "raw", "part", "20240102", 1704153600)
    m.write_csv_batch(table(spark, d, "part"), batch)
    m.write_raw_manifest(spark, batch)
    return batch


PART = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double"
)


def manifest_scan(spark, d):
    """S1 S2 K1 K15"""
    batch = _part_batch(spark, d)
    config = {"format": "csv", "schema": PART, "options": {"header": "true", "escape": '"'}}
    return m.scan_manifest(spark, batch.manifest_path, batch.root, config)


def manifest_spec(spark, d):
    """S3 S4"""
    batch = _part_batch(spark, d)
    spec = {
        "input": {
            "schema": PART,
            "options": {"header": "true"},
            "select_columns": ["p_partkey", "p_type"],
        }
    }
    merged = m.with_manifest(spec, m.read_manifest(spark, batch.manifest_path), batch.root)
    return read_input(spark, merged["input"])


def raw_build(spark, d):
    """Dumps on disk, flattened to a raw batch, scanned by its manifest"""
    root = work_folder(spark, "raw")
    dumps = f"{root}/dumps"
    thread_responses(spark, d).write.json(dumps)
    batch = m.Batch(root, "site", "raw", "comment_threads", "20240102", 1)
    manifest = build_raw(spark, dumps, batch)
    spec = m.with_manifest(GOLDEN["comment_threads"](f"{root}/golden"), manifest, root)
    return read_input(spark, spec["input"])


def _trending_run(spark, d, root, batch_id):
    """The spec of the trending videos over a raw batch, and an empty ledger."""
    batch = m.Batch(root, "site", "raw", "trending_videos", "20240102", 1)
    m.write_csv_batch(raw_trending(spark, d), batch)
    manifest = m.write_raw_manifest(spark, batch)
    spec = m.with_manifest(GOLDEN["trending_videos"](f"{root}/golden"), manifest, root)
    return {**spec, "batch_id": batch_id}, Ledger(spark, f"{root}/ledger")


def executed_spec(spark, d):
    """A raw batch through the whole of its spec, read back from the golden table"""
    root = work_folder(spark, "lake")
    execute(spark, _trending_run(spark, d, root, None)[0])
    rows = VersionedTable(spark, f"{root}/golden/trending_videos/current").read()
    return rows.withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))


def checked_insight(spark, d):
    """I4 Q4 Q5 Q7 Q8: an insight published under a rule file; what the rules on it and on its joins found"""
    root = work_folder(spark, "lake")
    channels = table(spark, d, "supplier").select(F.col("s_suppkey").alias("channel_id"), F.col("s_name").alias("channel_name"))
    VersionedTable(spark, f"{root}/golden/channels/current").replace(channels.filter("channel_id % 3 > 0"))
    VersionedTable(spark, f"{root}/golden/trending_videos/current").replace(figures(spark, d).filter("channel_id % 5 > 0"))
    rules = [
        {"column": "channel_id", "type": "numeric", "null_allowed": False, "unique": True, "min_value": 3},
        {"column": "total_views", "type": "numeric", "max_value": 100_000},
    ]
    write_text(spark, f"{root}/rules.json", json.dumps({"channel_growth_metrics": {"rules": rules}}))
    publish(
        spark, "channel_growth_metrics", f"{root}/golden", f"{root}/insights/growth",
        book=RuleBook.from_file(spark, f"{root}/rules.json"), report=f"{root}/report",
    )
    on_rows = spark.read.parquet(f"{root}/report/rules").select(F.concat_ws(".", "column", "check").alias("check"), "violations", "row_count")
    on_joins = spark.read.parquet(f"{root}/report/joins")
    name = F.concat_ws("-", "source_table", "target_table").alias("check")
    return on_rows.unionAll(on_joins.select(name, F.col("orphans").alias("violations"), F.col("source_keys").alias("row_count")))


def responses_source(spark, d):
    """Dumps of thread responses read by format"""
    path = work_folder(spark, "dumps")
    thread_responses(spark, d).write.json(path)
    return read_responses(spark, path, "threads", ["role"]).drop("extra")


def golden_manifest(spark, d):
    """A golden table read by the files that its manifest names"""
    root = work_folder(spark, "lake")
    write_partitioned(table(spark, d, "orders"), f"{root}/golden/orders", ["o_orderpriority"])
    m.write_golden_manifest(spark, root, "golden/orders")
    files = m.manifest_files(m.read_manifest(spark, f"{root}/golden/orders/control.json"), root)
    schema = table(spark, d, "orders").schema
    rows = spark.read.schema(schema).option("basePath", f"{root}/golden/orders").parquet(*files)
    return rows.select(*schema.fieldNames())


def spread_input(spark, d):
    """Few files spread over more tasks, and an input that is not there"""
    path = work_folder(spark, "raw")
    items = table(spark, d, "lineitem")
    items.coalesce(-(-items.rdd.getNumPartitions() // 4)).write.parquet(path)
    rows = read_input(spark, {"format": "parquet", "path": path, "repartition": 8})
    absent = read_if_exists(spark, f"{path}-absent")
    return rows.unionByName(empty_frame(spark, rows.schema) if absent is None else absent)


def notified_runs(spark, d):
    """S11 ST2 R0 K17: raw batches announced as messages, run by a stream; the second trigger announces
    one of them again and another half of the rows, the third comes from a new checkpoint"""
    root = work_folder(spark, "lake")
    raw = raw_trending(spark, d).withColumn("half", F.pmod(F.xxhash64("video_id"), F.lit(2)))
    keys = []
    for half in (0, 1):
        batch = m.Batch(root, "site", "raw", "trending_videos", f"2024010{half + 1}", 1)
        m.write_csv_batch(raw.filter(F.col("half") == half).drop("half"), batch)
        m.write_raw_manifest(spark, batch)
        keys.append(batch.manifest_path.removeprefix(root).lstrip("/"))
    runs = Runs(spark, root, f"{root}/golden", f"{root}/marks", ledger=Ledger(spark, f"{root}/ledger"))
    for number, (told, checkpoint) in enumerate((([keys[0]], "a"), (keys, "a"), ([keys[1]], "b"))):
        object_ = F.struct(F.struct(F.struct(F.lit("lake").alias("name")).alias("bucket"), F.struct(F.col("key")).alias("object")).alias("s3"))
        message = F.struct(F.lit(CREATED).alias("EventName"), F.array(object_).alias("Records"))
        told = spark.createDataFrame([(k,) for k in told], "key string")
        told.select(F.to_json(message).alias("value")).write.text(f"{root}/inbox/{number}")
        runs.follow(read_events(spark, f"{root}/inbox/*"), f"{root}/checkpoint-{checkpoint}")
    current = stored_table(spark, f"{root}/golden/trending_videos/current").read()
    history = AppendTable(spark, f"{root}/golden/trending_videos/history").read()
    tags = stored_table(spark, f"{root}/golden/tags").read()
    tables = {"current": current, "history": history, "tags": tags}
    counts = [f.agg(F.lit(n).alias("table"), F.count("*").alias("rows"), F.sum("views" if n != "tags" else F.lit(None).cast("long")).alias("views")) for n, f in tables.items()]
    return reduce(lambda a, b: a.unionAll(b), counts)


def rejected_lines(spark, d):
    """Parts as lines of CSV, some of them broken; what is read and what is rejected"""
    root = work_folder(spark, "raw")
    line = F.concat_ws(
        ",", "p_partkey", F.concat(F.lit('"'), "p_name", F.lit('"')),
        F.when(F.col("p_size") % 10 == 3, "unknown").otherwise(F.col("p_size").cast("string")),
        F.when(F.col("p_size") % 10 == 7, F.lit("too,many")).otherwise(F.lit("x")),
    )
    line = F.when(F.col("p_size") % 10 == 9, F.col("p_partkey").cast("string")).otherwise(line)
    table(spark, d, "part").select(line.alias("value")).write.text(f"{root}/lines")
    spec = {
        "batch_id": "1",
        "input": {"path": f"{root}/lines", "schema": "p_partkey bigint, p_name string, p_size int, mark string",
                  "options": {"escape": '"'}, "rejects": f"{root}/rejects"},
        "output": [{"dataframe": "input_df", "path": f"{root}/parts", "primary_key": ["p_partkey"], "buckets": 4}],
    }
    execute(spark, spec)
    good = stored_table(spark, f"{root}/parts").read().withColumn("line", F.lit(None).cast("string"))
    bad = spark.read.parquet(f"{root}/rejects").select("line")
    return good.unionByName(bad, allowMissingColumns=True)


def bucketed_merges(spark, d):
    """Orders by bucket of their key, three batches of which each has wider numbers"""
    path = f"{work_folder(spark, 'golden')}/orders"
    output = {"path": path, "store_type": "SCD3", "primary_key": ["o_orderkey"], "tracking_columns": ["cents"], "buckets": 16}
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("cents"))
    small = orders.withColumns({"o_orderkey": F.col("o_orderkey").cast("int"), "cents": F.col("cents").cast("int")})
    save(small.filter("o_orderkey % 7 <> 0"), output)
    save(orders.filter("o_orderkey % 7 < 2").withColumn("cents", F.col("cents") + F.lit(10_000_000_000)), output)
    wide = orders.filter("o_orderkey % 11 = 0").withColumn("cents", (F.col("cents") * F.lit(0.25)).cast("decimal(12,2)"))
    stored = save(wide, output)
    stored.delete("o_orderkey % 13 = 0")
    return stored.read().withColumns({c: F.col(c).cast("double") for c in ("cents", "prev_cents")})


def published_insight(spark, d):
    """Golden tables on disk, the job's result read through the catalog"""
    root = work_folder(spark, "lake")
    part = table(spark, d, "part").select(F.col("p_partkey").alias("video_id"), "p_name")
    _, tags = split_values(part, "p_name", ["video_id"], ["video_id"], " ")
    VersionedTable(spark, f"{root}/golden/tags").replace(tags)
    VersionedTable(spark, f"{root}/golden/trending_videos/current", ["category_id"]).replace(
        figures(spark, d)
    )
    stored = publish(
        spark, "tag_performance_metrics", f"{root}/golden", f"{root}/insights/tags"
    )
    create_or_repair(spark, "default", "checked_tags", stored.snapshot().schema, stored.place()[0])
    return spark.table("default.checked_tags").withColumn(
        "avg_engagement_rate", F.round("avg_engagement_rate", 6)
    )


def sliced_write(spark, d):
    """Files of at most 5,000 rows"""
    stored = VersionedTable(
        spark, f"{work_folder(spark, 'golden')}/lineitem", max_records_per_file=5000
    )
    stored.replace(table(spark, d, "lineitem"))
    return stored.read()


def fetch_keys(spark, d):
    """S12"""
    return distinct_keys(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


def csv_roundtrip(spark, d):
    """K1 F1: whole cleaned texts with quotes, commas and letters of any kind"""
    batch = m.Batch(work_folder(spark, "raw"), "shop", "raw", "documents", "20240102", 1)
    docs = table(spark, d, "documents").select("doc_id", clean_text("text").alias("text"))
    m.write_csv_batch(docs, batch)
    return read_input(
        spark,
        {
            "path": batch.data_path,
            "schema": "doc_id bigint, text string",
            "options": {"header": "true", "escape": '"'},
        },
    )


def partition_scan(spark, d):
    """S6 K2 K9"""
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    stored = VersionedTable(
        spark, f"{work_folder(spark, 'golden')}/orders", ["year"], ["o_orderkey"]
    )
    stored.replace(orders)
    return stored.read("o_totalprice > 1000", {"year": "1998"})


def _stored_customers(spark, d):
    """Two batches of an SCD4 table: all customers, then those in debt with a new segment
    and a further column."""
    root = work_folder(spark, "golden")
    customers = table(spark, d, "customer")
    output = {
        "path": f"{root}/customer/current",
        "history_path": f"{root}/customer/history",
        "store_type": "SCD4",
        "primary_key": ["c_custkey"],
        "partition_by": ["c_mktsegment"],
    }
    save(customers, output, as_of="2024-01-01 00:00:00")
    poor = customers.filter("c_acctbal < 1000").withColumns(
        {"c_mktsegment": F.lit("DEBT"), "checked": F.lit(True)}
    )
    current = save(poor, output, as_of="2024-01-02 00:00:00")
    return current, AppendTable(spark, output["history_path"], output["partition_by"])


def stored_current(spark, d):
    """K3 K6 K7 K8 K19"""
    return _stored_customers(spark, d)[0].read()


def stored_history(spark, d):
    """K6 K8"""
    rows = _stored_customers(spark, d)[1].read()
    return rows.withColumn("record_timestamp", F.col("record_timestamp").cast("timestamp_ntz"))


def stored_delete(spark, d):
    """The second version of a stored table"""
    stored = VersionedTable(spark, f"{work_folder(spark, 'golden')}/orders", ["o_orderpriority"])
    stored.replace(table(spark, d, "orders"))
    stored.delete("o_orderstatus = 'F'")
    return stored.read()


def stored_versions(spark, d):
    """K4 K9: SCD2 on disk, by year; orders of 2000 come again with a new status"""
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    output = {
        "path": f"{work_folder(spark, 'golden')}/orders",
        "store_type": "SCD2",
        "primary_key": ["o_orderkey"],
        "tracking_columns": ["o_orderstatus"],
        "partition_by": ["year"],
    }
    save(orders, output, as_of="2024-01-01 00:00:00")
    changed = orders.filter("year = 2000").withColumn("o_orderstatus", F.lit("F"))
    rows = save(changed, output, as_of="2024-01-02 00:00:00").read()
    return rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("start_date", "end_date")}
    )


def dependency_scan(spark, d):
    """Named tables, joined"""
    frames = read_dependencies(
        spark, {n: f"{d}/{n}.parquet" for n in ("orders", "customer")}, ["orders", "customer"]
    )
    return frames["orders"].join(
        frames["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey"
    )


def catalog_table(spark, d):
    """An external partitioned table in the catalog"""
    orders = table(spark, d, "orders")
    parts = ["o_orderstatus"]
    stored = VersionedTable(spark, f"{work_folder(spark, 'golden')}/orders", parts)
    stored.replace(orders)
    location, folders = stored.place()
    create_or_repair(spark, "default", "checked_orders", orders.schema, location, parts, folders)
    return spark.table("default.checked_orders").select(*orders.columns)


def catalog_history(spark, d):
    """Two batches of a history, all rows through the catalog"""
    history = _stored_customers(spark, d)[1]
    schema, parts = history.catalog_entry()
    create_or_repair(spark, "default", "checked_history", schema, history.path, parts)
    rows = spark.table("default.checked_history").select(*history.schema().fieldNames())
    return rows.withColumn("record_timestamp", F.col("record_timestamp").cast("timestamp_ntz"))


def registered_outputs(spark, d):
    """The outputs of a run and their history, counted through the catalog"""
    root = work_folder(spark, "lake")
    spec, _ = _trending_run(spark, d, root, "r1")
    done = execute(spark, spec).outputs
    names = register_outputs(spark, "checked_golden", done)
    counts = [
        spark.table(f"checked_golden.{n}").agg(F.lit(n).alias("table"), F.count("*").alias("rows"))
        for n in sorted(names)
    ]
    return reduce(lambda a, b: a.unionAll(b), counts)


def run_readiness(spark, d):
    """R0 K17 K18 ST3 ST7: a run writes its ledger, and the ledger says which insights can start"""
    root = work_folder(spark, "lake")
    spec, book = _trending_run(spark, d, root, "r1")
    execute(spark, spec, book)
    mapping = mapping_rows(spark, load_mapping(insight_jobs.TRIGGERS))
    return ready_targets(run_messages(book.rows()), mapping)


QUERIES = {
    f.__name__: f
    for f in (
        manifest_scan,
        manifest_spec,
        raw_build,
        executed_spec,
        catalog_history,
        registered_outputs,
        run_readiness,
        published_insight,
        checked_insight,
        responses_source,
        golden_manifest,
        spread_input,
        notified_runs,
        rejected_lines,
        bucketed_merges,
        sliced_write,
        fetch_keys,
        csv_roundtrip,
        partition_scan,
        stored_current,
        stored_history,
        stored_delete,
        stored_versions,
        dependency_scan,
        catalog_table,
    )
}

_WS = r"[\x09-\x0d\x1c-\x1f\x{85}\p{Z}]"

SQL = {
    "raw_build": """
        SELECT comment_thread_id, video_id, author_name, text,
               CAST(like_count AS VARCHAR) AS like_count, published_at,
               CAST(total_reply_count AS VARCHAR) AS total_reply_count
        FROM (""" + normal.SQL["flatten_nested"] + ")",
    "executed_spec": pipelines.SQL["r6_trending"],
    "published_insight": insights.SQL["i8_tag_performance"],
    "checked_insight": f"""
        WITH g AS (SELECT * FROM ({insights.SQL["i4_channel_growth"]}) WHERE channel_id % 5 > 0 AND channel_id % 3 > 0),
        t AS (SELECT DISTINCT l_suppkey AS k FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_suppkey % 5 > 0)
        SELECT 'channel_id.null' AS "check", CAST(0 AS BIGINT) AS violations, count(*) AS row_count FROM g
        UNION ALL SELECT 'channel_id.unique', CAST(0 AS BIGINT), count(*) FROM g
        UNION ALL SELECT 'channel_id.min_value', count(*) FILTER (WHERE channel_id < 3), count(*) FROM g
        UNION ALL SELECT 'total_views.max_value', count(*) FILTER (WHERE total_views > 100000), count(*) FROM g
        UNION ALL SELECT 'channels-trending_videos', count(*) FILTER (WHERE s_suppkey NOT IN (SELECT k FROM t)), count(*)
        FROM supplier WHERE s_suppkey % 3 > 0""",
    "responses_source": normal.SQL["flatten_nested"],
    "golden_manifest": "SELECT * FROM orders",
    "spread_input": "SELECT * FROM lineitem",
    "notified_runs": f"""
        WITH r AS ({pipelines.SQL["r6_trending"]})
        SELECT 'current' AS "table", count(*) AS rows, CAST(sum(views) AS BIGINT) AS views FROM r
        UNION ALL SELECT 'history', count(*), CAST(sum(views) AS BIGINT) FROM r
        UNION ALL SELECT 'tags', count(DISTINCT (video_id, id)), CAST(NULL AS BIGINT) FROM ({pipelines.SQL["r6_tags"]})""",
    "rejected_lines": """
        SELECT CASE WHEN p_size % 10 NOT IN (3, 7, 9) THEN p_partkey END AS p_partkey,
               CASE WHEN p_size % 10 NOT IN (3, 7, 9) THEN p_name END AS p_name,
               CASE WHEN p_size % 10 NOT IN (3, 7, 9) THEN CAST(p_size AS INTEGER) END AS p_size,
               CASE WHEN p_size % 10 NOT IN (3, 7, 9) THEN 'x' END AS mark,
               CASE WHEN p_size % 10 = 9 THEN CAST(p_partkey AS VARCHAR)
                    WHEN p_size % 10 = 3 THEN p_partkey || ',"' || p_name || '",unknown,x'
                    WHEN p_size % 10 = 7 THEN p_partkey || ',"' || p_name || '",' || p_size || ',too,many' END AS line
        FROM part""",
    "bucketed_merges": """
        WITH one AS (
            SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS DOUBLE) AS cents, CAST(NULL AS DOUBLE) AS prev
            FROM orders WHERE o_orderkey % 7 <> 0
        ), two AS (
            SELECT o.o_orderkey, o.o_orderstatus,
                   CASE WHEN o.o_orderkey % 7 < 2 THEN CAST(o.o_custkey + 10000000000 AS DOUBLE) ELSE one.cents END AS cents,
                   CASE WHEN o.o_orderkey % 7 < 2 THEN one.cents ELSE one.prev END AS prev
            FROM orders o LEFT JOIN one ON one.o_orderkey = o.o_orderkey
        ), three AS (
            SELECT t.o_orderkey, t.o_orderstatus,
                   CASE WHEN t.o_orderkey % 11 = 0 THEN CAST(CAST(o.o_custkey * 0.25 AS DECIMAL(12, 2)) AS DOUBLE) ELSE t.cents END AS cents,
                   CASE WHEN t.o_orderkey % 11 = 0 THEN t.cents ELSE t.prev END AS prev
            FROM two t JOIN orders o ON o.o_orderkey = t.o_orderkey
        )
        SELECT o_orderkey, o_orderstatus, cents, prev AS prev_cents FROM three WHERE o_orderkey % 13 <> 0""",
    "sliced_write": "SELECT * FROM lineitem",
    "fetch_keys": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "manifest_scan": "SELECT * FROM part",
    "manifest_spec": "SELECT p_partkey, p_type FROM part",
    "csv_roundtrip": f"""
        SELECT doc_id, regexp_replace(translate(text, chr(10) || chr(13), '  '),
                 '^{_WS}+|{_WS}+$', '', 'g') AS text FROM documents""",
    "partition_scan": """
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
        WHERE year(o_orderdate) = 1998 AND o_totalprice > 1000""",
    "stored_current": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal,
               CASE WHEN c_acctbal < 1000 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment,
               CASE WHEN c_acctbal < 1000 THEN true END AS checked FROM customer""",
    "stored_history": """
        SELECT *, TIMESTAMP '2024-01-01' AS record_timestamp, CAST(NULL AS BOOLEAN) AS checked
        FROM customer
        UNION ALL
        SELECT * REPLACE ('DEBT' AS c_mktsegment), TIMESTAMP '2024-01-02', true
        FROM customer WHERE c_acctbal < 1000""",
    "stored_delete": "SELECT * FROM orders WHERE o_orderstatus <> 'F'",
    "stored_versions": """
        WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
        SELECT *, TIMESTAMP '2024-01-01' AS start_date,
               CASE WHEN year = 2000 AND o_orderstatus <> 'F' THEN TIMESTAMP '2024-01-02' END
                 AS end_date, NOT (year = 2000 AND o_orderstatus <> 'F') AS is_current FROM o
        UNION ALL
        SELECT * REPLACE ('F' AS o_orderstatus), TIMESTAMP '2024-01-02', NULL, true FROM o
        WHERE year = 2000 AND o_orderstatus <> 'F'""",
    "dependency_scan": """
        SELECT orders.*, c_name FROM orders JOIN customer ON o_custkey = c_custkey""",
    "catalog_table": "SELECT * FROM orders",
    "run_readiness": "SELECT 'r1' AS batch_id, 'tag_performance_metrics' AS target",
}
SQL["catalog_history"] = SQL["stored_history"]
SQL["registered_outputs"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(DISTINCT {key}) AS rows FROM ({pipelines.SQL[query]})"
    for name, query, key in (
        ("trending_videos", "r6_trending", "video_id"),
        ("trending_videos_history", "r6_trending", "video_id"),
        ("tags", "r6_tags", "(video_id, id)"),
        ("channels_basic_information", "r6_channel_names", "channel_id"),
    )
)

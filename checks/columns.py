"""Columns, rows, joins, groups and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import table
from millrace.functions import clean_id, clean_number, clean_text, duration_seconds
from millrace.functions import last_segment, parent_path, ratio, years_between
from millrace.operators import columns as c
from millrace.operators import joins as j
from millrace.operators import rows as r


def select_rename_cast(spark, d):
    """P1 P2 P3"""
    events = table(spark, d, "events").withColumn(
        "k",
        F.when(F.col("event_type") == "error", "N/A").otherwise(
            F.regexp_extract("props", "[0-9]+", 0)
        ),
    )
    df = c.project(events, ["event_id", "user_id", "event_type", "k"])
    df = c.rename(df, {"event_type": "kind", "k": "level", "absent": "nothing"})
    return c.convert(df, {"level": "int", "event_id": "string"})


def filter_add_drop(spark, d):
    """P4 P5 P6 F6 F8 F12"""
    df = r.where(table(spark, d, "lineitem"), "l_returnflag IS NOT NULL AND l_discount < 0.05")
    df = c.derive(
        df,
        {
            "year": "year(l_shipdate)",
            "month": "month(l_shipdate)",
            "unit_price": "try_divide(l_extendedprice, l_quantity)",
            "per_discount": "try_divide(unit_price, l_discount)",
        },
    )
    return c.discard(df, ["l_tax", "l_linestatus", "l_shipdate", "absent"])


def sort_multi(spark, d):
    """O1"""
    return r.sort(table(spark, d, "customer"), ["c_mktsegment", "c_acctbal"], ascending=False)


def dedup_ordered(spark, d):
    """A7"""
    return r.deduplicate(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate desc"]
    )


def dedup_rows(spark, d):
    """A7 without key"""
    return r.deduplicate(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_tax"))


def group_aggregate(spark, d):
    """A1-A5 A9 A10"""
    return r.aggregate(
        table(spark, d, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "sum_qty": "sum(CAST(l_quantity AS BIGINT))",
            "sum_price": "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)",
            "avg_qty": "round(avg(l_quantity), 6)",
            "n": "count(l_orderkey)",
            "n_orders": "count(DISTINCT l_orderkey)",
            "n_big": "count_if(l_quantity > 25)",
        },
    )


def _orders(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", "o_orderstatus", "o_orderdate"
    )


def _documents(spark, d):
    """Some of them have labels."""
    return table(spark, d, "documents").select("doc_id", "lang", "source")


def _labels(spark, d):
    return table(spark, d, "labels").select("doc_id", "quality", "toxic")


def _customers(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey"
    )


def join_using_inner(spark, d):
    """J1 J3"""
    return j.join_using(_customers(spark, d), _orders(spark, d), ["custkey"])


def join_left(spark, d):
    """J4"""
    return j.join_using(_documents(spark, d), _labels(spark, d), ["doc_id"], "left")


def join_left_fanout(spark, d):
    """J4 with a right side whose keys may be hot"""
    return j.left_join_fanout(_documents(spark, d), _labels(spark, d), ["doc_id"])


def join_semi(spark, d):
    """J1 semi"""
    return j.join_using(
        _documents(spark, d), _labels(spark, d), ["doc_id"], "left_semi"
    )


def join_anti(spark, d):
    """J7"""
    return j.orphans(_documents(spark, d), _labels(spark, d), ["doc_id"])


def join_lookup(spark, d):
    """J2 P9"""
    return j.lookup_join(
        table(spark, d, "supplier"),
        table(spark, d, "nation"),
        {"s_nationkey": "n_nationkey"},
    )


def union_batches(spark, d):
    """U1 P7"""
    customers = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return r.union_all([c.stamp(customers, {"kind": "c"}), c.stamp(suppliers, {"kind": "s"})])


def top_rows(spark, d):
    """O3: the largest orders, a report of fixed length"""
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return r.preview(df, ["o_totalprice desc"], 30)


def clean_strings(spark, d):
    """F1 F3"""
    return table(spark, d, "documents").select(
        "doc_id",
        clean_text("text").alias("text"),
        clean_text("text", escape_quotes=True).alias("escaped"),
        clean_text(F.nullif("lang", F.lit("en"))).alias("lang"),
        clean_id(F.concat(F.lit("\t "), "source", F.lit(" \n"))).alias("source"),
    )


def clean_numbers(spark, d):
    """F2"""
    k = F.regexp_extract("props", "[0-9]+", 0)
    given = (
        F.when(F.col("event_type") == "click", F.concat(F.lit(" "), k, F.lit("\t")))
        .when(F.col("event_type") == "view", F.concat(F.lit("-"), k))
        .when(F.col("event_type") == "error", F.concat(k, F.lit(".5")))
        .when(F.col("event_type") == "signup", F.lit("N/A"))
    )
    return table(spark, d, "events").select("event_id", clean_number(given).alias("number"))


def iso_duration(spark, d):
    """F4"""
    k = F.regexp_extract("props", "[0-9]+", 0)
    kind = F.col("event_type")
    given = (
        F.when(kind == "click", F.concat(F.lit("PT1H2M"), k, F.lit("S")))
        .when(kind == "view", F.concat(F.lit("P1DT"), k, F.lit("H")))
        .when(kind == "error", F.lit("PT"))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    )
    return table(spark, d, "events").select(
        "event_id", kind, duration_seconds(given).alias("seconds")
    )


def derived_measures(spark, d):
    """F6 F7 F8 F10"""
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        years_between("o_orderdate", "2024-06-01 00:00:00").alias("age"),
        ratio("o_totalprice", F.month("o_orderdate") - 1, 100).alias("share"),
        F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("none")).alias("priority"),
    )


def path_parts(spark, d):
    """F13 F15"""
    path = F.regexp_replace("url", r"[?#].*$", "")
    return table(spark, d, "pages").select(
        "page_id",
        last_segment(path).alias("last"),
        parent_path(path).alias("parent"),
        F.col("url").contains("spam").alias("spam"),
        path.endswith(".html").alias("html"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        select_rename_cast,
        filter_add_drop,
        sort_multi,
        dedup_ordered,
        dedup_rows,
        group_aggregate,
        join_using_inner,
        join_left,
        join_left_fanout,
        join_semi,
        join_anti,
        join_lookup,
        union_batches,
        top_rows,
        clean_strings,
        clean_numbers,
        iso_duration,
        derived_measures,
        path_parts,
    )
}

_K = "regexp_extract(props, '[0-9]+', 0)"
# white space of any kind, as a DuckDB regular expression
_WS = r"[\x09-\x0d\x1c-\x1f\x{85}\p{Z}]"
_LEFT = """
SELECT d.doc_id, lang, source, quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def _clean(x: str) -> str:
    return (
        f"regexp_replace(translate({x}, chr(10) || chr(13), '  '), '^{_WS}+|{_WS}+$', '', 'g')"
    )


SQL = {
    "select_rename_cast": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type AS kind,
               CASE WHEN event_type <> 'error' THEN TRY_CAST({_K} AS INTEGER) END AS level
        FROM events""",
    "filter_add_drop": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(month(l_shipdate) AS INTEGER) AS month,
               l_extendedprice / nullif(l_quantity, 0) AS unit_price,
               l_extendedprice / nullif(l_quantity, 0) / nullif(l_discount, 0) AS per_discount
        FROM lineitem WHERE l_returnflag IS NOT NULL AND l_discount < 0.05""",
    "sort_multi": "SELECT * FROM customer ORDER BY c_mktsegment DESC, c_acctbal DESC",
    "dedup_ordered": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                     l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem)
        WHERE rn = 1""",
    "dedup_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem",
    "group_aggregate": """
        SELECT l_returnflag, l_linestatus,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
               round(avg(l_quantity), 6) AS avg_qty, count(l_orderkey) AS n,
               count(DISTINCT l_orderkey) AS n_orders,
               count(*) FILTER (WHERE l_quantity > 25) AS n_big
        FROM lineitem GROUP BY ALL""",
    "join_using_inner": """
        SELECT c_custkey AS custkey, c_name, c_nationkey, o_orderkey, o_orderstatus, o_orderdate
        FROM customer JOIN orders ON c_custkey = o_custkey""",
    "join_left": _LEFT,
    "join_left_fanout": _LEFT,
    "join_semi": """
        SELECT doc_id, lang, source FROM documents d
        WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "join_anti": """
        SELECT DISTINCT doc_id FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "join_lookup": """
        SELECT s_nationkey, s_suppkey, s_name, s_acctbal, n_name, n_regionkey
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "union_batches": """
        SELECT c_name AS name, c_acctbal AS balance, 'c' AS kind FROM customer
        UNION ALL SELECT s_name, s_acctbal, 's' FROM supplier""",
    "top_rows": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey, o_custkey LIMIT 30""",
    "clean_strings": f"""
        SELECT doc_id, coalesce({_clean('text')}, 'N/A') AS text,
               coalesce(replace({_clean('text')}, '"', '""'), 'N/A') AS escaped,
               coalesce({_clean("nullif(lang, 'en')")}, 'N/A') AS lang,
               regexp_replace(source, '^{_WS}+|{_WS}+$', '', 'g') AS source
        FROM documents""",
    "clean_numbers": f"""
        SELECT event_id, CAST(CASE event_type WHEN 'click' THEN CAST({_K} AS BIGINT)
                         WHEN 'view' THEN -CAST({_K} AS BIGINT) END AS BIGINT) AS number
        FROM events""",
    "iso_duration": f"""
        SELECT event_id, event_type, CAST(CASE event_type
                 WHEN 'click' THEN 3720 + CAST({_K} AS DOUBLE)
                 WHEN 'view' THEN 86400 + 3600 * CAST({_K} AS DOUBLE)
                 WHEN 'signup' THEN epoch(date_trunc('minute', ts)) END AS DOUBLE) AS seconds
        FROM events""",
    "derived_measures": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(2024 - year(o_orderdate) AS INTEGER) AS age,
               o_totalprice / CAST(nullif(month(o_orderdate) - 1, 0) AS DOUBLE) * 100.0 AS share,
               coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority
        FROM orders""",
    "path_parts": r"""
        WITH p AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS path FROM pages),
             q AS (SELECT *, regexp_replace(path, '/+$', '') AS cut FROM p)
        SELECT page_id, list_last(string_split(cut, '/')) AS last,
               regexp_extract(cut, '^(.*)/[^/]*$', 1) AS parent,
               contains(url, 'spam') AS spam, ends_with(path, '.html') AS html
        FROM q""",
}
